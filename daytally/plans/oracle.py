"""The registered queries as SQL on the supplied tables, for comparison.

The texts are written against the raw tables; every query spells out the views it
needs as common table expressions.
"""

from __future__ import annotations

from daytally.plans.registry import DAY, EVE, KEYWORD, MONTH, NOON, PAGE, SIZE

_APP_LOG = """app_log as (
  select event_id,
         case when event_type = 'view' then 'startup' else 'event' end as type,
         'mid_' || user_id as mid, 'uid_' || user_id as uid,
         case when user_id % 10 < 3 then 'ios' else 'android' end as os,
         'app1' as appid, 'area_' || (user_id % 10) as area,
         case when user_id % 10 < 3 then 'appstore' else 'ch_' || (user_id % 7) end as ch,
         'v' || (user_id % 4) as vs, event_type as evid,
         cast(json_extract_string(props, '$.k') as int) as itemid,
         epoch_us(ts) // 1000 as ts,
         strftime(ts, '%Y-%m-%d') as logdate, strftime(ts, '%H') as loghour
  from events)"""

_STARTUP = _APP_LOG + """,
startup_log as (
  select mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts, event_id
  from app_log where type = 'startup')"""

_DAU = _STARTUP + """,
dau as (
  select mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts
  from (select *, row_number() over (partition by mid, logdate order by ts, event_id) as rn
        from startup_log) where rn = 1)"""

_VISITED = _STARTUP + f""",
visited as (select distinct logdate, mid from startup_log where loghour < '{NOON}'),
batch as (select * from startup_log where loghour >= '{NOON}'),
fresh as (select * from batch b where not exists (
  select 1 from visited v where v.logdate = b.logdate and v.mid = b.mid))"""

_ORDERS = """order_info as (
  select event_id as id, value as total_amount,
         strftime(ts, '%Y-%m-%d') as create_date, strftime(ts, '%H') as create_hour
  from events where event_type = 'purchase')"""

_CHANGES = """change_flat as (
  select event_id as id,
         case when event_id % 10 = 0 then 'TRANSACTIONBEGIN' else 'ROWDATA' end as entry_type,
         case when event_id % 7 = 0 then 'other' else 'shop' end as schema_name,
         case when event_id % 5 = 1 then 'user_info' else 'order_info' end as table_name,
         case when event_id % 4 = 0 then 'UPDATE' when event_id % 4 = 1 then 'DELETE'
              else 'INSERT' end as event_type,
         cast(cast(value as decimal(18,2)) as varchar(30)) as total_amount,
         strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H') as create_time
  from events where event_type = 'purchase'),
inserted as (
  select * from change_flat
  where entry_type = 'ROWDATA' and schema_name = 'shop'
    and table_name = 'order_info' and event_type = 'INSERT')"""

_ORDER_MESSAGE = """'{"id":"' || id || '","total_amount":"' || total_amount
       || '","create_time":"' || create_time || '"}'"""

_WANTED = ", ".join(f"'{word}'" for word in KEYWORD.split())

_SALE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"

_HITS = f"""sale_detail as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
         strftime(o_orderdate, '%Y-%m-01') as dt, p_name as sku_name,
         case when c_custkey % 2 = 0 then 'F' else 'M' end as user_gender,
         cast(12 + c_custkey % 45 as int) as user_age
  from lineitem join orders on l_orderkey = o_orderkey
                join customer on o_custkey = c_custkey
                join part on l_partkey = p_partkey),
hits as (
  select * from sale_detail
  where dt = '{MONTH}'
    and list_has_all(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), [{_WANTED}]))"""

_RANKED = f"""{_HITS},
worded as (
  select *, list_filter(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') as words
  from sale_detail where dt = '{MONTH}'),
day as (
  select count(*) as n, sum(len(words))::double / count(*) as mean
  from worded where len(words) > 0),
wanted(word) as (select unnest(list_sort(list_distinct([{_WANTED}])))),
common as (
  select word, count(*) as df from wanted join worded on list_contains(words, word) group by word),
scored as (
  select {_SALE_ORDER}, sum(
           ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))) as score
  from (select w.*, c.word, c.df, len(list_filter(w.words, lambda x: x = c.word)) as tf
        from worded w join common c on list_contains(w.words, c.word)), day
  group by {_SALE_ORDER}
  having count(*) = (select count(*) from wanted)),
ranked as (select * replace (round(score, 6) as score) from scored)"""

_BANDS = """bands as (
  select case when user_age < 20 then 'under_20' when user_age <= 30 then '20_to_30'
              else 'over_30' end as age_band from hits)"""


def _percent(part: str) -> str:
    return f"floor(({part}) * 1000.0::double / (select nullif(count(*), 0) from hits) + 0.5) / 10"


def _money(amount: str) -> str:
    return f"cast(sum(cast({amount} as decimal(18,2))) as double)"


def _gender_option(gender: str, label: str) -> str:
    share = _percent(f"select count(*) from hits where user_gender = '{gender}'")
    return f"""'{{"name":"{label}","value":' || cast(coalesce({share}, 0) as double) || '}}'"""


def _age_option(band: str, label: str) -> str:
    share = _percent(f"select count(*) from bands where age_band = '{band}'")
    return f"""'{{"name":"{label}","value":' || cast(coalesce({share}, 0) as double) || '}}'"""


_CLIENT_LINE = """'{"type":"' || type || '","mid":"' || mid || '","uid":"' || uid || '","os":"' || os
       || '","appid":"' || appid || '","area":"' || area || '",'
       || case when type = 'startup' then '"ch":"' || ch || '","vs":"' || vs || '"'
               else '"evid":"' || evid || '","itemid":' || itemid end
       || ',"ts":' || ts || '}'"""

_DETAIL_LINE = """'{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber
       || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey
       || ',"l_shipdate":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000')
       || '","l_extendedprice":' || l_extendedprice || ',"dt":"' || dt
       || '","sku_name":"' || sku_name || '","user_gender":"' || user_gender
       || '","user_age":' || user_age || '}'"""

_DAU_COLUMNS = "mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts"

_DAU_COMPARE = f"""select loghour,
  cast(sum(case when logdate = '{DAY}' then 1 end) as bigint) as today,
  cast(sum(case when logdate = '{EVE}' then 1 end) as bigint) as yesterday
from dau where logdate in ('{DAY}', '{EVE}') group by loghour"""

_ORDER_COMPARE = f"""select create_hour,
  {_money(f"case when create_date = '{DAY}' then total_amount end")} as today,
  {_money(f"case when create_date = '{EVE}' then total_amount end")} as yesterday
from order_info where create_date in ('{DAY}', '{EVE}') group by create_hour"""


def _map_json(hour: str) -> str:
    def side(name: str) -> str:
        entry = f"""'"' || {hour} || '":' || {name}"""
        return f"""coalesce(string_agg({entry}, ',' order by {hour}) filter ({name} is not null), '')"""

    return (
        f"""select '{{"today":{{' || {side("today")} || '}},"yesterday":{{' || {side("yesterday")}"""
        """ || '}}' as json from compared"""
    )


def oracle_sql() -> dict[str, str]:
    dau_hours = f"with {_DAU} select loghour, count(*) as ct from dau where logdate = '{DAY}' group by loghour"
    order_hours = (
        f"with {_ORDERS} select create_hour, {_money('total_amount')} as sum_order_amount "
        f"from order_info where create_date = '{DAY}' group by create_hour"
    )
    messages = f"with {_CHANGES} select {_ORDER_MESSAGE} as value from inserted"
    order_table = (
        f"with {_CHANGES} select cast(id as varchar) as id, create_time[1:10] as create_date, "
        "create_time[12:13] as create_hour, cast(total_amount as double) as total_amount from inserted"
    )
    return {
        "dau_hour_count": dau_hours,
        "dau_total": f"with {_DAU} select count(*) as ct from dau where logdate = '{DAY}'",
        "dau_hour_compare": f"with {_DAU} {_DAU_COMPARE}",
        "dau_all_hours": f"with {_DAU} select logdate, loghour, count(*) as ct from dau group by all",
        "startup_parse": f"with {_STARTUP} select event_id, {_DAU_COLUMNS} from startup_log",
        "log_route": f"with {_APP_LOG} select type as topic, count(*) as n from app_log group by type",
        "log_stamp": f"with {_APP_LOG} select type as topic, {_CLIENT_LINE} as value from app_log",
        "first_per_mid": f"with {_DAU} select {_DAU_COLUMNS} from dau",
        "visited_anti": f"with {_VISITED} select logdate, mid, event_id, ts from fresh",
        "visited_set_update": (
            f"with {_VISITED} select logdate, mid from visited union select logdate, mid from batch"
        ),
        "dau_increment": (
            f"with {_VISITED} select {_DAU_COLUMNS} from (select *, row_number() over "
            "(partition by mid, logdate order by ts, event_id) as rn from fresh) where rn = 1"
        ),
        "dau_table_hours": dau_hours,
        "dau_stream": f"with {_STARTUP} select distinct mid, logdate from startup_log",
        "dau_bounded_stream": f"with {_DAU} select {_DAU_COLUMNS} from dau",
        "compacted_table": f"with {_STARTUP} select {_DAU_COLUMNS}, 1 as files from startup_log",
        "log_route_stream": (
            f"with {_APP_LOG} select type as topic, type, count(*) as n from app_log group by type"
        ),
        "raw_log_stream": f"with {_APP_LOG} select {_CLIENT_LINE} as value, logdate from app_log",
        "cdc_order_rows": messages,
        "cdc_order_stream": messages,
        "record_source_stream": messages,
        "order_ingest": order_table,
        "order_single": order_table,
        "order_stream_table": order_table,
        "order_upserts": (
            "select case when event_id % 7 = 0 and event_id % 5 <> 0 then 'x' else '' end || event_id as id, "
            "strftime(ts, '%Y-%m-%d') as create_date, strftime(ts, '%H') as create_hour, "
            "cast(cast(value as decimal(18,2)) + case when event_id % 30 = 0 then 2 when event_id % 3 = 0 then 1 else 0 end as double) "
            "as total_amount from events where event_type = 'purchase' and (event_id % 5 <> 0 or event_id % 30 = 0)"
        ),
        # Every second order's lines come once more.
        "order_upsert_rejects": (
            "select reason, cast(sum(case when event_id % 2 = 0 then 2 else 1 end) as bigint) as n from ("
            "select event_id, 'bad amount' as reason from events where event_type = 'purchase' and event_id % 17 = 0 union all "
            "select event_id, 'no position' from events where event_type = 'purchase' and event_id % 11 = 0 union all "
            "select event_id, 'malformed' from events where event_type = 'purchase' and event_id % 13 = 0) group by reason"
        ),
        "startup_rejects": (
            f"with {_STARTUP} select reason, count(*) as n from (select case when event_id % 11 in (0, 1) "
            "then 'malformed' when event_id % 11 = 5 then 'no device' when event_id % 11 in (3, 4, 6) "
            "then 'bad time' end as reason from startup_log) where reason is not null group by reason"
        ),
        "change_rejects": (
            f"with {_CHANGES} select 'malformed' as reason, "
            "(select count(*) from change_flat) + (select count(*) from documents) as n"
        ),
        "order_rejects": f"with {_CHANGES} select 'bad amount' as reason, count(*) as n from inserted",
        "order_amount": (
            f"with {_ORDERS} select {_money('total_amount')} as total_amount "
            f"from order_info where create_date = '{DAY}'"
        ),
        "order_hour_amount": order_hours,
        "order_hour_compare": f"with {_ORDERS} {_ORDER_COMPARE}",
        "order_table_hours": order_hours,
        "sale_search": f"with {_HITS} select * from hits",
        "sale_count": f"with {_HITS} select count(*) as total from hits",
        "sale_page": (
            f"with {_HITS} select * from hits order by {_SALE_ORDER} limit {SIZE} offset {(PAGE - 1) * SIZE}"
        ),
        "sale_gender_terms": (
            f"with {_HITS} select user_gender, count(*) as n from hits group by user_gender "
            "order by n desc, user_gender limit 2"
        ),
        "sale_age_terms": (
            f"with {_HITS} select user_age, count(*) as n from hits group by user_age "
            "order by n desc, user_age limit 100"
        ),
        "sale_gender_ratio": (
            f"with {_HITS}, genders(user_gender) as (values ('M'), ('F')) "
            "select g.user_gender, count(h.user_gender) as n, "
            f"{_percent('count(h.user_gender)')} as ratio "
            "from genders g left join hits h on h.user_gender = g.user_gender group by g.user_gender"
        ),
        "sale_age_ratio": (
            f"with {_HITS}, {_BANDS}, names(age_band) as (values ('under_20'), ('20_to_30'), ('over_30')) "
            f"select g.age_band, count(b.age_band) as n, {_percent('count(b.age_band)')} as ratio "
            "from names g left join bands b on b.age_band = g.age_band group by g.age_band"
        ),
        "sale_ranked": f"with {_RANKED} select * from ranked",
        "sale_ranked_page": (
            f"with {_RANKED}, shown as (select * from ranked order by score desc, {_SALE_ORDER} "
            f"limit {SIZE} offset {(PAGE - 1) * SIZE}) select hits.*, score from hits join shown using ({_SALE_ORDER})"
        ),
        "sale_report": (
            f"with {_HITS}, {_BANDS}, shown as (select * from hits order by {_SALE_ORDER} "
            f"limit {SIZE} offset {(PAGE - 1) * SIZE}) select (select count(*) from hits) as total, "
            """'[{"title":"性别占比","options":[' || """
            f"{_gender_option('M', '男')} || ',' || {_gender_option('F', '女')} || "
            """']},{"title":"年龄段占比","options":[' || """
            f"{_age_option('under_20', '20岁以下')} || ',' || "
            f"{_age_option('20_to_30', '20岁到30岁')} || ',' || "
            f"{_age_option('over_30', '30岁以上')} || ']}}]' as stat, "
            f"(select '[' || coalesce(string_agg({_DETAIL_LINE}, ',' order by {_SALE_ORDER}), '') || ']' "
            "from shown) as detail"
        ),
        "realtime_total": (
            f"with {_DAU} select 'dau' as id, '新增日活' as name, count(*) as value from dau "
            f"where logdate = '{DAY}' union all select 'new_mid', '新增设备', 33333"
        ),
        "realtime_total_json": (
            f"""with {_DAU} select '[{{"id":"dau","name":"新增日活","value":' || count(*) """
            """|| '},{"id":"new_mid","name":"新增设备","value":33333}]' as json """
            f"from dau where logdate = '{DAY}'"
        ),
        "realtime_total_measured": (
            f"with {_DAU}, {_ORDERS} select 'dau' as id, '新增日活' as name, "
            f"cast(count(*) as double) as value from dau where logdate = '{DAY}' "
            "union all select 'new_mid', '新增设备', cast(count(*) as double) from "
            f"(select mid from startup_log group by mid having min(logdate) = '{DAY}') "
            f"union all select 'order_amount', '新增交易额', {_money('total_amount')} "
            f"from order_info where create_date = '{DAY}'"
        ),
        "hour_map": f"with {_DAU}, compared as ({_DAU_COMPARE}) {_map_json('loghour')}",
        "order_hour_map": f"with {_ORDERS}, compared as ({_ORDER_COMPARE}) {_map_json('create_hour')}",
        "metric_dispatch": (
            f"with {_DAU} select 'dau' as metric, logdate as date, loghour as hour, "
            "cast(count(*) as double) as value from dau "
            f"where logdate in ('{DAY}', '{EVE}') group by logdate, loghour"
        ),
        "metric_dispatch_orders": (
            f"with {_ORDERS} select 'order_amount' as metric, create_date as date, create_hour as hour, "
            f"{_money('total_amount')} as value from order_info "
            f"where create_date in ('{DAY}', '{EVE}') group by create_date, create_hour"
        ),
        "new_devices": (
            f"with {_STARTUP} select logdate, count(*) as new_devices from "
            "(select mid, min(logdate) as logdate from startup_log group by mid) group by logdate"
        ),
        "bad_records": (
            "select text as value from documents "
            "where not case when json_valid(text) then json_type(text) = 'OBJECT' else false end"
        ),
        "batch_metrics": (
            f"with {_VISITED} select (select count(*) from batch) as received, "
            "(select count(*) from fresh) as unvisited, "
            "(select count(*) from (select distinct logdate, mid from fresh)) as kept"
        ),
    }
