"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

OP1_NEAR_DEDUP = r"""
with recursive worded as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents
), sets as (
  select doc_id, case when len(words) >= 4
    then list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles
  from worded
), spread as (
  select doc_id, unnest(shingles) as shingle from sets
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as same
  from spread a join spread b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * same >= 80 * (len(x.shingles) + len(y.shingles) - same)
), both_ways as (
  select a, b from links union all select b, a from links
), reached as (
  select a, b from both_ways union select r.a, l.b from reached r join both_ways l on r.b = l.a
), least as (
  select a as doc_id, min(b) as root from reached group by 1
)
select s.doc_id, cast(len(shingles) as bigint) as n_shingles, least(s.doc_id, coalesce(root, s.doc_id)) as component_id,
       s.doc_id <= coalesce(root, s.doc_id) as kept
from sets s left join least l on l.doc_id = s.doc_id
"""

OP4_EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
from (select doc_id, coalesce(text, '') as body from documents) d
window same as (partition by body)
"""

OP11_FILTER_AUDIT = r"""
with worded as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents
), marked as (
  select doc_id, part,
         case when len(words) < 100 then 'A' else '' end
         || case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end
         || case when 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) then 'C' else '' end
         || case when regexp_matches(body, '[#$%&*|]') then 'D' else '' end
         || case when doc_id > min(doc_id) over (partition by body) then 'E' else '' end as failed
  from worded
), flags as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), cells as (
  select part, failed, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from marked left join flags using (doc_id) group by all
), letters(l) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps as (
  select filter_order, cast(step as integer) as step, filter_order[step] as own,
         string_split(filter_order[:step], '') as done, string_split(filter_order[:step - 1], '') as before
  from orders, range(1, 6) r(step)
), judged as (
  select part, filter_order, step, own, n, good, toxic, contains(failed, own) as fails, failed = own as alone,
         list_has_any(string_split(failed, ''), before) and failed <> '' and step > 1 as gone,
         list_has_any(string_split(failed, ''), done) and failed <> '' as out
  from cells, steps
), counted as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (not out), 0) as kept, coalesce(sum(n) filter (fails and not gone), 0) as removed,
         coalesce(sum(n) filter (fails and gone), 0) as redundant, coalesce(sum(n) filter (alone), 0) as unique_fails,
         coalesce(sum(n) filter (fails and not gone and good), 0) as good_lost,
         coalesce(sum(n) filter (fails and not gone and toxic), 0) as toxic_lost
  from judged group by all
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from counted
"""

_KEPT = """,
       s.doc_id <= coalesce(root, s.doc_id) as kept"""
OP13_JACCARD_JOIN = OP1_NEAR_DEDUP.replace("100 * same >= 80 *", "100 * same >= 85 *").replace(_KEPT, "")


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": OP1_NEAR_DEDUP, "op4_exact_dedup": OP4_EXACT_DEDUP, "op11_filter_audit": OP11_FILTER_AUDIT, "op13_jaccard_join": OP13_JACCARD_JOIN}
