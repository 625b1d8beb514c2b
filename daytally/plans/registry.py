"""Every query over the supplied tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally import schemas, settings
from daytally.functions.logs import EVENT, ORDER, STARTUP
from daytally.operators import changes, devices, ingest, measures, sales
from daytally.plans import batch, dashboard
from daytally.plans.sale_report import sale_report as report
from daytally.sources import records, tables, topics, views
from daytally.sources.first_seen import FirstSeen
from daytally.sources.first_seen import new_devices as new_devices_of
from daytally.sources.postings import Postings, lines_of
from daytally.sources.snapshots import DayTable
from daytally.streaming.bounded import bounded_device_stream
from daytally.streaming.collect import collect_logs, keep_raw_log
from daytally.streaming.devices import device_stream
from daytally.streaming.orders import order_changes_stream, order_stream, order_table, publish_orders, reject_table

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-15"
EVE = views.day_earlier(DAY)
MONTH = "1997-08-01"
KEYWORD = "red ring"
PAGE, SIZE = 2, 10
SUBSCRIPTION = "shop.*"
ORDERED = ("ts", "event_id")
NOON = "12"
# How much input one micro-batch of a replay takes.
FILES_PER_BATCH = 10_000
DRAIN = {"availableNow": True}
# Days after which a day leaves the bounded stream's state, and batches of the compacted table.
KEEP_DAYS = 3
SMALL_BATCHES = 200
# Records for which a replayed topic has one partition more.
TOPIC_RECORDS = 250_000


# Daily active devices


def dau_hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.device_hours(devices.first_seen(views.startup_log(spark, sf_dir, DAY, DAY)), DAY)


def dau_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.device_total(devices.first_seen(views.startup_log(spark, sf_dir, DAY, DAY)), DAY)


def dau_hour_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = devices.first_seen(views.startup_log(spark, sf_dir, EVE, DAY))
    return measures.device_hour_compare(seen, DAY)


def dau_all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = devices.first_seen(views.startup_log(spark, sf_dir))
    return seen.groupBy("logdate", "loghour").agg(measures.rows().alias("ct"))


def first_per_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = devices.first_per_device(views.startup_log(spark, sf_dir), ORDERED)
    return first.select(*schemas.DAU_COLUMNS)


def _visited_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every day's morning as what was seen before, the rest of it as the batch."""
    log = views.startup_log(spark, sf_dir)
    morning = log.where(F.col("loghour") < NOON).select(*devices.KEY).distinct()
    return morning, log.where(F.col("loghour") >= NOON)


def visited_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visited set is stored first, as it is between two batches.

    Read back, its size is known from its files, which decides about a broadcast.
    """
    visited, incoming = _visited_and_batch(spark, sf_dir)
    path = settings.new_run_dir(spark, "visited")
    tables.append_table(visited, path, "logdate")
    visited = tables.read_visited(spark, path)
    return devices.unvisited(incoming, visited).select("logdate", "mid", "event_id", "ts")


def visited_set_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    visited, incoming = _visited_and_batch(spark, sf_dir)
    return devices.visited_union(visited, incoming)


def dau_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    visited, incoming = _visited_and_batch(spark, sf_dir)
    return devices.new_on_day(incoming, visited, ORDERED).select(*schemas.DAU_COLUMNS)


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    visited, incoming = _visited_and_batch(spark, sf_dir)
    rows, counts = batch.counted_step(incoming, visited, ORDERED)
    rows.write.format("noop").mode("overwrite").save()
    before, after = (count.get for count in counts)
    values = (before["received"], after["unvisited"], after["kept"])
    return spark.createDataFrame([values], "received bigint, unvisited bigint, kept bigint")


def new_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.new_devices(views.startup_log(spark, sf_dir))


def dau_table_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = settings.new_run_dir(spark, "dau")
    tables.append_dau(devices.first_per_device(views.startup_log(spark, sf_dir), ORDERED), path)
    return measures.device_hours(tables.read_dau(spark, path), DAY)


# Logs


def _startup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.startup_log(spark, sf_dir)
    return log.select("event_id", views.startup_line().alias("value"))


def _client_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.app_log(spark, sf_dir)
    return log.select("ts", views.client_line().alias("value"))


def startup_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.startup_records(_startup_lines(spark, sf_dir), keep=("event_id",))


def log_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ingest.route_lines(_client_lines(spark, sf_dir), F.col("ts"))
    return routed.groupBy("topic").agg(measures.rows().alias("n"))


def log_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's own time is the clock here, so that the result can be compared."""
    return ingest.route_lines(_client_lines(spark, sf_dir), F.col("ts")).select("topic", "value")


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client lines mixed with the prose of the documents, which is no JSON."""
    prose = views.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    mixed = _client_lines(spark, sf_dir).select("value").union(prose)
    return ingest.malformed_lines(mixed)


def startup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Startup lines of which some are broken: text behind, odd times, no device."""
    kind, line = F.col("event_id") % 11, F.col("value")
    timed = lambda ts: F.regexp_replace(line, '"ts":([0-9]+)', f'"ts":{ts}')
    broken = (
        F.when(kind == 0, F.concat(line, F.lit("] lost")))
        .when(kind == 1, F.concat(line, F.lit('],[{"b":2}')))
        .when(kind == 2, timed('"$1"'))
        .when(kind == 3, timed("9223372036854775807"))
        .when(kind == 4, timed("$1000"))
        .when(kind == 5, F.regexp_replace(line, '"mid":"[^"]*"', '"mid":""'))
        .when(kind == 6, timed('"soon"'))
        .otherwise(line)
    )
    lines = _startup_lines(spark, sf_dir).select(broken.alias("value"))
    return ingest.startup_rejects(lines).groupBy("reason").agg(measures.rows().alias("n"))


# Streams. Each reads a supplied table as its source, runs until the input is
# used up, and gives back what its sink holds.


def _replay(session: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = views.table(session, sf_dir, name).schema
    reader = session.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    # A pattern, because a table may be one file or a folder of files.
    return reader.parquet(f"{sf_dir}/{name}.parquet*")


def dau_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "devices")
    log = views.startup_log_of(_replay(session, sf_dir, "events"))
    lines = log.select(views.startup_line().alias("value"))
    device_stream(lines, f"{home}/checkpoint", f"{home}/table", trigger=DRAIN).awaitTermination()
    return tables.read_dau(session, f"{home}/table").select("mid", "logdate")


def dau_bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch answer of ``first_per_mid`` from days in no order, with state for KEEP_DAYS days.

    The startups are produced in four batches of scattered days; what comes after its day has left the
    state goes to a table of late startups, and both tables together hold every first startup.
    """
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "bounded")
    log = views.startup_log(session, sf_dir)
    turn, total = F.pmod(F.xxhash64("logdate"), F.lit(4)), log.count()
    partitions = max(2, total // TOPIC_RECORDS)
    for number in range(4):
        lines = log.where(turn == number)
        when = F.timestamp_millis("ts")
        records.append_records(lines.select("ts", views.startup_line().alias("value")), f"{home}/log", STARTUP, f"{number}", partitions, when)
    share = max(1, total // 2)
    lines = topics.stream_topic(session, STARTUP, records.FORMAT, f"{home}/log", startingOffsets="earliest", maxRecordsPerBatch=str(share))
    query = bounded_device_stream(lines, f"{home}/checkpoint", f"{home}/table", f"{home}/late", KEEP_DAYS, {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    found = [DayTable(session, f"{home}/{name}", schemas.DAU, "logdate").read() for name in ("table", "late")]
    return devices.first_per_device(found[0].union(found[1])).select(*schemas.DAU_COLUMNS)


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day table written in SMALL_BATCHES small batches, one of them twice, and compacted: rows and files per day."""
    table = DayTable(spark, settings.new_run_dir(spark, "compact"), schemas.DAU, "logdate")
    log = views.startup_log(spark, sf_dir).select(*schemas.DAU_COLUMNS)
    first, last = views.table(spark, sf_dir, "events").agg(F.unix_millis(F.min("ts").cast("timestamp")), F.unix_millis(F.max("ts").cast("timestamp"))).first()
    # What a stream hands over: a slice of time per batch.
    piece = ((F.col("ts") - first) * SMALL_BATCHES / (last - first + 1)).cast("int")
    table.append_batches(log.withColumn("slice", piece), "slice", "collect")
    table.append(log, "collect", SMALL_BATCHES - 1)
    table.compact(before="9999-12-31")
    table.vacuum(1)
    held = table.files_of(table.version(), table.days())
    per_day = F.create_map(*[F.lit(x) for day, found in held.items() for x in (day, len(found))])
    return table.read().withColumn("files", F.try_element_at(per_day, F.col("logdate")))


def log_route_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "collect")
    log = views.app_log_of(_replay(session, sf_dir, "events"))
    lines = log.select(views.client_line().alias("value"))
    collect_logs(
        lines, f"{home}/checkpoint", fmt="text", path=f"{home}/topics", trigger=DRAIN
    ).awaitTermination()
    stored = session.read.schema(topics.FILE_TOPIC).text(f"{home}/topics")
    kind = F.get_json_object("value", "$.type").alias("type")
    return stored.groupBy("topic", kind).agg(measures.rows().alias("n"))


def raw_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected lines, stamped with the table's own time, in the raw log per day."""
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "raw")
    log = views.app_log_of(_replay(session, sf_dir, "events"))
    lines = log.select("ts", views.client_line().alias("value"))
    collect_logs(
        lines, f"{home}/c1", F.col("ts"), fmt="text", path=f"{home}/topics", trigger=DRAIN
    ).awaitTermination()
    sent = [
        topics.stream_topic(session, name, "text", f"{home}/topics") for name in (STARTUP, EVENT)
    ]
    keep_raw_log(sent[0].union(sent[1]), f"{home}/c2", f"{home}/log", DRAIN).awaitTermination()
    return session.read.schema("value string, logdate string").text(f"{home}/log")


def cdc_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "changes")
    lines = views.change_lines_of(_replay(session, sf_dir, "events"))
    publish_orders(
        lines, f"{home}/checkpoint", SUBSCRIPTION, fmt="text", path=f"{home}/topics", trigger=DRAIN
    ).awaitTermination()
    return topics.read_topic(session, ORDER, f"{home}/topics")


def record_source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages of a record log, read in bounded batches of which one fails half way.

    The change lines are produced as two batches in three partitions. The second micro-batch fails after
    its sink has written; the restarted query reads the same offsets again, in the middle of the files,
    and its sink replaces what it has of that batch.
    """
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "records")
    events = views.table(session, sf_dir, "events")
    for name, half in enumerate(("event_id % 2 = 0", "event_id % 2 = 1")):
        lines = views.change_lines_of(events.where(half))
        records.append_records(lines, f"{home}/log", "changes", f"{name}", 3)
    share = max(1, views.change_lines_of(events).count() // 5)
    failed = []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/sink/batch={number}")
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("a failure between the sink and the checkpoint")

    for _ in range(2):
        lines = topics.stream_topic(
            session, "changes", records.FORMAT, f"{home}/log", startingOffsets="earliest", maxRecordsPerBatch=str(share)
        )
        messages = changes.order_messages_of_lines(lines, SUBSCRIPTION)
        query = topics.write_batches(messages, f"{home}/checkpoint", keep, trigger={"processingTime": "0 seconds"})
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            if not failed:
                raise
        finally:
            query.stop()
    return session.read.schema("topic string, value string").parquet(f"{home}/sink").select("value")


# Database changes and orders


def cdc_order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.change_lines(spark, sf_dir)
    return changes.order_messages_of_lines(lines, SUBSCRIPTION).select("value")


def order_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.change_lines(spark, sf_dir)
    return changes.order_rows(changes.order_messages_of_lines(lines, SUBSCRIPTION))


def change_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change lines, the same lines with text behind them, and prose."""
    lines = views.change_lines(spark, sf_dir).select("value")
    spoiled = lines.select(F.concat("value", F.lit("] lost")).alias("value"))
    prose = views.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    found = changes.change_rejects(lines.union(spoiled).union(prose))
    return found.groupBy("reason").agg(measures.rows().alias("n"))


def order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages, and the same ones with an amount that is no number."""
    lines = views.change_lines(spark, sf_dir)
    sent = changes.order_messages_of_lines(lines, SUBSCRIPTION).select("value")
    spoiled = sent.select(F.replace("value", F.lit('"total_amount":"'), F.lit('"total_amount":"x')).alias("value"))
    return changes.order_rejects(sent.union(spoiled)).groupBy("reason").agg(measures.rows().alias("n"))


def _order_changes(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str]:
    """The folder of both tables of the order change stream, whose log comes in no order, some of it twice.

    The second micro-batch fails between the two sinks; the changes are merged into the base before the
    stream goes on.
    """
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "order-changes")
    log = views.order_log_of(views.table(session, sf_dir, "events"))
    deliveries = [f"(event_id + step) % 3 = {turn}" for turn in (2, 0, 1)] + ["event_id % 2 = 0"]
    for name, part in enumerate(deliveries):
        records.append_records(log.where(part).select("value"), f"{home}/log", "changes", f"{name}", 3)
    share = max(1, log.count() // 4)
    failed = []

    def between(_: DataFrame, number: int) -> None:
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("a failure between the two sinks")

    for turn in range(2):
        lines = topics.stream_topic(
            session, "changes", records.FORMAT, f"{home}/log", startingOffsets="earliest", maxRecordsPerBatch=str(share)
        )
        query = order_changes_stream(
            lines, f"{home}/checkpoint", f"{home}/table", f"{home}/rejects", SUBSCRIPTION, {"processingTime": "0 seconds"}, between
        )
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            if not failed:
                raise
        finally:
            query.stop()
        if turn == 0:
            order_table(session, f"{home}/table").merge()
    return session, home


def order_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as inserts, updates, deletes and changed ids leave it."""
    session, home = _order_changes(spark, sf_dir)
    return order_table(session, f"{home}/table").read()


def order_upsert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same stream put into its second table."""
    session, home = _order_changes(spark, sf_dir)
    return reject_table(session, f"{home}/rejects").read().groupBy("reason").agg(measures.rows().alias("n"))


def order_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change delivered twice, every order stored once."""
    lines = views.change_lines(spark, sf_dir)
    twice = changes.order_messages_of_lines(lines.union(lines), SUBSCRIPTION)
    return changes.single_orders(changes.order_rows(twice))


def order_stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change delivered twice through both streams."""
    session, home = settings.stream_session(spark), settings.new_run_dir(spark, "order-table")
    lines = views.change_lines_of(_replay(session, sf_dir, "events"))
    again = views.change_lines_of(_replay(session, sf_dir, "events"))
    publish_orders(
        lines.union(again), f"{home}/c1", SUBSCRIPTION, fmt="text", path=f"{home}/topics", trigger=DRAIN
    ).awaitTermination()
    messages = topics.stream_topic(session, ORDER, "text", f"{home}/topics")
    order_stream(messages, f"{home}/c2", f"{home}/table", DRAIN).awaitTermination()
    return tables.read_orders(session, f"{home}/table")


def order_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.order_total(views.order_info(spark, sf_dir, DAY, DAY), DAY)


def order_hour_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.order_hours(views.order_info(spark, sf_dir, DAY, DAY), DAY)


def order_hour_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.order_hour_compare(views.order_info(spark, sf_dir, EVE, DAY), DAY)


def order_table_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = settings.new_run_dir(spark, "orders")
    orders = views.order_info(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    tables.append_orders(orders, path)
    return measures.order_hours(tables.read_orders(spark, path), DAY)


# Sale details


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.search(views.sale_detail(spark, sf_dir, MONTH), MONTH, KEYWORD)


def sale_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir)


def sale_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.hit_count(_hits(spark, sf_dir))


def sale_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.page(_hits(spark, sf_dir), views.SALE_KEY, PAGE, SIZE)


def sale_gender_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.gender_terms(_hits(spark, sf_dir))


def sale_age_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.age_terms(_hits(spark, sf_dir))


def sale_gender_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.gender_shares(_hits(spark, sf_dir))


def sale_age_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.age_shares(_hits(spark, sf_dir))


def sale_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.sale_detail(spark, sf_dir, MONTH)
    return report(lines, MONTH, KEYWORD, PAGE, SIZE, views.SALE_KEY)


def _postings(lines: DataFrame) -> Postings:
    spark = lines.sparkSession
    table = Postings(spark, settings.new_run_dir(spark, "postings"), lines.select(*views.SALE_KEY).schema)
    table.add(lines)
    return table


def sale_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit with its relevance, from an index of all days of which the search reads one."""
    return _postings(views.sale_detail(spark, sf_dir)).hits(MONTH, KEYWORD)


def sale_ranked_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one page of hits, most relevant first."""
    lines = views.sale_detail(spark, sf_dir, MONTH)
    table = _postings(lines)
    return lines_of(table.page(table.hits(MONTH, KEYWORD), PAGE, SIZE), lines, views.SALE_KEY)


# Dashboard


def realtime_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = devices.first_seen(views.startup_log(spark, sf_dir, DAY, DAY))
    return dashboard.key_figures(seen, DAY)


def realtime_total_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.figures_json(realtime_total(spark, sf_dir))


def realtime_total_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New devices come from one partition of the first-seen table, which the day before had left."""
    table = FirstSeen(spark, settings.new_run_dir(spark, "first-seen"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    table.load(views.startup_log(spark, sf_dir, None, EVE))
    today = views.startup_log(spark, sf_dir, DAY, DAY)
    table.add_day(today, DAY)
    orders = views.order_info(spark, sf_dir, DAY, DAY)
    return dashboard.measured_figures(devices.first_seen(today), new_devices_of(table, DAY), orders, DAY)


def hour_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.hour_map(dau_hour_compare(spark, sf_dir), "loghour")


def order_hour_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.hour_map(order_hour_compare(spark, sf_dir), "create_hour")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.metric_hours(
        devices.first_seen(views.startup_log(spark, sf_dir, EVE, DAY)),
        views.order_info(spark, sf_dir, EVE, DAY),
    )


def metric_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dispatch(_metrics(spark, sf_dir), dashboard.DAU_ID, DAY)


def metric_dispatch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dispatch(_metrics(spark, sf_dir), dashboard.ORDER_AMOUNT_ID, DAY)


_QUERIES: tuple[Query, ...] = (
    dau_hour_count,
    dau_total,
    dau_hour_compare,
    dau_all_hours,
    startup_parse,
    log_route,
    log_stamp,
    first_per_mid,
    visited_anti,
    visited_set_update,
    dau_increment,
    dau_table_hours,
    dau_stream,
    dau_bounded_stream,
    compacted_table,
    log_route_stream,
    raw_log_stream,
    cdc_order_rows,
    cdc_order_stream,
    record_source_stream,
    order_ingest,
    startup_rejects,
    change_rejects,
    order_rejects,
    order_single,
    order_stream_table,
    order_upserts,
    order_upsert_rejects,
    order_amount,
    order_hour_amount,
    order_hour_compare,
    order_table_hours,
    sale_search,
    sale_count,
    sale_page,
    sale_gender_terms,
    sale_age_terms,
    sale_gender_ratio,
    sale_age_ratio,
    sale_report,
    sale_ranked,
    sale_ranked_page,
    realtime_total,
    realtime_total_json,
    realtime_total_measured,
    hour_map,
    order_hour_map,
    metric_dispatch,
    metric_dispatch_orders,
    new_devices,
    bad_records,
    batch_metrics,
)


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(settings.pin_time_zone(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {query.__name__: _in_utc(query) for query in _QUERIES}
