"""Jobs for spark-submit: the streams, the late merge, and the reports.

    spark-submit --py-files daytally.zip run_job.py devices --format kafka --option kafka.bootstrap.servers=... \\
        --checkpoint /shared/cp/devices --table /shared/dau --keep-days 2
    spark-submit --py-files daytally.zip run_job.py realtime-hour --id dau --date 2024-01-15 --table /shared/dau

A report prints its JSON answer. With ``--drain`` a stream takes what is there and
ends.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daytally import settings
from daytally.functions.logs import EVENT, ORDER, STARTUP
from daytally.operators import measures
from daytally.operators.ingest import startup_records
from daytally.plans import dashboard
from daytally.plans.sale_report import sale_report
from daytally.schemas import DAU, DAU_COLUMNS
from daytally.sources import tables, topics
from daytally.sources.postings import Postings, lines_of
from daytally.sources.snapshots import TARGET_BYTES, DayTable
from daytally.sources.views import day_earlier
from daytally.streaming.bounded import bounded_device_stream
from daytally.streaming.collect import collect_logs, keep_raw_log
from daytally.streaming.devices import device_stream, late_devices
from daytally.streaming.orders import order_changes_stream, order_stream, order_table, publish_orders


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _topic(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    return topics.stream_topic(spark, name, args.format, args.path, **_options(args.option))


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.drain else {"processingTime": args.every}


def _sink(args: argparse.Namespace) -> dict:
    return {
        "fmt": args.sink_format,
        "path": args.sink_path,
        "trigger": _trigger(args),
        **_options(args.sink_option),
    }


def collect(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    return collect_logs(_topic(spark, args, args.topic), args.checkpoint, **_sink(args))


def raw_log(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    lines = _topic(spark, args, STARTUP).union(_topic(spark, args, EVENT))
    return keep_raw_log(lines, args.checkpoint, args.table, _trigger(args))


def devices(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    lines = _topic(spark, args, STARTUP)
    return device_stream(
        lines, args.checkpoint, args.table, args.keep_days, _trigger(args), args.files_per_day
    )


def first_devices(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    lines = _topic(spark, args, STARTUP)
    return bounded_device_stream(lines, args.checkpoint, args.table, args.late_table, args.keep_days, _trigger(args))


def publish(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    lines = _topic(spark, args, args.topic)
    return publish_orders(lines, args.checkpoint, args.subscription, **_sink(args))


def orders(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    return order_stream(
        _topic(spark, args, ORDER),
        args.checkpoint,
        args.table,
        _trigger(args),
        args.keep_days,
        args.files_per_day,
    )


def order_changes(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    lines = _topic(spark, args, args.topic)
    return order_changes_stream(lines, args.checkpoint, args.table, args.reject_table, args.subscription, _trigger(args))


def late(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge what the device stream dropped on a day, from the raw log of that day.

    ``--table`` names the stream's tables alone; the day is replaced in the late table,
    so running the job again changes nothing.
    """
    if args.late_table in args.table:
        raise SystemExit("--table must not name the late table")
    raw = spark.read.schema("value string, logdate string").text(args.raw)
    is_startup = F.get_json_object("value", "$.type") == STARTUP
    lines = raw.where((F.col("logdate") == args.date) & is_startup).select("value")
    known = tables.read_dau(spark, *args.table).where(F.col("logdate") == args.date)
    found = late_devices(startup_records(lines), known).select(*DAU_COLUMNS)
    tables.replace_days(found.where(F.col("logdate") == args.date), args.late_table, "logdate")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewrite the small files of a versioned device table's closed days, and remove what no version needs."""
    table = DayTable(spark, args.table, DAU, "logdate")
    print(table.compact(args.before, args.target_bytes), table.vacuum(args.keep_versions))


def merge_orders(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge the changes of the order table into its base, and remove what no version needs."""
    table = order_table(spark, args.table)
    print(table.merge(), table.vacuum(args.keep_versions))


def _print_json(answer: DataFrame) -> None:
    print(answer.first()["json"])


def realtime_total(spark: SparkSession, args: argparse.Namespace) -> None:
    found = tables.read_devices(spark, *args.table, first=args.date, last=args.date)
    _print_json(dashboard.figures_json(dashboard.key_figures(found, args.date)))


def _eve(date: str) -> str:
    """The day before; a date that is none has no day before it."""
    try:
        return day_earlier(date)
    except ValueError:
        return date


def realtime_hour(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.id == dashboard.DAU_ID:
        found = tables.read_devices(spark, *args.table, first=_eve(args.date), last=args.date)
        compared = measures.device_hour_compare(found, args.date)
        _print_json(dashboard.hour_map(compared, "loghour"))
    elif args.id == dashboard.ORDER_AMOUNT_ID:
        compared = measures.order_hour_compare(tables.read_orders(spark, *args.table), args.date)
        _print_json(dashboard.hour_map(compared, "create_hour"))
    else:
        print("null")


def _sale_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return spark.read.parquet(*args.table).withColumn("dt", F.col("dt").cast("string"))


def sale_detail(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = _sale_lines(spark, args)
    order = tuple(args.order.split(","))
    row = sale_report(lines, args.date, args.keyword, args.startpage, args.size, order)
    fields = F.concat(
        F.lit('{"total":'), "total", F.lit(',"stat":'), "stat", F.lit(',"detail":'), "detail", F.lit("}")
    )
    _print_json(row.select(fields.alias("json")))


def _postings(args: argparse.Namespace, lines: DataFrame) -> Postings:
    key = args.order.split(",")
    return Postings(lines.sparkSession, args.index, lines.select(*key).schema)


def index_sales(spark: SparkSession, args: argparse.Namespace) -> None:
    """Index the sale lines of one day, or of every day of the table."""
    lines = _sale_lines(spark, args)
    _postings(args, lines).add(lines.where(F.col("dt") == args.date) if args.date else lines)


def sale_ranked(spark: SparkSession, args: argparse.Namespace) -> None:
    """One page of lines, most relevant first; ``--after`` takes the score and key of the last line shown."""
    lines = _sale_lines(spark, args).where(F.col("dt") == args.date)
    table = _postings(args, lines)
    hits = table.hits(args.date, args.keyword)
    if args.after:
        page = table.page_after(hits, tuple(json.loads(args.after)), args.size)
    else:
        page = table.page(hits, args.startpage, args.size)
    shown = lines_of(page, lines, table.key).orderBy(F.desc("score"), *table.key)
    # A page of stated size.
    print("[" + ",".join(shown.toJSON().collect()) + "]")


STREAMS = (collect, raw_log, devices, first_devices, publish, orders, order_changes)
SINKS = (collect, publish)
REPORTS = (realtime_total, realtime_hour, sale_detail, sale_ranked)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="daytally", description=__doc__)
    jobs = parser.add_subparsers(required=True)
    commands = {}
    for job in (*STREAMS, late, compact, merge_orders, index_sales, *REPORTS):
        command = jobs.add_parser(job.__name__.replace("_", "-"))
        command.set_defaults(job=job)
        commands[job] = command
    for job in STREAMS:
        add = commands[job].add_argument
        add("--format", default="kafka")
        add("--path")
        add("--option", action="append", default=[])
        add("--checkpoint", required=True)
        add("--every", default=topics.TRIGGER)
        add("--drain", action="store_true")
        if job in SINKS:
            add("--topic", required=True)
            add("--sink-format", default="kafka")
            add("--sink-path")
            add("--sink-option", action="append", default=[])
        else:
            add("--table", required=True)
    for job in (devices, orders):
        commands[job].add_argument("--keep-days", type=int)
        commands[job].add_argument("--files-per-day", type=int)
    for job in (devices, first_devices):
        commands[job].add_argument("--state-partitions", type=int)
    commands[first_devices].add_argument("--keep-days", type=int, required=True)
    commands[first_devices].add_argument("--late-table", required=True)
    commands[compact].add_argument("--table", required=True)
    commands[compact].add_argument("--before", required=True, help="the first day that is still open")
    commands[compact].add_argument("--target-bytes", type=int, default=TARGET_BYTES)
    commands[compact].add_argument("--keep-versions", type=int, default=2)
    commands[order_changes].add_argument("--topic", required=True)
    commands[order_changes].add_argument("--reject-table", required=True)
    commands[merge_orders].add_argument("--table", required=True)
    commands[merge_orders].add_argument("--keep-versions", type=int, default=2)
    for job in (publish, order_changes):
        commands[job].add_argument("--subscription", default=".*")
    for job in (late, *REPORTS):
        commands[job].add_argument("--table", action="append", required=True)
        commands[job].add_argument("--date", required=True)
    commands[late].add_argument("--raw", required=True)
    commands[late].add_argument("--late-table", required=True)
    commands[realtime_hour].add_argument("--id", required=True)
    for job in (sale_detail, sale_ranked):
        commands[job].add_argument("--keyword", required=True)
        commands[job].add_argument("--startpage", type=int, default=1)
        commands[job].add_argument("--size", type=int, default=20)
    for job in (sale_detail, index_sales, sale_ranked):
        commands[job].add_argument("--order", required=True, help="unique sort columns")
    for job in (index_sales, sale_ranked):
        commands[job].add_argument("--index", required=True)
    commands[index_sales].add_argument("--table", action="append", required=True)
    commands[index_sales].add_argument("--date", help="the day to index; every day of the table if left out")
    commands[sale_ranked].add_argument("--after", help="JSON list: score and key of the last line shown")
    return parser


def main(argv: list[str], spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or settings.build_session()
    if args.job in STREAMS:
        session = settings.stream_session(spark, getattr(args, "state_partitions", None))
        args.job(session, args).awaitTermination()
    else:
        args.job(spark, args)
