"""What the physical plans must and must not contain."""

import pytest

from daytally.operators import devices
from daytally.operators.measures import device_hour_compare, device_hours
from daytally.plans import dashboard
from daytally.plans.registry import DAY, EVE, queries
from daytally.sources import tables, views

FOLDER = "/root/testdata/sf0.001"
BATCH = sorted(set(queries()) - {"batch_metrics"} - {name for name in queries() if "stream" in name})


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_day_range_and_type_reach_the_scan(spark):
    text = plan(queries()["dau_hour_count"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "LessThan(ts,2024-01-16T00:00)" in text
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    assert "SortAggregate" not in text


def test_comparison_scans_once(spark):
    assert plan(queries()["dau_hour_compare"](spark, FOLDER)).count("FileScan") == 1


def test_first_record_is_reduced_before_the_shuffle(spark):
    text = plan(queries()["first_per_mid"](spark, FOLDER))
    before = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_step_adds_no_shuffle_for_the_join(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(queries()["dau_increment"](session, FOLDER))
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_unknown_metric_reads_nothing(spark):
    seen = devices.first_seen(views.startup_log(spark, FOLDER, EVE, DAY))
    metrics = dashboard.metric_hours(seen, views.order_info(spark, FOLDER, EVE, DAY))
    assert "FileScan" not in plan(dashboard.dispatch(metrics, "other", DAY))
    assert plan(dashboard.dispatch(metrics, "dau", DAY)).count("FileScan") == 1


def test_table_queries_prune_partitions(spark, tmp_path):
    first = devices.first_per_device(views.startup_log(spark, FOLDER), ("ts", "event_id"))
    tables.append_dau(first, f"{tmp_path}/dau")
    table = tables.read_dau(spark, f"{tmp_path}/dau")
    text = plan(device_hours(table, DAY))
    assert "(logdate#" in text and f"= {DAY})" in text[text.index("PartitionFilters") :]
    assert "ReadSchema: struct<loghour:string>" in text
    both = plan(device_hour_compare(table, DAY))
    assert EVE in both[both.index("PartitionFilters") :]
    assert table.count() == first.count()


def test_page_keeps_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["sale_page"](spark, FOLDER))
