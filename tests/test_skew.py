"""One key holds a third of all rows: results stay whole and the work is split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daytally.operators import sales
from daytally.sources import views
from tests.conftest import rows

ROWS = 60_000
PARTS, ORDERS, CUSTOMERS = 500, 3_000, 200


@pytest.fixture
def session(spark):
    child = spark.newSession()
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }.items():
        child.conf.set(key, value)
    return child


def write_tables(session, folder, hot):
    """Four small tables; ``hot`` names the line column that one value dominates."""
    n = F.col("id")
    third = (n % 3 == 0)

    def spread(column, count):
        even = F.pmod(F.xxhash64(n, F.lit(column)), F.lit(count))
        return F.when(third, 7).otherwise(even) if column == hot else even

    lines = session.range(0, ROWS, 1, 8).select(
        spread("l_orderkey", ORDERS).alias("l_orderkey"),
        spread("l_partkey", PARTS).alias("l_partkey"),
        F.lit(1).cast("bigint").alias("l_suppkey"),
        n.cast("int").alias("l_linenumber"),
        F.lit(1.5).alias("l_extendedprice"),
        F.lit(dt.datetime(1997, 8, 20)).cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders = session.range(ORDERS).select(
        n.alias("o_orderkey"),
        (n % CUSTOMERS).alias("o_custkey"),
        F.lit(dt.datetime(1997, 8, 3)).cast("timestamp_ntz").alias("o_orderdate"),
    )
    parts = session.range(PARTS).select(
        n.alias("p_partkey"), F.when(n % 2 == 1, "red ring").otherwise("box").alias("p_name")
    )
    customers = session.range(CUSTOMERS).select(n.alias("c_custkey"))
    tables = {"lineitem": lines, "orders": orders, "part": parts, "customer": customers}
    for name, frame in tables.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return lines


@pytest.mark.parametrize("hot", ["l_partkey", "l_orderkey"])
def test_heavy_key_in_the_sale_join(session, tmp_path, hot):
    lines = write_tables(session, tmp_path, hot)
    hits = sales.search(views.sale_detail(session, str(tmp_path), "1997-08-01"), "1997-08-01", "ring red")
    found = hits.select("l_linenumber", "user_gender")
    collected = found.collect()
    assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    expected = lines.where(F.col("l_partkey") % 2 == 1).select("l_linenumber", "l_orderkey").collect()
    assert sorted(tuple(row) for row in collected) == sorted(
        (line, "F" if order % CUSTOMERS % 2 == 0 else "M") for line, order in expected
    )
    shares = {r.user_gender: r.n for r in sales.gender_shares(hits).collect()}
    assert sum(shares.values()) == len(expected)
    assert rows(sales.hit_count(hits)) == [(len(expected),)]
