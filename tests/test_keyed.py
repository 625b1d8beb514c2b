"""Tables kept by changes: the newest change wins in whatever order they come, and nothing counts twice."""

import random

import pytest
from pyspark.sql import functions as F

from daytally import jobs, schemas
from daytally.operators import changes
from daytally.sources import records
from daytally.sources.keyed import KeyedTable
from daytally.streaming.orders import order_table, reject_table
from tests.conftest import rows

COLUMNS = "id string, create_date string, create_hour string, total_amount double, at struct<position:long,place:int>, deleted boolean"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "orders"), schemas.ORDER_INFO, "id", "create_date")


def history(seed, count=400):
    pick = random.Random(seed)
    found = []
    for position in range(count):
        # One id has a third of all changes.
        key, day = (f"{pick.randint(0, 60)}" if pick.random() > 1 / 3 else "hot"), f"2024-01-0{pick.randint(1, 4)}"
        gone = pick.random() < 0.2
        found.append((key, None if gone else day, None if gone else "07", None if gone else float(position), (position, 0), gone))
    return found


def final(found):
    last = {}
    for row in found:
        if row[0] not in last or row[4] > last[row[0]][4]:
            last[row[0]] = row
    return sorted(row[:4] for row in last.values() if not row[5])


def read(table, wanted="true"):
    return sorted(tuple(row) for row in table.read(wanted).collect())


@pytest.mark.parametrize("merged", [(), (0,), (1, 3)])
def test_changes_in_any_order(spark, table, merged):
    found = history(1)
    mixed = random.Random(2).sample(found, len(found))
    for batch in range(4):
        part = mixed[batch::4] + mixed[:20]
        table.append(spark.createDataFrame(part, COLUMNS), "w", batch)
        assert table.append(spark.createDataFrame(found, COLUMNS), "w", batch) is False
        if batch in merged:
            assert table.merge() > 0 and table.merge() == 0
    assert read(table) == final(found)
    day = "2024-01-02"
    assert read(table, f"create_date = '{day}'") == [row for row in final(found) if row[1] == day]
    table.merge()
    table.vacuum(1)
    assert read(table) == final(found)


def test_late_older_change_brings_nothing_back(spark, table):
    table.append(spark.createDataFrame([("a", None, None, None, (5, 0), True), ("b", "2024-01-01", "01", 2.0, (6, 0), False)], COLUMNS), "w", 0)
    table.merge()
    late = [("a", "2024-01-01", "01", 1.0, (1, 0), False), ("b", "2024-01-02", "01", 1.0, (2, 0), False), ("b", "2024-01-01", "01", 2.0, (6, 0), False)]
    table.append(spark.createDataFrame(late, COLUMNS), "w", 1)
    assert read(table) == [("b", "2024-01-01", "01", 2.0)]


def test_empty_and_moved(spark, table):
    assert read(table) == [] and table.merge() == 0
    table.append(spark.createDataFrame([], COLUMNS), "w", 0)
    assert read(table) == []
    table.append(spark.createDataFrame([("a", "2024-01-01", "01", 1.0, (1, 0), False)], COLUMNS), "w", 1)
    table.merge()
    table.append(spark.createDataFrame([("a", "2024-01-02", "01", 1.0, (2, 0), False)], COLUMNS), "w", 2)
    assert read(table, "create_date = '2024-01-01'") == [] and len(read(table, "create_date = '2024-01-02'")) == 1


def test_batch_during_a_merge_is_not_lost(spark, table, monkeypatch):
    found = history(3, 60)
    table.append(spark.createDataFrame(found[:40], COLUMNS), "w", 0)
    put = table._put

    def slow(rows_, part):
        written = put(rows_, part)
        monkeypatch.setattr(table, "_put", put)
        table.append(spark.createDataFrame(found[40:], COLUMNS), "w", 1)
        return written

    monkeypatch.setattr(table, "_put", slow)
    with pytest.raises(FileExistsError):
        table.merge()
    assert read(table) == final(found)
    table.merge()
    table.vacuum(1)
    assert read(table) == final(found)


def test_base_is_not_shuffled_and_filter_reaches_its_scan(spark, table):
    found = history(4)
    table.append(spark.createDataFrame(found[:300], COLUMNS), "w", 0)
    table.merge()
    table.append(spark.createDataFrame(found[300:], COLUMNS), "w", 1)
    plan = table.read("create_date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(create_date,2024-01-02)" in plan
    # One exchange by key, of the changes; they are sent to the base, not the base to them.
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in plan


def line(kind, position, before=None, after=None, table="order_info"):
    image = lambda pairs: "null" if pairs is None else "[" + ",".join(f'{{"name":"{n}","value":"{v}"}}' for n, v in pairs.items()) + "]"
    place = "" if position is None else f'"position":{position},'
    return (
        f'{{"entryType":"ROWDATA","schemaName":"shop","tableName":"{table}","eventType":"{kind}",{place}'
        f'"rowDatas":[{{"beforeColumns":{image(before)},"afterColumns":{image(after)}}}]}}'
    )


def test_change_lines(spark):
    good = {"id": "1", "total_amount": "2.5", "create_time": "2024-01-01 07"}
    lines = [
        line("INSERT", 1, None, good),
        line("UPDATE", 2, good, good | {"id": "2"}),
        line("DELETE", 3, good),
        line("DELETE", 4, None),
        line("INSERT", None, None, good),
        line("UPDATE", 6, good, good | {"total_amount": "x"}),
        line("INSERT", 7, None, good | {"create_time": "soon"}),
        line("INSERT", 8, None, good, "user_info"),
        "{",
        None,
    ]
    checked = changes.checked_changes(spark.createDataFrame([(text,) for text in lines], "value string"), "shop.*")
    made = checked.where("reason is null").select("id", "create_date", "total_amount", "at.position", "deleted")
    assert sorted(made.collect(), key=lambda r: (r.position, r.id)) == [
        ("1", "2024-01-01", 2.5, 1, False),
        ("1", "2024-01-01", 2.5, 2, True),
        ("2", "2024-01-01", 2.5, 2, False),
        ("1", "2024-01-01", 2.5, 3, True),
    ]
    reasons = [r.reason for r in checked.where("reason is not null").collect()]
    assert set(reasons) == {"no id", "no position", "bad amount", "bad time", "malformed"}
    assert rows(checked.where(F.col("value").isNotNull()).where("reason = 'malformed'").select("value")) == [("{",)]


def test_jobs_keep_and_merge_the_table(spark, tmp_path, capsys):
    good = {"id": "1", "total_amount": "2.5", "create_time": "2024-01-01 07"}
    lines = [line("INSERT", 1, None, good), line("INSERT", 2, None, good | {"id": "2"}), line("UPDATE", 3, good, good | {"total_amount": "4"}), line("DELETE", 4, good | {"id": "2"}), "{"]
    records.append_records(spark.createDataFrame([(text,) for text in lines], "value string"), str(tmp_path / "log"), "changes", "0", 2)
    table, refused = str(tmp_path / "orders"), str(tmp_path / "rejects")
    stream = ["--format", "recordlog", "--path", str(tmp_path / "log"), "--option", "startingOffsets=earliest", "--checkpoint", str(tmp_path / "c"), "--drain"]
    jobs.main(["order-changes", *stream, "--topic", "changes", "--table", table, "--reject-table", refused], spark)
    assert rows(order_table(spark, table).read()) == [("1", "2024-01-01", "07", 4.0)]
    assert rows(reject_table(spark, refused).read()) == [("{", "malformed")]
    jobs.main(["merge-orders", "--table", table], spark)
    assert int(capsys.readouterr().out.split()[0]) > 0
    assert rows(order_table(spark, table).read()) == [("1", "2024-01-01", "07", 4.0)]
