"""The record log: offsets, replay, bounded batches, resuming after a failure."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from daytally import settings
from daytally.sources import files, records, topics

NOW = 1_705_276_800_000


@pytest.fixture
def session(spark):
    return settings.stream_session(spark, 2)


def produce(session, path, batch, numbers, partitions=2):
    rows = session.createDataFrame([(f"r{n:03d}", NOW + n) for n in numbers], "value string, ms bigint")
    return records.append_records(rows, path, "t", batch, partitions, F.timestamp_millis("ms"), F.substring("value", 4, 1))


def collector(seen, fail_at=None):
    failed = []

    def keep(batch, number):
        seen[number] = sorted((r["value"], r["partition"], r["offset"]) for r in batch.collect())
        if number == fail_at and not failed:
            failed.append(number)
            raise RuntimeError("injected")

    return keep


def run(session, path, checkpoint, keep, **options):
    lines = records.stream_records(session, path, "t", **options)
    query = topics.write_batches(lines, checkpoint, keep, trigger={"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_offsets_have_no_gaps_and_a_batch_counts_once(session, tmp_path):
    path = str(tmp_path / "log")
    assert produce(session, path, "a", range(40))
    assert not produce(session, path, "a", range(40))
    assert produce(session, path, "b", range(40, 70), partitions=3)
    seen = {}
    run(session, path, str(tmp_path / "c"), collector(seen), startingOffsets="earliest")
    rows = [row for batch in seen.values() for row in batch]
    assert sorted(r[0] for r in rows) == [f"r{n:03d}" for n in range(70)]
    by_partition = {}
    for value, partition, offset in rows:
        by_partition.setdefault(partition, []).append((offset, value))
    for found in by_partition.values():
        assert [offset for offset, _ in sorted(found)] == list(range(len(found)))
        # Within one producer's batch the order is that of time.
        assert [v for _, v in sorted(found) if v < "r040"] == sorted(v for _, v in found if v < "r040")


def test_resumes_in_the_middle_of_a_file(session, tmp_path):
    path, checkpoint, seen = str(tmp_path / "log"), str(tmp_path / "c"), {}
    produce(session, path, "a", range(50))
    keep = collector(seen, fail_at=1)
    options = {"startingOffsets": "earliest", "maxRecordsPerBatch": "14"}
    with pytest.raises(StreamingQueryException):
        run(session, path, checkpoint, keep, **options)
    before = dict(seen)
    assert set(before) == {0, 1} and sum(map(len, before.values())) <= 28
    produce(session, path, "b", range(50, 60))
    run(session, path, checkpoint, keep, **options)
    assert seen[0] == before[0] and seen[1] == before[1]
    assert sorted(r[0] for batch in seen.values() for r in batch) == [f"r{n:03d}" for n in range(60)]
    assert max(map(len, seen.values())) <= 14
    # Stopped and started anew without a failure, it goes on behind the last committed batch.
    produce(session, path, "c", range(60, 90))
    count = len(seen)
    run(session, path, checkpoint, keep, **options)
    assert len(seen) > count + 1 and max(map(len, seen.values())) <= 14
    assert sorted(r[0] for batch in seen.values() for r in batch) == [f"r{n:03d}" for n in range(90)]


def test_starts_at_the_end_at_offsets_or_at_a_time(session, tmp_path):
    path = str(tmp_path / "log")
    produce(session, path, "a", range(20))
    newest = {}
    run(session, path, str(tmp_path / "c1"), collector(newest))
    produce(session, path, "b", range(20, 30))
    run(session, path, str(tmp_path / "c1"), collector(newest))
    assert sorted(r[0] for batch in newest.values() for r in batch) == [f"r{n:03d}" for n in range(20, 30)]
    timed = {}
    run(session, path, str(tmp_path / "c2"), collector(timed), startingTimestamp=str(NOW + 13))
    assert sorted(r[0] for batch in timed.values() for r in batch) == [f"r{n:03d}" for n in range(13, 30)]
    given = {}
    run(session, path, str(tmp_path / "c3"), collector(given), startingOffsets=json.dumps({"0": 1000, "1": 3}))
    rows = [row for batch in given.values() for row in batch]
    assert rows and all(partition == 1 and offset >= 3 for _, partition, offset in rows)


def test_a_failed_producer_leaves_nothing_to_read(session, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    real = files.put_text
    monkeypatch.setattr(records.files, "put_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        produce(session, path, "a", range(10))
    monkeypatch.setattr(records.files, "put_text", real)
    seen = {}
    run(session, path, str(tmp_path / "c"), collector(seen), startingOffsets="earliest")
    assert not any(seen.values())
    assert produce(session, path, "a", range(10))
    run(session, path, str(tmp_path / "c"), collector(seen), startingOffsets="earliest")
    assert sorted(r[0] for batch in seen.values() for r in batch) == [f"r{n:03d}" for n in range(10)]


def test_a_name_is_taken_once(spark, tmp_path):
    files.put_text(spark, f"{tmp_path}/x/a.json", "é")
    with pytest.raises(FileExistsError):
        files.put_text(spark, f"{tmp_path}/x/a.json", "2")
    assert files.text_of(spark, f"{tmp_path}/x/a.json") == "é"
    assert files.listed(spark, f"{tmp_path}/x") == [files.listed(spark, f"{tmp_path}/x", ".json")[0]]
