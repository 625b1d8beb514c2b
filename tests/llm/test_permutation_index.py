import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daytally.llm import permutation_index as index
from daytally.llm import queries


def brute(ids, rows, wanted=20, step=20):
    found = {}
    for query in sorted({i for i in ids if i % step == 0}):
        score = rows @ rows[ids.tolist().index(query)]
        others = np.flatnonzero(ids != query)
        best = others[np.lexsort((ids[others], -score[others]))][:wanted]
        found[query] = [(int(ids[i]), float(score[i])) for i in best]
    return found


def table_of(spark, ids, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, rows)], "vec_id long, embedding array<double>")


def test_recall_and_scores_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, rows = frame["vec_id"].to_numpy(), np.array(frame["embedding"].tolist(), np.float64)
    wanted, hits = brute(ids, rows), 0
    got = queries.op6_nearest(spark, folder).orderBy("query_id", "rank").collect()
    assert len(got) == 20 * len(wanted)
    for row in got:
        at, other = ids.tolist().index(row.query_id), ids.tolist().index(row.vec_id)
        assert row.score == pytest.approx(float(rows[at] @ rows[other]), abs=1e-12)
        hits += row.vec_id in {i for i, _ in wanted[row.query_id]}
    assert hits / len(got) > 0.93
    for before, after in zip(got, got[1:]):
        if before.query_id == after.query_id:
            assert (-before.score, before.vec_id) < (-after.score, after.vec_id) and after.rank == before.rank + 1


def test_footrule_order():
    rng = np.random.default_rng(2)
    places = [rng.permutation(40)[:32] for _ in range(2)]
    by_hand = sum(abs((list(a).index(p) if p in a else 32) - (list(b).index(p) if p in b else 32)) for a, b in [places] for p in range(40))
    other = np.full(40, 32)
    other[places[1]] = np.arange(32)
    mine = other[places[0]]
    # What Shard ranks by, and the constant that it leaves out.
    assert (np.abs(mine - np.arange(32)) + mine).sum() - 32 * 32 + 32 * 33 // 2 == by_hand


def test_recall_with_unequal_norms_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 8)) * rng.uniform(0.1, 5, size=(300, 1))
    rows[50:150] = rows[0]
    ids = np.arange(300)
    got = index.search(table_of(spark, ids, rows), F.col("vec_id") % 20 == 0).collect()
    found = {}
    for row in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append(row.vec_id)
    wanted = brute(ids, rows)
    assert sum(len(set(found[query]) & {i for i, _ in best}) for query, best in wanted.items()) > 0.9 * 20 * len(wanted)


def test_shards_and_blocks_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = table_of(spark, np.arange(500), rng.normal(size=(500, 6)))
    whole = sorted(map(tuple, index.search(vectors, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(index, "SHARD_ROWS", 100)
    monkeypatch.setattr(index, "BLOCK_ROWS", 5)
    parts = sorted(map(tuple, index.search(vectors, F.col("vec_id") % 20 == 0).collect()))
    assert len(parts) == len(whole) and len(set(r[:3] for r in whole) & set(r[:3] for r in parts)) >= 0.98 * len(whole)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (1, None, None), (2, [0.0, 0.0], "x"), (3, [nan, 1.0], "x"), (4, [inf, 1.0], "x"), (5, [None, 1.0], "x"),
        (6, [1.0], "x"), (7, [], "x"), (None, [1.0, 1.0], "x"), (8, [2.0, 0.0], "x"), (9, [2.0, 0.0], "x"), (20, [0.0, -1.0], "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<float>, near string")
    got = sorted(tuple(r) for r in index.search(vectors, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 8, 2.0), (0, 2, 9, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 0, 0.0), (20, 3, 8, 0.0), (20, 4, 9, 0.0)]
    assert index.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert index.search(vectors.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def recall_of(rows, pivots, queries, wanted=20):
    """Over shards of SHARD_ROWS, without Spark."""
    ids, most = np.arange(len(rows)), float((rows**2).sum(axis=1).max())
    pivots = index.lifted(pivots, most)
    near, asks = index.orders(index.lifted(rows, most), pivots), index.orders(rows, pivots[:, :-1])
    shards, hits = len(rows) // index.SHARD_ROWS + 1, 0
    made = []
    for k in range(shards):
        own = ids[k::shards]
        frame = pd.DataFrame({"vec_id": own, "packed": [rows[i].tobytes() for i in own], "near": [near[i].tobytes() for i in own]})
        made.append(index.Shard(frame, len(pivots), min(index.PREFIX, len(pivots))))
    for query in queries:
        score = np.sort(np.concatenate([shard.nearest(query, rows[query], asks[query], wanted)[1] for shard in made]))[-wanted:]
        exact = np.sort(np.delete(rows @ rows[query], query))[-wanted]
        hits += (score >= exact - 1e-9).sum()
    return hits / (wanted * len(queries))


def clustered(rng, count, dimension=64):
    rows = rng.normal(size=(200, dimension))[rng.integers(0, 200, count)] + rng.normal(size=(count, dimension))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_recall_over_full_shards_at_the_stated_share():
    rng = np.random.default_rng(6)
    for rows in (clustered(rng, 20_000), rng.normal(size=(20_000, 64))):
        assert recall_of(rows, rows[rng.permutation(len(rows))[: index.PIVOTS]], range(0, 20_000, 500)) > 0.93
    frame = pd.DataFrame({"vec_id": range(600), "packed": [row.tobytes() for row in rows[:600]], "near": [b"\x00\x01"] * 600})
    assert index.Shard(frame, 2, 2).rerank <= 600 * index.RERANKED


def test_pivots_and_recall_with_a_third_of_copies(spark):
    rng = np.random.default_rng(7)
    rows = clustered(rng, 6000)
    rows[1::3] = rows[0]
    vectors = table_of(spark, np.arange(6000), rows).select("vec_id", F.col("embedding").alias("vector"))
    pivots = index.pivots_of(vectors, 64, float((rows**2).sum(axis=1).max()))[:, :-1]
    assert len(pivots) == len(np.unique(pivots, axis=0)) == index.PIVOTS
    assert recall_of(rows, pivots, range(0, 6000, 150)) > 0.93


def test_each_dimension_is_searched(spark):
    rows = [(i, [float(i), 1.0] if i % 3 else [1.0, float(i), 2.0]) for i in range(24)]
    got = index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    for query in (0, 20):
        alike = [i for i, row in rows if i != query and len(row) == len(rows[query][1])]
        best = sorted((-float(np.dot(rows[i][1], rows[query][1])), i) for i in alike)[:20]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query] == [(i, -s) for s, i in best]
