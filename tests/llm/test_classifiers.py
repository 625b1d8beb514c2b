import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.llm import labelled, quality_trees, queries, toxicity_chain

FOLDER = "/root/testdata/sf0.1"


def tables(spark, folder=FOLDER):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_sample_is_bounded_and_skips_the_held_out_fold(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(3, 1, 1), (None, 1, 1), (900, None, None)], "doc_id long, quality int, toxic int")
    chosen = labelled.sample(labels, ["quality", "toxic"], rows=50)
    assert chosen.count() == 50 and chosen.where(labelled.remainder() == 0).count() == 0
    assert labelled.sample(labels, ["quality"], rows=500).where("doc_id is null or doc_id = 900").count() == 0


def test_trees_match_a_walk_by_hand():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(800, 5))
    good = ((rows[:, 1] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    trees = quality_trees.fitted(rows, good)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] >= 0:
                node = trees.left[node] + (row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.scores(rows), [walk(row) for row in rows])
    assert ((trees.scores(rows) > 0.5) == good).mean() > 0.95
    assert np.allclose(quality_trees.fitted(rows, np.ones(800)).scores(rows[:2]), 801 / 802)


def test_statistics_by_hand():
    names = quality_trees.STATISTICS
    row = dict(zip(names, quality_trees.statistics(["aa aa b!\né", ""])[0], strict=True))
    assert row["lower"] == pytest.approx(5 / 11) and row["lead"] == pytest.approx(1 / 11) and row["shout"] == pytest.approx(1 / 11)
    assert row["distinct"] == 3 / 4 and row["top"] == 2 / 4 and row["again"] == 1 / 4 and row["lines"] == 2
    assert len(quality_trees.statistics([""])[0]) == len(names)


def test_quality_held_out(spark):
    labels = tables(spark)[1]
    found = queries.op8_quality(spark, FOLDER)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and found.count() == 10_000
    wrong = found.join(labels.where("quality is not null"), "doc_id").where("held_out and predicted <> quality").count()
    assert wrong <= 8


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    found = toxicity_chain.scored(docs, labels).withColumnRenamed("toxic", "said").join(labels.where("toxic is not null"), "doc_id")
    held = found.where(labelled.remainder() == 0).groupBy("toxic", "said").count().collect()
    counts = {(row.toxic, row.said): row["count"] for row in held}
    assert counts[1, True] > 0.85 * (counts[1, True] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) < 0.01 * counts[0, False]


def test_chain_feeds_earlier_categories():
    pick = random.Random(1)
    rows = [sorted(pick.sample(range(6), 2)) for _ in range(600)]
    first = np.array([0 in row for row in rows], float)
    second = np.array([0 in row or 1 in row for row in rows], float)
    second[:50] = np.nan
    chain = toxicity_chain.fit_chain({str(i): i for i in range(6)}, rows, np.stack([first, second], 1), np.arange(600) % 4)
    said = toxicity_chain.probability(chain.log_odds(rows)) > 0.5
    assert (said[:, 0] == first).all() and (said[50:, 1] == second[50:]).all() and len(chain.models[1].earlier) == 1


ODD = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "words here", None), (3, "idiot " * 60_000, "c"), (4, "fine", "d")]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(4, None, None), (9, 1, 1)], [(3, 0, 1), (4, 1, 0), (4, 1, 0), (2, None, 1)]])
def test_odd_rows(spark, labels):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = quality_trees.scored(docs, known)
    assert scores.count() == 6 and scores.where("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    assert toxicity_chain.scored(docs, known).where("p_toxic is not null and toxic is not null").count() == 6
    kept = toxicity_chain.without_toxic(docs, known)
    assert kept.columns == docs.columns
    assert quality_trees.scored(docs.limit(0), known).count() == 0
    assert toxicity_chain.without_toxic(docs.limit(0), known).count() == 0


def test_filter_agrees_with_scores(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    said = toxicity_chain.scored(docs, labels).where("not toxic").select("doc_id")
    kept = toxicity_chain.without_toxic(docs, labels)
    assert sorted(r.doc_id for r in said.collect()) == sorted(r.doc_id for r in kept.select(F.col("doc_id")).collect())
