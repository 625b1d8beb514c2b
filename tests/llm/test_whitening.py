import math

import numpy as np
import pytest

from daytally.llm import whitening

KINDS = "vec_id long, embedding array<float>, label int"


def numbers(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(found, rows):
    """The rows of one dimension against numpy, with the deviation in Python's whole numbers."""
    x = numbers([v for _, v in rows])
    n, width = len(x), len(x[0])
    total = [sum(column) for column in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, total)] for row in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    shown = min(32, width)
    by = {}
    for row in found:
        by.setdefault((row.vec_id, row.deviation), {}).setdefault(row.component, []).append(row)
    assert len(found) == n * shown
    assert {row.n for row in found} == {n} and len({row.identity_error for row in found}) == 1
    assert found[0].identity_error < 1e-8
    for i in range(shown):
        live = values[i] > 1e-12 * cov.trace()
        want = centred @ vectors[:, i] / math.sqrt(values[i]) if live else None
        signs = set()
        for at, ((vec_id, _), row) in enumerate(zip(rows, x)):
            deviation = sum((n * a - s) ** 2 for a, s in zip(row, total))
            got = by[vec_id, deviation][i + 1]
            if not live:
                assert got[0].whitened is None and got[0].explained == 0.0
                continue
            assert got[0].explained == pytest.approx(values[i] / cov.trace(), rel=1e-9)
            if abs(want[at]) > 1e-3:
                signs.add(min((-1, 1), key=lambda sign: min(abs(sign * g.whitened - want[at]) for g in got)))
            assert min(abs(abs(g.whitened) - abs(want[at])) for g in got) < 1e-7
        assert len(signs) <= 1


def test_matches_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 40 * 64)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 16)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 40)) @ rng.normal(size=(40, 40)) + 5
    vectors[:250] = vectors[3]
    rows = [(i if i % 50 else None, v.tolist()) for i, v in enumerate(vectors)] + [(7, (vectors[9] * 2).tolist())]
    table = spark.createDataFrame([(*row, 1) for row in rows], KINDS).repartition(5).selectExpr("*", "1 as n", "'x' as index")
    check(whitening.whitened(table).collect(), rows)


def test_few_dimensions_and_no_variance(spark):
    rows = [(i, [float(i % 7), 2.5, float(i % 7) * 3, 0.25 * i]) for i in range(60)]
    check(whitening.whitened(spark.createDataFrame([(*row, 1) for row in rows], KINDS)).collect(), rows)


def test_equal_rows(spark):
    found = whitening.whitened(spark.createDataFrame([(1, [0.5, -1.0], 0), (2, [0.5, -1.0], 0)], KINDS)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found) == [
        (i, c, 2, 0, None, 0.0, 0.0) for i in (1, 2) for c in (1, 2)
    ]


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [nan, 1.0, 2.0], 1), (103, [1.0, inf, 0.0], 1), (104, [], 1), (105, [1e38, 0.0, 0.0], 1)]
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 3)))]
    pairs = [(200 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(20, 2)))]
    table = spark.createDataFrame([*odd, *((*row, 1) for row in rows + pairs)], KINDS)
    found = whitening.whitened(table).collect()
    check([r for r in found if r.vec_id < 100], rows)
    check([r for r in found if r.vec_id >= 200], pairs)
    assert not {r.vec_id for r in found} & set(range(100, 200))


def test_deviation_beyond_a_long_is_null_and_empty_table(spark):
    found = whitening.whitened(spark.createDataFrame([(1, [1e15], 0), (2, [0.0], 0)], KINDS)).collect()
    assert [r.deviation for r in found] == [None, None] and [abs(r.whitened) for r in found] == [1.0, 1.0]
    assert whitening.whitened(spark.createDataFrame([], KINDS)).count() == 0
