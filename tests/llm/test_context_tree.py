import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from daytally.llm import context_tree as ct
from daytally.llm import queries

FOLDER = "/root/testdata/sf0.001"


def stream(text):
    words = (text or "").encode().lower().split()
    return b"".join(w + b" " for w in words) + b"\n"


class Brute:
    """Counts of every context in a dictionary; states and smoothing as the module's text says."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            data = b"\x00" * (ct.DEPTH - 1) + b"\n" + stream(text)
            for i in range(ct.DEPTH, len(data)):
                for depth in range(ct.DEPTH + 1):
                    self.counts[data[i - depth : i]][data[i]] += 1
        self.kept = {b""}
        for context, seen in self.counts.items():
            total, above = sum(seen.values()), self.counts[context[1:]]
            gain = sum(n * math.log(n / total / (above[s] / sum(above.values()))) for s, n in seen.items())
            if context and total >= ct.LEAST and gain > ct.DIVERGENCE * (len(seen) + 1):
                self.kept |= {context[i:] for i in range(len(context))}

    def p(self, context, symbol):
        while context not in self.kept:
            context = context[1:]
        seen = self.counts[context]
        below = self.p(context[1:], symbol) if context else 1 / 256
        if not seen:
            return below
        total = sum(seen.values())
        return max(seen[symbol] - ct.DISCOUNT, 0) / total + ct.DISCOUNT * len(seen) / total * below

    def score(self, text):
        data = b"\x00" * (ct.DEPTH - 1) + b"\n" + stream(text)
        return sum(math.log10(self.p(data[i - ct.DEPTH : i], data[i])) for i in range(ct.DEPTH, len(data)))


def expected(rows, sample):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    words = lambda text: [*(text or "").encode().lower().split(), None]
    taught = [text for i, text in rows if not held[i]]
    counts = Counter(w for text in taught for w in words(text))
    n, kinds = sum(counts.values()), len(counts)
    model = Brute(taught)
    for i, text in rows:
        own = words(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in own)
        yield (i, held[i], len(own), sum(counts[w] > 0 for w in own), n, base), model.score(text) if i in sample else None


def compare(got, wanted):
    got = sorted(map(tuple, got), key=repr)
    wanted = sorted(wanted, key=repr)
    assert len(got) == len(wanted)
    for mine, (exact, score) in zip(got, wanted):
        assert mine[:5] == exact[:5] and mine[5] == pytest.approx(exact[5], rel=1e-9)
        assert score is None or mine[6] == pytest.approx(score, rel=1e-7)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    compare(queries.op5_lm_score(spark, FOLDER).collect(), expected(rows, {i for i, _ in rows[::9]}))


def test_odd_rows_and_bundles(spark, monkeypatch):
    rows = [(1, None), (2, ""), (2, ""), (3, "A b\tA b"), (4, "a b a c" * 40), (None, "x\x00y \x1c z"), (5, "é É"), (6, "word " * 3000), (7, "a b"), (8, "new words")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bundle int").repartition(3)
    wanted = list(expected(rows, {i for i, _ in rows}))
    compare(ct.scored(docs).collect(), wanted)
    monkeypatch.setattr(ct, "BUNDLE_BYTES", 50)
    compare(ct.scored(docs).collect(), wanted)
    assert ct.scored(docs.limit(0)).count() == 0


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "ab c") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    for row in ct.scored(docs).collect():
        assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.n_tokens == 3
        assert row.score == pytest.approx(6 * math.log10(1 / 256)) and row.base_score == pytest.approx(3 * math.log10(1.0))


def test_distributions_sum_to_one_and_budget_keeps_suffixes(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    monkeypatch.setattr(ct, "ENTRIES", 4000)
    tree = ct.trained(docs)
    assert 1000 < sum(map(len, tree.entries)) <= 4000
    for depth in range(2, ct.DEPTH + 1):
        assert np.isin(tree.contexts[depth] & np.uint64(ct.mask(depth - 2)), tree.contexts[depth - 1]).all()
    pick = np.random.default_rng(1).choice(np.concatenate(tree.entries[3:]), 20)
    for key in pick:
        keys = (np.full(256, key) & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert tree.probabilities(keys).sum() == pytest.approx(1.0)
        assert np.allclose(ct.Quick(tree).log10(keys), np.log10(tree.probabilities(keys)))


def test_better_than_the_base_on_held_out_documents(spark):
    got = queries.op5_lm_score(spark, "/root/testdata/sf0.1").where("held_out").select("score", "base_score").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.97


def test_scores_use_the_whole_tree_whatever_its_size(spark, monkeypatch):
    rows = [(i, f"a b a c {i % 7} word" * (i + 1)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ct, "ENTRIES", 16)
    compare(ct.scored(docs).collect(), expected(rows, {i for i, _ in rows}))
    monkeypatch.setattr(ct, "FLUSH", 20)
    monkeypatch.setattr(ct, "BUNDLE_BYTES", 200)
    compare(ct.scored(docs).collect(), expected(rows, {i for i, _ in rows}))


@pytest.mark.parametrize("texts", [["a b a c " * 30, "word worm work wort " * 9, "x\x00y é", ""], []])
def test_parts_give_the_probabilities_of_the_whole_tree(texts):
    """Levels beyond SHARED bytes of context need no other part."""
    texts = texts + [" ".join(f"w{i * i % 37} of {i % 5}" for i in range(400))]
    keys, n = ct.counted(ct.grams(*ct.symbols(texts)))
    model = Brute(texts)
    for _, own in ct.gram_parts(keys, 5):
        levels, _, kept = ct.long_levels(keys[own], n[own])
        as_bytes = lambda context, depth: int(context).to_bytes(8, "big")[8 - depth :]
        for depth, level, retained in zip(range(ct.SHARED, ct.DEPTH + 1), levels, kept, strict=True):
            for place, context in enumerate(level.contexts.tolist()):
                seen = model.counts[as_bytes(context, depth)]
                assert level.c[place] == sum(seen.values()) and level.kinds[place] == len(seen)
                if depth > ct.SHARED:
                    assert retained[place] == (as_bytes(context, depth) in model.kept)


def test_grams_are_not_sent_for_each_depth(spark, monkeypatch):
    """The tables of the grams beyond SHARED bytes of context took most of the disk."""
    seen = []
    monkeypatch.setattr(ct, "leveled", lambda grams, top=ct.DEPTH, real=ct.leveled: seen.append(grams) or real(grams, top))
    rows = [(i, " ".join(f"w{i * j % 997}" for j in range(60))) for i in range(60)]
    ct.scored(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert len(seen) == 1 and seen[0].agg({"key": "max"}).first()[0] <= ct.mask(ct.SHARED)


def test_values_are_sent_once():
    """Log-probabilities come back as they were, and repeated ones take no room."""
    values = np.random.default_rng(2).random(500)[np.random.default_rng(3).integers(0, 500, 100_000)]
    distinct, places = ct.packed(values)
    assert (ct.unpacked(distinct, places) == values).all() and len(distinct) + len(places) < 300_000
    assert len(ct.unpacked(*ct.packed(np.empty(0)))) == 0


def test_a_bundle_is_scored_a_block_at_a_time(monkeypatch):
    """Hashing the words of a whole bundle at once took over a gigabyte of a task's memory."""
    texts = ["a b a", "", "word " * 30, "x\x00y é", "b a"] * 40
    data = [stream(text) for text in texts]
    seen = []
    monkeypatch.setattr(ct, "STEP_BYTES", 500)
    monkeypatch.setattr(ct, "word_hashes", lambda own, real=ct.word_hashes: seen.append(sum(map(len, own))) or real(own))
    found = list(ct.document_words(data))
    assert len(seen) > 5 and max(seen) <= 500 + max(map(len, data))
    assert [sorted(times.tolist()) for _, times in found] == [sorted(Counter(text.split(" ")).values()) if (text := x.decode().strip()) else [] for x in data]
    assert len(np.unique(np.concatenate([words for words, _ in found]))) == len({w for x in data for w in x.split()})


def test_answers_are_found_from_what_the_parts_send_back():
    """In whatever order the parts hold them, and for repeated keys."""
    keys = np.unique(ct.grams(*ct.symbols(["some words of a text " * 9, "other words"])))
    values = np.random.default_rng(4).random(len(keys))
    rows = [(ct.squeezed(keys[own]), *ct.packed(values[own])) for _, own in ct.gram_parts(keys, 3)]
    logs = ct.bundle_logs(pd.DataFrame(rows, columns=["codes", "values", "logs"]))
    asked = np.random.default_rng(5).integers(0, len(keys), 500)
    assert (logs.of(keys[asked]) == values[asked]).all()


def test_what_is_written_comes_back():
    for data in (b"", b"a", b"some words " * 5000, bytes(range(256))):
        assert ct.expanded(ct.compressed(data)) == data
    assert len(ct.compressed(np.ones(10_000, "<i8").tobytes())) < 8_000


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_runs_are_added_up_and_dealt_in_little_memory():
    """Copies of all keys of a bundle for each step of this took an executor beyond its memory."""
    held = [ct.counted(np.random.default_rng(i).integers(0, 1 << 56, size, dtype=np.uint64) >> np.uint64(i)) for i, size in enumerate((1_500_000, 300_000, 5, 200_000))]
    held += [(held[1][0][::3], held[1][1][::3]), (np.empty(0, np.uint64), np.empty(0, np.int64))]
    keys, n = ct.counted(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
    got, peak = peak_of(lambda: ct.summed(held))
    assert (got[0] == keys).all() and (got[1] == n).all()
    assert peak < 16 * sum(len(k) for k, _ in held) + 30_000_000
    dealt, peak = peak_of(lambda: ct.gram_parts(keys, 70))
    assert sorted(part for part, _ in dealt) == list(range(70)) and sum(len(own) for _, own in dealt) == len(keys)
    assert all((np.diff(own) > 0).all() for _, own in dealt) and peak < 16 * len(keys) + 30_000_000


def test_empty_runs_are_added_up():
    none = (np.empty(0, np.uint64), np.empty(0, np.uint32))
    assert [len(x) for x in ct.summed([none, none])] == [0, 0]


def test_a_bundle_leaves_its_task_in_small_batches(monkeypatch):
    texts = [" ".join(f"w{i * j % 91}" for j in range(60)) for i in range(80)]
    frame = {"doc_id": pa.array(range(80)), "text": pa.array(texts), "trains": pa.array([i % 3 > 0 for i in range(80)])}
    for name, value in (("STEP_BYTES", 700), ("SENT_BYTES", 2000), ("RANGE", 100), ("FLUSH", 600), ("BUNDLE_BYTES", 6000)):
        monkeypatch.setattr(ct, name, value)
    batches = list(ct.sent(ct.bundled(iter(pa.table(frame).to_batches(max_chunksize=30)), 3, 7)))
    rows = pa.Table.from_batches(batches).to_pandas()
    assert max(batch.nbytes for batch in batches) < 8000 and set(rows["bundle"]) == set(range(7, 7 + rows["bundle"].nunique()))
    documents = rows[rows["doc_id"].notna()]
    assert documents["doc_id"].tolist() == list(range(80)) and [ct.expanded(x) for x in documents["bytes"]] == [stream(text) for text in texts]
    keys, n = ct.grams_of(rows[rows["grams"] == True])  # noqa: E712
    wanted, times = ct.counted(ct.grams(*ct.symbols([text for i, text in enumerate(texts) if i % 3])))
    assert (keys[n > 0] == wanted).all() and (n[n > 0] == times).all()
    assert set(keys[n == 0].tolist()) == set(ct.grams(*ct.symbols(texts)).tolist()) - set(wanted.tolist())
