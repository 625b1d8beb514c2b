import hashlib
import random
import zlib

import numpy as np
import pytest

from daytally.llm import queries
from daytally.llm import suffix_runs as sr

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    """Rows in order; doc_id, n_bytes, n_removed, n_spans, digest of what is kept."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, np.int8)
        cover = np.zeros(len(data) + 1, np.int64)
        for at in range(len(data) - 99):
            window = hashlib.blake2b(data[at : at + 100], digest_size=16).digest()
            if window in seen:
                cover[at] += 1
                cover[at + 100] -= 1
            seen.add(window)
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    rows = []
    for r in frame.collect():
        rows.append((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.starts), hashlib.sha256(bytes(r.kept)).hexdigest()))
        assert sum(b - a for a, b in zip(r.starts, r.stops)) == r.n_bytes - len(r.kept)
    return sorted(rows, key=repr)


def fixture():
    pick = random.Random(3)
    word = lambda: "".join(pick.choice(["an", "the", "ér", "ou", "s"]) for _ in range(pick.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(40), prose(1500)
    texts = [prose(pick.randint(0, 60)) + passage + prose(pick.randint(0, 60)) for _ in range(40)]
    texts += [long, long, long[500:3000], long[:2000] + "x" + long[2000:], prose(5) + long[1000:1150], "a" * 3000, "a" * 500, "ab" * 400, "", "short", passage[:99], passage[:100]]
    texts += [passage[:60] + passage[61:], "é" * 200, "De " * 300, prose(30), passage + passage]
    pick.shuffle(texts)
    return [*enumerate(texts), (7, texts[7]), (None, long), (None, passage), (900, None)]


@pytest.mark.parametrize(("bundle", "hot"), [(16_000_000, 2000), (4000, 2000), (4000, 3), (20_000, 0)])
def test_matches_brute_force(spark, monkeypatch, bundle, hot):
    monkeypatch.setattr(sr, "BUNDLE", bundle)
    monkeypatch.setattr(sr, "HOT", hot)
    rows = fixture()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bundle int").repartition(3)
    assert found(sr.without_repeats(docs)) == brute(rows)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op3_suffix_dedup(spark, FOLDER).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert sr.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_loser_tree_merges_front_coded_runs():
    pick = random.Random(1)
    for count in (1, 2, 3, 7):
        runs, every = [], []
        for bundle in range(count):
            keys = sorted({bytes(pick.choice(b"ab") for _ in range(pick.randint(1, 12))) for _ in range(30)})
            every += keys
            entries, tails, last = np.empty(len(keys), sr.ENTRY), b"", b""
            for i, key in enumerate(keys):
                shared = sr.shared_bytes(last, key)
                entries[i] = (i, i, i, shared, len(key))
                tails, last = tails + key[shared:], key
            runs.append(sr.Run(bundle, zlib.compress(entries.tobytes()), zlib.compress(tails)))
        got, last = [], b""
        for share, run in sr.merged(runs):
            assert not got or share == sr.shared_bytes(last, run.key)
            got.append(run.key)
            last = run.key
        assert got == sorted(every)


def test_every_window_has_one_anchor():
    text = np.random.default_rng(1).integers(97, 101, 5000, dtype=np.uint8).tobytes()
    found = sr.suffixes_of([b"", text[:50], text, b"", text[:100]])
    own = found[found["doc"] == 2]
    assert own["low"][0] == 0 and own["high"][-1] == 4900 and (own["low"][1:] == own["high"][:-1] + 1).all()
    assert (own["anchor"] >= own["high"]).all() and (own["anchor"] + sr.GRAM <= own["low"] + sr.LENGTH).all()
    assert len(found[found["doc"] == 4]) == 1 and not len(found[found["doc"] == 3])


def test_parts_get_even_shares_of_the_suffixes():
    texts = [np.random.default_rng(i).integers(97, 123, 20_000, dtype=np.uint8).tobytes() for i in range(20)]
    shares = np.bincount(sr.part_of(sr.suffixes_of(texts)["hash"], 64).astype(np.int64), minlength=64)
    assert shares.max() < 2 * shares.mean()


def test_repeated_windows_that_follow_each_other_are_one_range():
    gone = []
    for doc, at in ((0, 5), (0, 6), (0, 7), (0, 200), (1, 200), (1, 150)):
        sr.add_range(gone, doc, at, at + sr.LENGTH)
    assert gone == [(0, 5, 107), (0, 200, 300), (1, 200, 300), (1, 150, 250)]
