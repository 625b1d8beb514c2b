import random
from collections import defaultdict
from itertools import permutations

import numpy as np

from daytally.llm import filter_audit as fa

SPACES = " \t\n\r\x0b\x0c"


def failures(rows, doc, text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    text = text or ""
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""
    found += "D" if set(text) & set("#$%&*|") else ""
    smaller = [d for d, t, _ in rows if d is not None and doc is not None and d < doc and (t or "") == text]
    return found + ("E" if smaller else "")


def brute(rows, labels):
    good = {doc for doc, quality, _ in labels if quality == 1 and doc is not None}
    toxic = {doc for doc, _, bad in labels if bad == 1 and doc is not None}
    docs = [(lang or "", failures(rows, doc, text), doc in good, doc in toxic) for doc, text, lang in rows]
    out, shapley = [], defaultdict(int)
    for part in sorted({d[0] for d in docs}):
        for order in map("".join, permutations("ABCDE")):
            own = [d for d in docs if d[0] == part]
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                failing = sum(name in d[1] for d in own)
                alone = sum(d[1] == name for d in own)
                left = [d for d in left if name not in d[1]]
                shapley[part, name] += len(gone)
                out.append([part, order, step, len(left), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)])
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in out)


def fixture():
    pick = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(pick.choices(words, k=pick.randint(80, 130))) for _ in range(25)]
    texts += [" ".join(f"u{i}" for i in range(n)) for n in (99, 100, 101)]
    texts += [" ".join([*(f"u{i}" for i in range(distinct)), *["u0"] * (100 - distinct)]) for distinct in (79, 80, 81)]
    texts += ["A" * n + "é" * (100 - n) for n in (9, 10, 11)]
    texts += [None, "", " \t\n\x0b\x0c\r ", "a|b", "a\x1cb\xa0c", "汉字 " * 120, "Ab#c " * 30_000, "x " * 60_000]
    rows = [(i, text, pick.choice(["en", "de", None, ""])) for i, text in enumerate(texts)]
    rows += [(1000 + i, pick.choice(texts), pick.choice(["en", None])) for i in range(40)]
    rows += [(None, "a|b", "en"), (None, "alone", "en"), (5, texts[5], "de"), (5, "other", "en"), (-1, texts[0], "xx")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in [*range(0, 30), *range(1000, 1030)]]
    return rows, [*labels, (5, 1, 0), (5, 0, 1), (None, 1, 1)]


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_matches_brute_force(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    docs = docs.selectExpr("*", "1 as part", "'x' as good", "2 as failed")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = fa.audited(docs, marks).select(COLUMNS).collect()
    assert sorted(map(tuple, found)) == brute(rows, labels)


def test_hot_text_and_missing_ids(spark):
    rows = [(i, "the same", "en") for i in range(300)] + [(None, "the same", "en")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = fa.audited(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).select(COLUMNS).collect()
    assert sorted(map(tuple, found)) == brute(rows, [])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fa.audited(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_positional_popcounts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 100, 9999):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64)
        assert fa.positional_popcounts(words).tolist() == [int((words >> np.uint64(i) & np.uint64(1)).sum()) for i in range(32)]
