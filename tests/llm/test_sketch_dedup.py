import random

import numpy as np
import pytest

from daytally.llm import sketch_dedup as sd
from daytally.llm.components import components

SPACES = " \t\n\r\x0b\x0c"


def shingles(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=4, threshold=0.8):
    sets = [shingles(text, width) for _, text in rows]
    root = {doc: doc for doc, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= round(100 * threshold) * (len(sets[i]) + len(sets[j]) - same):
                x, y = find(a), find(rows[j][0])
                root[max(x, y)] = min(x, y)
    return sorted((doc, len(s), find(doc), doc == find(doc)) for (doc, _), s in zip(rows, sets))


def near_copies(count, changes, words=120, seed=1):
    pick = random.Random(seed)
    base = [f"w{pick.randint(0, 5000)}" for _ in range(words)]
    for _ in range(count):
        copy = list(base)
        for _ in range(pick.randint(0, changes)):
            copy[pick.randrange(words)] = f"x{pick.randint(0, 10**6)}"
        yield " ".join(copy)


def fixture():
    pick = random.Random(7)
    texts = [*near_copies(150, 9), *near_copies(60, 3, 300, 2), *near_copies(40, 30, 400, 3)]
    texts += [" ".join(f"v{pick.randint(0, 300)}" for _ in range(pick.randint(0, 60))) for _ in range(100)]
    texts += ["", " \n", "one two", "ONE\ttwo", "one two three", "a b c d", "A B C D", "é É", "É É", "word " * 20_000, "word " * 19_000, "\x1c \xa0x"]
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [1024, 16])
def test_components_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sd, "BLOCK", block)
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, sd.near_groups(docs, 4, 0.8).collect())) == brute(rows)


def test_other_width(spark):
    rows = fixture()[:200]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, sd.near_groups(docs, 5, 0.7).collect())) == brute(rows, 5, 0.7)


def test_odd_rows(spark):
    rows = [(1, None), (2, "a b c d e"), (2, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (-5, "a b c d e")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rep string")
    found = sorted(map(tuple, sd.near_groups(docs).collect()), key=repr)
    assert found == sorted([(1, 0, 1, True), (2, 1, -5, False), (2, 1, -5, False), (3, 1, -5, False), (None, 1, None, False), (-5, 1, -5, True)], key=repr)
    assert sd.near_groups(docs.limit(0)).count() == 0


def test_shingles_of_any_text():
    pick = random.Random(5)
    texts = ["".join(pick.choice("aAbB éß\t\n\r\x0b\x0c\x00\x1c汉") for _ in range(pick.randint(0, 60))) for _ in range(500)]
    for width in (1, 4, 5):
        for text, found in zip(texts, sd.shingle_hashes(texts, width)):
            assert len(found) == len(shingles(text, width))
            assert (sd.shingle_hashes([text], width)[0] == found).all()


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    mine = rng.integers(0, 2**63, 900, dtype=np.uint64)
    first, second = mine[:800], mine[100:]
    both = sd.registers([first, second, mine])
    assert (np.maximum(both[0], both[1]) == both[2]).all()
    estimate = sd.similarity_estimate(both[:1], both[1:2], np.array([800]), np.array([800]))[0]
    assert abs(estimate - 700 / 900) < 0.12


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(5, 1), (5, 9), (7, 9), (2, 3)], [(100, i) for i in range(50)]])
def test_components(spark, links):
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    assert found == {k: v for k, v in root.items() if any(k in (a, b) and a != b for a, b in links)}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """A round more, only to see that nothing changes, costs seven shuffles."""
    from daytally.llm import components as module

    rounds = []
    monkeypatch.setattr(module, "_large", lambda links, real=module._large: rounds.append(1) or real(links))
    stars = [(i, i % 3) for i in range(3, 40)] + [(0, 50)]
    found = dict(map(tuple, components(spark.createDataFrame(stars, "a long, b long")).collect()))
    assert found == {i: i % 3 for i in range(40)} | {50: 0} and not rounds
    components(spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")).collect()
    assert len(rounds) == 1
