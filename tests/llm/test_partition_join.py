import random

import numpy as np
import pandas as pd
import pytest

from daytally.llm import partition_join as pj
from tests.llm.test_sketch_dedup import fixture, near_copies, shingles


def brute(rows, width, percent):
    sets = [shingles(text, width) for _, text in rows]
    root = {doc: doc for doc, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    counts = [0] * len(rows)
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and a is not None and rows[j][0] is not None and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                counts[i] += 1
                counts[j] += 1
                x, y = find(a), find(rows[j][0])
                root[max(x, y)] = min(x, y)
    key = lambda row: tuple((x is not None, x) for x in row)
    return sorted(((doc, len(s), None if doc is None else find(doc), None if doc is None else n) for (doc, _), s, n in zip(rows, sets, counts)), key=key)


def chains():
    """Groups in which neighbours link and others do not, of sizes around the edges of bands, and boilerplate."""
    pick = random.Random(11)
    words = [f"c{i}" for i in range(900)]
    for size in (30, 60, 200):
        for at in range(0, 12):
            yield " ".join(words[at * size // 18 : at * size // 18 + size])
    passage = " ".join(f"p{i}" for i in range(80))
    for i in range(40):
        yield passage + " " + " ".join(f"q{pick.randint(0, 9999)}" for _ in range(pick.randint(5, 60)))


@pytest.mark.parametrize("room, many", [(60_000, 32), (600, 1)])
def test_matches_brute_force(spark, monkeypatch, room, many):
    monkeypatch.setattr(pj, "ROOM", room)
    monkeypatch.setattr(pj, "MANY", many)
    texts = [text for _, text in fixture()] + list(chains()) + list(near_copies(60, 14, 90, 5))
    rows = list(enumerate(texts)) + [(3000 + i, texts[17]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, 4, 85)
    assert sorted(map(tuple, pj.joined(docs, 4, 0.85).collect())) == [row[:3] for row in want]
    if many == 1:
        assert sorted(map(tuple, pj.joined(docs, 4, 0.85, count_links=True).collect())) == want


def test_other_width(spark):
    rows = fixture()[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, pj.joined(docs, 5, 0.7).collect())) == [row[:3] for row in brute(rows, 5, 70)]


def test_odd_rows(spark):
    first, second = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, None), (2, first), (2, first), (3, first + " x"), (None, first), (None, None), (-5, first), (9, second), (3, second + " y"), (12, "")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, n int")
    found = sorted(map(tuple, pj.joined(docs).collect()), key=repr)
    n, m = 36, 46
    assert found == sorted(
        [(1, 0, 1), (2, n, -5), (2, n, -5), (3, n + 1, -5), (None, n, None), (None, 0, None), (-5, n, -5), (9, m, -5), (3, m + 1, -5), (12, 0, 12)], key=repr
    )
    assert pj.joined(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_linked_sets_share_a_signature(percent):
    """Whatever the sizes, also at the very threshold."""
    rng = np.random.default_rng(percent)
    bands = pj.Bands(percent)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        own = rng.integers(0, 2**63, size, dtype=np.uint64)
        less = int(rng.integers(0, size // 3 + 1))
        more = rng.integers(0, 2**63, int(rng.integers(0, size // 3 + 1)), dtype=np.uint64)
        other = np.concatenate([own[less:], more])
        same, either = size - less, size + len(more)
        if not len(other) or 100 * same < percent * either or same == either:
            continue
        for seed in (0, 1):
            keys, owners = pj.signatures([np.sort(own), np.sort(other)], bands, seed)
            assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


@pytest.mark.parametrize("percent", [50, 85])
def test_summaries_rule_out_no_link(percent):
    """Pairs at the very threshold and beyond a level stay possible; sets with little in common do not."""
    rng = np.random.default_rng(percent)
    for _ in range(200):
        size = int(rng.integers(1, 3000))
        own = rng.integers(0, 2**63, size, dtype=np.uint64)
        less = int(rng.integers(0, size * (100 - percent) // 100 + 1))
        other = np.concatenate([own[less:], rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 1)), dtype=np.uint64)])
        far = np.concatenate([own[: size // 4], rng.integers(0, 2**63, size - size // 4, dtype=np.uint64)])
        sides = [pd.DataFrame({"node": [i], "root": [i], "n": [len(x)], "summary": pj.summaries([x])}) for i, x in enumerate((own, other, far))]
        if 100 * (size - less) >= percent * len(np.union1d(own, other)):
            assert pj.possible(sides[0], sides[1], percent, False)[0].all()
        if percent == 85 and size > 60:
            assert not pj.possible(sides[0], sides[2], percent, False)[0].any()


def test_intersections():
    rng = np.random.default_rng(3)
    first = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(20)]
    second = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in second] for a in first]
    assert pj.intersections(first, second).tolist() == want


def test_pairs_of_a_signature_are_those_that_summaries_allow():
    """Every pair of different blocks and roots that may be linked, and no others."""
    rng = np.random.default_rng(7)
    core = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = [np.concatenate([core[int(rng.integers(0, 60)) :], rng.integers(0, 2**63, int(rng.integers(0, 40)), dtype=np.uint64)]) for _ in range(60)]
    frame = pd.DataFrame({"node": range(60), "n": [len(x) for x in sets], "root": rng.integers(0, 3, 60), "block": rng.integers(0, 4, 60), "summary": pj.summaries(sets)})
    for any_root in (False, True):
        got = {tuple(sorted(pair)) for a, b in pj.possible_pairs(frame, 85, any_root) for pair in zip(a.tolist(), b.tolist())}
        want = set()
        for i in range(60):
            for j in range(i):
                apart = frame["block"][i] != frame["block"][j] and (any_root or frame["root"][i] != frame["root"][j])
                if apart and pj.possible(frame.iloc[[j]], frame.iloc[[i]], 85, any_root)[0].any():
                    want.add((j, i))
        assert got == want and want


def test_rows_of_a_shared_signature_are_not_multiplied_by_its_blocks(spark):
    """One signature of 30 blocks with unlike sets: nothing is listed for pairs of blocks."""
    rng = np.random.default_rng(9)
    sets = [rng.integers(0, 2**63, 80, dtype=np.uint64) for _ in range(30)]
    rows = [(i, 0, 80, i, 1, 100 + i, i, x) for i, x in enumerate(pj.summaries(sets))]
    nodes = spark.createDataFrame(rows, "node long, fp2 long, n long, rep long, copies long, block long, root long, summary binary")
    members = spark.createDataFrame([(7, i) for i in range(30)], "sig long, node long")
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = pj.meeting(docs, members, nodes, nodes, 4, pj.Bands(85), 85, False)
    assert found.count() == 0
    assert " Inner, (NOT (block" not in found._jdf.queryExecution().toString()


def test_many_signatures_are_looked_at_together():
    """Pairs of a frame of many signatures are those of each signature by itself, however the rows come in frames."""
    rng = np.random.default_rng(5)
    core = rng.integers(0, 2**63, 90, dtype=np.uint64)
    sets = [np.concatenate([core[int(rng.integers(0, 20)) :], rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)]) for _ in range(150)]
    sig = np.sort(rng.integers(0, 40, 150))
    frame = pd.DataFrame({"sig": sig, "node": range(150), "n": [len(x) for x in sets], "root": rng.integers(0, 3, 150), "block": rng.integers(0, 4, 150), "summary": pj.summaries(sets)})
    pairs = lambda own, any_root: {tuple(sorted(x)) for a, b in pj.possible_pairs(own, 85, any_root) for x in zip(own["node"].to_numpy()[a].tolist(), own["node"].to_numpy()[b].tolist())}
    for any_root in (False, True):
        want = set().union(*(pairs(own.drop(columns="sig"), any_root) for _, own in frame.groupby("sig")))
        assert pairs(frame, any_root) == want and want
    for step in (1, 7, 150):
        parts = list(pj.whole_runs((frame.iloc[i : i + step] for i in range(0, 150, step)), "sig"))
        assert pd.concat(parts, ignore_index=True).equals(frame)
        assert sum(own["sig"].nunique() for own in parts) == frame["sig"].nunique()


def test_signatures_are_not_looked_at_group_by_group(spark):
    """A Python group for each signature or block took most of the time; now a task takes many at once."""
    sets = [np.arange(i, i + 80, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(4)]
    rows = [(i, 0, 80, i, 1, 100 + i, i, x) for i, x in enumerate(pj.summaries(sets))]
    nodes = spark.createDataFrame(rows, "node long, fp2 long, n long, rep long, copies long, block long, root long, summary binary")
    members = spark.createDataFrame([(7, i) for i in range(4)], "sig long, node long")
    found = pj.meeting(spark.createDataFrame([], "doc_id long, text string"), members, nodes, nodes, 4, pj.Bands(85), 85, False)
    assert {(row.ka, row.kb) for row in found.collect()} >= {(100, 101), (101, 102), (102, 103)}
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().toString()


def meeting_of(spark, sets, sigs, roots=None):
    """Rows that meet, of sets of a block each that all share the signatures; and the rows that leave the tasks on signatures."""
    rows = [(i, 0, len(x), i, 1, 100 + i, i if roots is None else roots[i], summary) for i, (x, summary) in enumerate(zip(sets, pj.summaries(sets)))]
    nodes = spark.createDataFrame(rows, "node long, fp2 long, n long, rep long, copies long, block long, root long, summary binary")
    members = spark.createDataFrame([(sig, i) for sig in range(sigs) for i in range(len(sets))], "sig long, node long")
    return pj.meeting(spark.createDataFrame([], "doc_id long, text string"), members, nodes, nodes, 4, pj.Bands(85), 85, False)


def test_a_set_is_not_listed_for_each_signature_and_partner(spark, monkeypatch):
    """20 near sets that share 40 signatures gave a row for each set, other block and signature."""
    left = []
    monkeypatch.setattr(pj, "components", lambda links, real=pj.components: left.append(links.count()) or real(links))
    sets = [np.arange(i, i + 80, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(20)]
    found = meeting_of(spark, sets, 40).collect()
    pairs = {tuple(sorted((a.node, b.node))) for a in found for b in found if (a.ka, a.kb) == (b.ka, b.kb) and a.side != b.side}
    assert pairs >= {(i, j) for j in range(20) for i in range(max(0, j - 5), j)}
    assert 19 <= left[0] <= 40 * 19


def test_a_cluster_of_many_blocks_sends_a_set_a_bounded_number_of_times(spark, monkeypatch):
    """A group of blocks meets the others and itself; no pair of blocks is lost."""
    monkeypatch.setattr(pj, "MANY", 5)
    rows = [(i, 7, 100 + i // 2, i) for i in range(60)] + [(100 + i, 8, 200 + i, i) for i in range(4)]
    found = pj.by_cluster(spark.createDataFrame(rows, "node long, cluster long, block long, root long")).collect()
    times = pd.Series([row.node for row in found]).value_counts()
    assert times[times.index < 100].max() <= 5 and set(times[times.index >= 100]) == {3}
    met = {(a.node, b.node) for a in found for b in found if (a.ka, a.kb) == (b.ka, b.kb) and a.block != b.block and (a.ka == a.kb or a.side != b.side)}
    assert met == {(a, b) for a, c, d, _ in rows for b, e, f, _ in rows if c == e and d != f}


@pytest.mark.parametrize("sides", [1, 2])
def test_large_blocks_are_compared_in_parts(monkeypatch, sides):
    """Ties and counts are the same however many entries of a matrix are held."""
    assert pj.tied(np.arange(6), np.array([5, 4, 1]), np.array([4, 1, 3])).tolist() == [0, 1, 2, 1, 1, 1]
    sets = pj.shingle_hashes([text for _, text in fixture()] + list(chains()), 4)
    sets = [x for x in {pj.prints(x): x for x in sets}.values() if len(x)]
    place = np.arange(len(sets))
    frame = pd.DataFrame({"ka": 1, "kb": sides, "side": place % sides, "node": place, "fp2": 0, "n": list(map(len, sets)), "rep": place, "root": place, "block": place, "copies": 1, "shingles": sets})
    sizes, found = [], []
    monkeypatch.setattr(pj, "intersections", lambda a, b, real=pj.intersections: sizes.append(len(a) * len(b)) or real(a, b))
    for entries in (2_000_000, 3_000):
        monkeypatch.setattr(pj, "ENTRIES", entries)
        sizes.clear()
        links = pd.DataFrame(pj.links_in(frame, 85, True), columns=["a", "b", "n"])
        assert max(sizes) <= entries and (len(sizes) > 1) == (entries == 3_000)
        found.append((links[links.a != links.b].drop_duplicates().sort_values("a").values.tolist(), links[links.a == links.b].groupby("a").n.sum().tolist()))
    assert found[0] == found[1] and sum(found[0][1]) > 100
