"""Jaccard self-join of word n-gram sets by PartEnum signatures.

A document's set is its distinct shingles of ``width`` words, lower-cased in A-Z. Sets fall into bands of
sizes such that sets as similar as the threshold are in one band or in two neighbouring ones. Two such sets
whose larger one is in a band of sizes up to r differ in at most k = 2r (1 - t) / (1 + t) elements. For each
band the domain of all shingles is partitioned by a hash into k // 2 + 1 parts, so that in one part the two
differ in at most one element, and each part into CELLS cells; all cells of that part but one then agree.
A set's signatures are the hashes of its content in every part less one cell, for its own band and the
next: linked sets share one, without exception.

1. Distinct sets (128 bits and their size) stand for their documents. Every task sends the signatures of
   each set once; after one shuffle by signature only those that several sets share are kept.
2. A set's head is the smallest set of any of its signatures. Sets of one head are dealt into blocks of
   about ROOM shingles, and all sets of a block, and its head, are compared. That joins nearly all of a
   group at a cost in proportion to it.
3. The sets of a signature that several blocks and components share are looked at together; what may be linked
   across is tied into clusters, a row for each set and signature at most. In a cluster the pairs of its blocks are
   compared, or of MANY groups of its blocks if it has more, so that a set is sent MANY times at most. A signature
   of many blocks is refined first by a second, independent partitioning: linked sets also share a signature of that.

Blocks are compared in two steps. The first sees only summaries: the content hash of some cells of every
set, a quarter to half as many as its shingles; sets differ in at least as many elements as cells, which
rules out most pairs that share no more than a passage. Only sets with a possible partner are then sent
whole: intersections are products of incidence matrices inside a task, and what leaves it is one link from
each set to the least one it is connected with. So no step lists the pairs of a group, each set is sent at
most once for each pair of blocks, and every link is confirmed on full sets. With ``count_links`` all blocks that meet are compared and the links are counted,
which takes the square of a group's different sets.

Defined cases: null, empty and blank texts have the empty set and are linked with nothing; a text of fewer
words is one shingle; rows that share a doc_id are one document, which any of their sets links; rows without
doc_id are reported with their size and neither component nor links; an empty table gives no rows; other
columns are ignored. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import NO_ID, blocks, ids_back, mix, partitions_for, python_docs, spans_of, tabled
from daytally.llm.components import components
from daytally.llm.sketch_dedup import shingle_hashes

#: Cells of a part; a signature leaves one out.
CELLS = 3
#: Shingles of the sets of one block.
ROOM = 60_000
#: A signature that meets in more blocks than this is refined; the blocks of a cluster are compared as so many groups at most.
MANY = 32
#: Entries of an incidence matrix.
ENTRIES = 2_000_000
#: Bytes of summaries that are looked at together; a signature is never cut.
SUMMARIES = 16_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Bands:
    """Bands of set sizes and the partitioning that each of them has."""

    def __init__(self, percent: int):
        low, self.lows, self.parts = 1, [], []
        while low < 1 << 40:
            high = low * 100 // percent
            apart = 2 * high * (100 - percent) // (100 + percent)
            self.lows.append(low)
            # Sets that may not differ at all are equal, and need no signature.
            self.parts.append(apart // 2 + 1 if apart else 0)
            low = high + 1
        self.lows, self.parts = np.array(self.lows), np.array(self.parts)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1


def signatures(sets: list[np.ndarray], bands: Bands, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets, none of them empty, and for each its set's position."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat, owner, band = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), bands.of(sizes)
    found, owners = [], []
    for step in (0, 1):
        scheme = band + step
        parts = bands.parts[scheme]
        starts = np.cumsum(parts) - parts
        tags = mix((scheme.astype(np.uint64) << np.uint64(32)) + np.uint64(2 * seed + 1))
        placed = mix(flat ^ tags[owner])
        cell = ((placed >> np.uint64(32)) * (parts[owner] * CELLS).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        used = parts[owner] > 0
        content = np.zeros((int(parts.sum()), CELLS), np.uint64)
        np.add.at(content.reshape(-1), (starts[owner] * CELLS + cell)[used], mix(placed[used] + _ODD))
        whose = np.repeat(np.arange(len(sets)), parts)
        part = np.arange(len(whose)) - starts[whose]
        for left_out in range(CELLS):
            key = tags[whose] + (part * CELLS + left_out).astype(np.uint64)
            for cell in range(CELLS):
                if cell != left_out:
                    key = mix(key + content[:, cell])
            found.append(key)
            owners.append(whose)
    return np.concatenate(found), np.concatenate(owners)


def prints(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent sums over a set."""
    first, second = shingles.sum(dtype=np.uint64), mix(shingles ^ _ODD).sum(dtype=np.uint64)
    return int(first.view(np.int64)), int(second.view(np.int64))


def summaries(sets: list[np.ndarray]) -> list[bytes | None]:
    """Content hashes (16 bits) of 2^level cells of each set; neighbouring cells add up to those of the level below."""
    sizes = np.array([len(x) for x in sets], np.int64)
    levels = np.maximum(4, np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64) - 1)
    lengths = np.where(sizes > 0, 1 << levels, 0)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(sets)), sizes)
    content = np.zeros(int(lengths.sum()), np.uint16)
    if len(owner):
        placed = mix(np.concatenate(sets) + _ODD)
        cell = placed >> (64 - levels[owner]).astype(np.uint64)
        np.add.at(content, starts[owner] + cell.astype(np.int64), (placed & np.uint64(0xFFFF)).astype(np.uint16))
    return [content[start : start + length].tobytes() if length else None for start, length in zip(starts.tolist(), lengths.tolist(), strict=True)]


def possible(first: pd.DataFrame, second: pd.DataFrame, percent: int, any_root: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which sets of either side may be linked with one of the other, by n, root and summary."""
    hits = [np.zeros(len(first), bool), np.zeros(len(second), bool)]
    sides = []
    for side in (first, second):
        cells = [np.frombuffer(x, np.uint16) for x in side["summary"]]
        sides.append((cells, np.array([len(x).bit_length() - 1 for x in cells], np.int64), side["n"].to_numpy(), side["root"].to_numpy(), side["node"].to_numpy()))
    for level in np.unique(np.concatenate([sides[0][1], sides[1][1]])).tolist():
        # Sizes of linked sets differ by less than a factor of two, or by more where the threshold is low.
        chosen = [np.flatnonzero(levels >= level) for _, levels, *_ in sides]
        if not len(chosen[0]) or not len(chosen[1]):
            continue
        folded = [np.stack([cells[i].reshape(1 << level, -1).sum(axis=1, dtype=np.uint16) for i in own]) for (cells, *_), own in zip(sides, chosen, strict=True)]
        step = max(1, ENTRIES // folded[1].size)
        n, m = sides[0][2][chosen[0]], sides[1][2][chosen[1]]
        for low in range(0, len(n), step):
            size = n[low : low + step, None]
            lower, upper = np.minimum(size, m[None, :]), np.maximum(size, m[None, :])
            at = chosen[0][low : low + step]
            may = 100 * lower >= percent * upper
            may &= np.minimum(sides[0][1][at][:, None], sides[1][1][chosen[1]][None, :]) == level
            may &= sides[0][4][at][:, None] != sides[1][4][chosen[1]][None, :]
            if not any_root:
                may &= sides[0][3][at][:, None] != sides[1][3][chosen[1]][None, :]
            apart = (folded[0][low : low + step, None, :] != folded[1][None, :, :]).sum(axis=2)
            may &= apart <= (lower + upper) * (100 - percent) // (100 + percent)
            hits[0][at] |= may.any(axis=1)
            hits[1][chosen[1]] |= may.any(axis=0)
    return hits[0], hits[1]


def possible_pairs(frame: pd.DataFrame, percent: int, any_root: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of one signature (neighbours in the frame; all rows without that column), from different
    blocks, and components unless ``any_root``, whose sets may be linked, some at a time; with a column side also
    from different sides, unless ka = kb."""
    cells = [np.frombuffer(x, np.uint16) for x in frame["summary"]]
    levels = np.array([len(x).bit_length() - 1 for x in cells], np.int64)
    n, root, block = (frame[name].to_numpy() for name in ("n", "root", "block"))
    if "side" in frame:
        side, alone = frame["side"].to_numpy(), frame["ka"].to_numpy() == frame["kb"].to_numpy()
    starts, sizes, group = runs_of(frame["sig"].to_numpy() if "sig" in frame else np.zeros(len(frame), np.int64))
    rows = np.arange(len(frame))
    if not any_root:
        # Of two sets of different components, one at least is not of the signature's most frequent component.
        names, code = np.unique(root, return_inverse=True)
        held, code, times = np.unique(group * len(names) + code, return_inverse=True, return_counts=True)
        order = np.lexsort((times, held // len(names)))
        most = order[np.flatnonzero(np.diff(held[order] // len(names), append=len(starts)))]
        rows = rows[~np.isin(code, most)]
    place = np.zeros(len(frame), np.int64)
    for low, high in spans_of(np.cumsum(sizes[group[rows]]) // ENTRIES):
        count = sizes[group[rows[low:high]]]
        one = np.repeat(rows[low:high], count)
        two = starts[group[one]] + np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count)
        may = block[one] != block[two]
        if not any_root:
            may &= root[one] != root[two]
        if "side" in frame:
            may &= alone[one] | (side[one] != side[two])
        one, two = one[may], two[may]
        near = 100 * np.minimum(n[one], n[two]) >= percent * np.maximum(n[one], n[two])
        one, two = one[near], two[near]
        depth = np.minimum(levels[one], levels[two])
        for level in np.unique(depth).tolist():
            first, second = one[depth == level], two[depth == level]
            used = np.unique(np.concatenate([first, second]))
            place[used] = np.arange(len(used))
            folded = np.stack([cells[i].reshape(1 << level, -1).sum(axis=1, dtype=np.uint16) for i in used.tolist()])
            span = max(1, ENTRIES >> level)
            for start in range(0, len(first), span):
                a, b = first[start : start + span], second[start : start + span]
                apart = (folded[place[a]] != folded[place[b]]).sum(axis=1)
                close = apart <= (n[a] + n[b]) * (100 - percent) // (100 + percent)
                yield a[close], b[close]


def runs_of(*values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal neighbours, and the run of each place."""
    new = np.ones(len(values[0]), bool)
    new[1:] = np.logical_or.reduce([own[1:] != own[:-1] for own in values])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(new)))
    return starts, sizes, np.repeat(np.arange(len(starts)), sizes)


def whole_runs(frames: Iterator[pd.DataFrame], *names: str) -> Iterator[pd.DataFrame]:
    """The rows of frames in order of some columns, with all rows of their values in one frame."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        values = [frame[name].to_numpy() for name in names]
        cut = int(runs_of(*values)[0][-1])
        if held and last != [own[0] for own in values]:
            yield pd.concat(held, ignore_index=True)
            held = []
        if cut:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = []
        held.append(frame.iloc[cut:])
        last = [own[-1] for own in values]
    if held:
        yield pd.concat(held, ignore_index=True)


def summary_runs(frames: Iterator[pd.DataFrame], name: str) -> Iterator[pd.DataFrame]:
    """Whole runs of ``name``, about SUMMARIES bytes of them at a time."""
    for frame in whole_runs(frames, name):
        starts, _, group = runs_of(frame[name].to_numpy())
        part = (np.cumsum(frame["summary"].str.len().to_numpy(np.int64)) // SUMMARIES)[starts][group]
        for low, high in spans_of(part):
            yield frame.iloc[low:high].reset_index(drop=True)


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, fp1, fp2 and summary (null for the empty set) of every row."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            sets = shingle_hashes(frame["text"].tolist(), width)
            marks = [prints(x) for x in sets]
            columns = {"doc_id": frame["doc_id"], "n": [len(x) for x in sets], "fp1": [a for a, _ in marks], "fp2": [b for _, b in marks]}
            yield pd.DataFrame({**columns, "summary": summaries(sets)})

    return python_docs(docs).mapInPandas(read, "doc_id long, n long, fp1 long, fp2 long, summary binary")


def signature_rows(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """sig and node (the set's first fingerprint); a task sends a set once however many rows have it."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        for frame in blocks(frames):
            fresh, nodes = [], []
            for own in shingle_hashes(frame["text"].tolist(), width):
                if len(own) and (mark := prints(own)) not in seen:
                    seen.add(mark)
                    fresh.append(own)
                    nodes.append(mark[0])
            if fresh:
                keys, owners = signatures(fresh, bands)
                yield pd.DataFrame({"sig": keys.view(np.int64), "node": np.array(nodes, np.int64)[owners]})

    known = python_docs(docs).where(F.col("doc_id") != NO_ID)
    return known.mapInPandas(read, "sig long, node long")


def shared(rows: DataFrame) -> DataFrame:
    """sig, node, centre (the smallest node) of signatures that several nodes have, each node once."""

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(frames, "sig"):
            sig, node = frame["sig"].to_numpy(), frame["node"].to_numpy()
            several = runs_of(sig)[1]
            take = np.repeat(several > 1, several)
            sig, node = sig[take], node[take]
            if not len(sig):
                continue
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            first = runs_of(sig, node)[0]
            sig, node = sig[first], node[first]
            starts, sizes, group = runs_of(sig)
            take = sizes[group] > 1
            yield pd.DataFrame({"sig": sig[take], "node": node[take], "centre": node[starts][group][take]})

    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # In order of one number alone, which Spark sorts by its bytes; nodes are ordered below.
    dealt = rows.repartition(count, "sig").sortWithinPartitions("sig")
    return dealt.mapInPandas(runs, "sig long, node long, centre long")


def intersections(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    sizes = [np.array([len(x) for x in sets], np.int64) for sets in (first, second)]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    vocabulary, place = np.unique(np.concatenate([*first, *second]), return_inverse=True)
    places = [place[: len(owners[0])], place[len(owners[0]) :]]
    both = np.ones(len(vocabulary), bool)
    for own in places:
        there = np.zeros(len(vocabulary), bool)
        there[own] = True
        both &= there
    number = np.cumsum(both) - 1
    kept = [(owner[both[own]], number[own[both[own]]]) for owner, own in zip(owners, places, strict=True)]
    counts = np.zeros((len(first), len(second)), np.float64)
    step = max(1, ENTRIES // max(len(first), len(second)))
    for low in range(0, int(both.sum()), step):
        parts = []
        for (owner, at), sets in zip(kept, (first, second), strict=True):
            matrix = np.zeros((len(sets), step), np.float32)
            here = (at >= low) & (at < low + step)
            matrix[owner[here], at[here] - low] = 1
            parts.append(matrix)
        counts += parts[0] @ parts[1].T
    return counts.astype(np.int64)


def connected(links: np.ndarray) -> np.ndarray:
    """For each row and then each column of a matrix of links, the least position that it is connected with."""
    rows, columns = np.arange(links.shape[0]), np.arange(links.shape[1]) + links.shape[0]
    while True:
        far = links.shape[0] + links.shape[1]
        new_rows = np.minimum(rows, np.where(links, columns, far).min(axis=1, initial=far))
        new_columns = np.minimum(columns, np.where(links, new_rows[:, None], far).min(axis=0, initial=far))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return np.concatenate([rows, columns])
        rows, columns = new_rows, new_columns


def tied(least: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each position the least that it is connected with, given those so far and more links."""
    while True:
        low = np.minimum(least[one], least[two])
        new = least.copy()
        np.minimum.at(new, least[one], low)
        np.minimum.at(new, least[two], low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def possible_rows(needed: DataFrame, nodes: DataFrame, percent: int, any_root: bool) -> DataFrame:
    """The rows of ``needed`` whose set may be linked with another of its (ka, kb), as ``compared`` takes them."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in summary_runs(frames, "sig"):
            hit = np.zeros(len(frame), bool)
            for one, two in possible_pairs(frame, percent, any_root):
                hit[one] = hit[two] = True
            yield frame.loc[hit, ["ka", "kb", "side", "node", "root", "block"]]

    rows = needed.join(nodes.select("node", "n", "summary"), "node").withColumn("sig", F.xxhash64("ka", "kb"))
    dealt = rows.repartition(partitions_for(rows.sparkSession, 1), "sig").sortWithinPartitions("sig")
    return dealt.mapInPandas(keep, "ka long, kb long, side int, node long, root long, block long").distinct()


def links_in(frame: pd.DataFrame, percent: int, count_links: bool) -> np.ndarray:
    """a, b and number of links of all (ka, kb) of a frame, ENTRIES of a matrix at a time."""
    frame = frame.drop_duplicates(["ka", "kb", "side", "node", "fp2", "rep"])
    ka, kb, side, n, rep, root, block, copies = (frame[name].to_numpy() for name in ("ka", "kb", "side", "n", "rep", "root", "block", "copies"))
    sets = [np.asarray(x) for x in frame["shingles"]]
    found = [np.empty((0, 3), np.int64)]
    starts, sizes, _ = runs_of(ka, kb)
    for low, high in zip(starts.tolist(), (starts + sizes).tolist(), strict=True):
        alone = ka[low] == kb[low]
        own = np.arange(low, high)
        first, second = (own, own) if alone else (own[side[low:high] == 0], own[side[low:high] == 1])
        if not len(first) or not len(second):
            continue
        nodes = rep[np.concatenate([first, second])]
        least = np.arange(len(nodes))
        other, there = [sets[i] for i in second.tolist()], len(first) + np.arange(len(second))
        step = max(1, ENTRIES // len(second))
        for begin in range(0, len(first), step):
            own = first[begin : begin + step]
            same = intersections([sets[i] for i in own.tolist()], other)
            links = 100 * same >= percent * (n[own][:, None] + n[second][None, :] - same)
            links &= (rep[own][:, None] != rep[second][None, :]) & (block[own][:, None] != block[second][None, :])
            if not count_links:
                links &= root[own][:, None] != root[second][None, :]
            here = np.concatenate([begin + np.arange(len(own)), there])
            least = tied(least, here, here[connected(links)])
            if count_links:
                found.append(np.stack([rep[own], rep[own], links @ copies[second]], axis=1))
                if not alone:
                    found.append(np.stack([rep[second], rep[second], copies[own] @ links], axis=1))
        pairs = np.stack([nodes, nodes[least], np.zeros_like(nodes)], axis=1)
        found.append(pairs[nodes != nodes[least]])
    return np.concatenate(found)


def compared(needed: DataFrame, sets: DataFrame, percent: int, count_links: bool = False) -> DataFrame:
    """Links found in comparing the sets of side 0 of each (ka, kb) with those of side 1, or with each other if ka = kb.

    ``needed`` has ka, kb, side, node, root and block; pairs of one block are skipped, and of one root unless links are counted.
    Gives a, b (reps that are connected) and, with a = b, the number of documents linked to it here.
    """

    def links_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(frames, "ka", "kb"):
            yield pd.DataFrame(links_in(frame, percent, count_links), columns=["a", "b", "n_links"])

    dealt = needed.join(sets, "node").repartition(partitions_for(needed.sparkSession, 1), "ka", "kb").sortWithinPartitions("ka", "kb")
    return dealt.mapInPandas(links_of, "a long, b long, n_links long")


def candidate_sets(docs: DataFrame, nodes: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """node, fp2, n, rep, copies and shingles of those of the ``nodes`` that are in ``chosen``."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int, int]] = set()
        for frame in blocks(frames):
            take, found = [], []
            for i, own in enumerate(shingle_hashes(frame["text"].tolist(), width)):
                mark = (*prints(own), int(frame["doc_id"].iloc[i]))
                if mark[:2] == (frame["node"].iloc[i], frame["fp2"].iloc[i]) and mark not in seen:
                    seen.add(mark)
                    take.append(i)
                    found.append(own.view(np.int64))
            rows = frame.iloc[take][["node", "fp2", "n", "doc_id", "copies"]].rename(columns={"doc_id": "rep"})
            yield rows.assign(shingles=found)

    wanted = nodes.join(chosen.select("node").distinct(), "node").select(F.col("rep").alias("doc_id"), "node", "fp2", "n", "copies")
    texts = python_docs(docs).join(wanted, "doc_id")
    return texts.mapInPandas(read, "node long, fp2 long, n long, rep long, copies long, shingles array<long>")


def in_blocks(classes: DataFrame, members: DataFrame) -> DataFrame:
    """The classes that share a signature, with head (their smallest centre) and block."""
    heads = members.groupBy("node").agg(F.min("centre").alias("head"))
    headed = classes.withColumnRenamed("fp1", "node").join(heads, "node")
    weights = headed.groupBy("head").agg(F.ceil(F.sum("n") / ROOM).alias("slices"))
    slice_ = F.pmod(F.xxhash64("node"), F.col("slices"))
    return headed.join(weights, "head").withColumn("block", F.xxhash64("head", slice_)).drop("slices")


def refined(members: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """sig and node of the members, each signature split by those of a second partitioning."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                keys, owners = signatures([np.asarray(x).view(np.uint64) for x in frame["shingles"]], bands, seed=1)
                old = frame["sig"].to_numpy()[owners].view(np.uint64)
                yield pd.DataFrame({"sig": mix(keys + mix(old)).view(np.int64), "node": frame["node"].to_numpy()[owners]})

    found = members.join(sets.select("node", "shingles"), "node").select("sig", "node", "shingles")
    return shared(found.mapInPandas(read, "sig long, node long")).select("sig", "node")


def meeting(docs: DataFrame, members: DataFrame, nodes: DataFrame, summed: DataFrame, width: int, bands: Bands, percent: int, count_links: bool) -> DataFrame:
    """ka <= kb, side, node, root, block: sets of clusters by pairs of blocks, or of groups of blocks, that have a possible
    partner there; unless links are counted, of another component.

    The sets of a signature are looked at together, by their summaries. All that leaves such a task is one tie for a set
    at most, whatever number of signatures and partners it has.
    """

    def mixed(found: DataFrame) -> DataFrame:
        placed = found.select("sig", "node").join(nodes.select("node", "block", "root"), "node")
        per = placed.groupBy("sig").agg(F.count_distinct("block").alias("blocks"), F.min("root").alias("least"), F.max("root").alias("most"))
        per = per.where("blocks > 1" if count_links else "blocks > 1 and least < most")
        return placed.join(per.select("sig", "blocks"), "sig")

    def ties(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in summary_runs(frames, "sig"):
            node, place = np.unique(frame["node"].to_numpy(), return_inverse=True)
            least = np.arange(len(node))
            for one, two in possible_pairs(frame, percent, count_links):
                least = tied(least, place[one], place[two])
            far = node[least] != node
            yield pd.DataFrame({"a": node[far], "b": node[least][far]})

    def across(placed: DataFrame) -> DataFrame:
        rows = placed.select("sig", "node", "block", "root").join(summed.select("node", "n", "summary"), "node")
        dealt = rows.repartition(partitions_for(docs.sparkSession, 1), "sig").sortWithinPartitions("sig")
        return dealt.mapInPandas(ties, "a long, b long")

    placed = tabled(mixed(members), "join-mixed")
    found = across(placed.where(F.col("blocks") <= MANY))
    many = placed.where(F.col("blocks") > MANY).select("sig", "node")
    if not many.isEmpty():
        sets = tabled(candidate_sets(docs, nodes, many, width), "join-sets")
        found = found.union(across(mixed(refined(many, sets, bands))))
    clusters = components(found).withColumnRenamed("root", "cluster")
    return possible_rows(by_cluster(clusters.join(nodes.select("node", "block", "root"), "node")), summed, percent, count_links)


def by_cluster(members: DataFrame) -> DataFrame:
    """ka <= kb, side, node, root, block: every set of a cluster with each of its blocks but the own, or each group of them."""
    members = tabled(members, "join-clusters")
    per = members.groupBy("cluster").agg(F.count_distinct("block").alias("blocks"))
    group = F.xxhash64("cluster", F.pmod(F.xxhash64("block"), F.lit(MANY)))
    placed = members.join(per, "cluster").withColumn("grouped", F.col("blocks") > MANY).withColumn("part", F.when(F.col("grouped"), group).otherwise(F.col("block")))
    others = placed.select("cluster", F.col("part").alias("other")).distinct()
    paired = placed.join(others, "cluster").where("grouped or part <> other")
    return paired.select(
        F.least("part", "other").alias("ka"), F.greatest("part", "other").alias("kb"), (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "root", "block"
    )


def joined(docs: DataFrame, width: int = 5, threshold: float = 0.8, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, linked when similarity >= threshold (to a hundredth).

    With ``count_links`` also n_links: the other rows with doc_id whose sets are linked with the row's or equal.
    """
    percent = round(100 * threshold)
    bands = Bands(percent)
    rows = tabled(fingerprints(docs, width), "join-rows")
    usable = rows.where((F.col("n") > 0) & (F.col("doc_id") != NO_ID))
    key = ["fp1", "fp2", "n"]
    classes = tabled(usable.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("summary").alias("summary")), "join-classes")
    members = tabled(shared(signature_rows(docs, width, bands)), "join-members")
    nodes = tabled(in_blocks(classes, members), "join-nodes")

    def links_between(likely: DataFrame) -> DataFrame:
        likely = tabled(likely, "join-likely")
        sets = tabled(candidate_sets(docs, nodes, likely, width), "join-sets")
        return tabled(compared(likely, sets, percent, count_links), "join-links")

    # Every block by itself and with its head; when links are counted, a head's block is met later.
    inside = nodes.select(F.col("block").alias("ka"), "node")
    if not count_links:
        inside = inside.union(nodes.select("block", "head")).distinct()
    inside = inside.select("ka", F.col("ka").alias("kb"), F.lit(0).alias("side"), "node", F.col("node").alias("root"), F.col("node").alias("block"))
    found = links_between(possible_rows(inside, nodes, percent, count_links))

    # Rows that share a doc_id but not the set tie their classes.
    named = rows.drop("summary").join(classes.drop("summary"), key, "left")
    repeated = named.where(F.col("rep").isNotNull()).groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    same = named.join(repeated, "doc_id").select(F.col("rep").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()

    roots = tabled(components(found.where("a <> b").select("a", "b").union(same)), "join-roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = tabled(rooted.select("rep", "node", "fp2", "n", "copies", "block", F.coalesce("root", "rep").alias("root")), "join-rooted")
    across = links_between(meeting(docs, members, rooted, nodes, width, bands, percent, count_links))
    more = across.where("a <> b").select("a", "b")
    roots = components(more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    named = named.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    missing = F.col("doc_id") == NO_ID
    component = F.when(~missing, F.coalesce("root", "rep", "doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")]
    if count_links:
        counts = found.union(across).where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n_links").alias("linked"))
        named = named.join(counts, "rep", "left")
        columns.append(F.when(~missing, F.coalesce(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)), F.lit(0))).alias("n_links"))
    return ids_back(named.select(*columns))
