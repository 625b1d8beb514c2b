"""Near-duplicate groups from SetSketch registers of word shingles.

A document's set is its distinct shingles of some words, lower-cased in A-Z. Its sketch has
REGISTERS registers: the exponent, to base BASE, of the smallest of exponentially spaced values of
the set's elements under one hash each, so registers of a union are the larger of the two. Equal
sets are one class. The first BANDS * ROWS registers make bands; classes that agree in a band share
a bucket.

1. In each bucket every class is paired with the bucket's smallest class (its centre): as many pairs
   as members. Pairs whose jointly estimated similarity could reach the threshold are compared on
   their full sets, which also gives their distance to the centre.
2. Links give components. A bucket whose members are all in one component is done.
3. In the other buckets, each member is compared with its nearest partners of other components, which
   joins most of what is left of a group.
4. Where several components remain, all members of different ones are compared in blocks of BLOCK: by
   the triangle inequality on exact distances to the centre, then by the likelihood estimate from
   the registers, in the first band that they share. What is left is compared on full sets.

A pair linked at similarity 0.8 is missed with probability (1 - 0.8^ROWS)^BANDS, about 3e-6, by the
bands and as much by the estimate (MARGIN is 4.5 standard errors); other links are closer.
Shingles are told apart by 64-bit hashes, classes by 128 bits and their size.

No step lists the pairs of a group: pairs of step 1 are linear, blocks of step 4 are compared inside
a task and only pairs that may link leave it. Buckets of any size are whole.

Defined cases: null, empty and blank texts have the empty set and are linked with nothing; rows that
share a doc_id are one document, and links of any of them count for it; rows without doc_id are
reported with their size, no component, and not kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import NO_ID, blocks, ids_back, mix, partitions_for, python_docs, spans_of, tabled
from daytally.llm.components import components

REGISTERS, BASE, RATE, TOP = 512, 1.06, 20.0, 255
#: Bands and registers of a band; together the first registers.
BANDS, ROWS = 24, 4
#: A pair is verified when its estimated similarity is at most this much below the threshold.
MARGIN = 0.08
BLOCK = 1024
#: Before all such pairs, those of each member's nearest partners in these bands; most components meet there.
FIRST_BANDS, NEAREST = 4, 2

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ADD = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) << np.uint64(20)).astype(np.uint32)
_TIMES = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) << np.uint64(40)).astype(np.uint32) | np.uint32(1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts in order, and each text's number of words."""
    data = [text.encode().lower() for text in texts]
    flat = np.frombuffer(b" ".join([b"", *data, b""]), np.uint8)
    space = _SPACE[flat]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    powers = np.multiply.accumulate(np.full(len(flat), _ODD))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * powers)])
    undone = np.multiply.accumulate(np.full(len(flat), _INVERSE))
    words = mix((sums[ends] - sums[starts]) * undone[starts] + (ends - starts).astype(np.uint64))
    borders = np.cumsum([1 + len(x) for x in data])
    return words, np.diff(np.searchsorted(starts, borders, "right"), prepend=0)


def shingle_hashes(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has one, of none none."""
    words, counts = word_hashes(texts)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for place in range(width):
        rolled += words[place : place + len(rolled)] * factors[place]
    rolled = mix(rolled)
    found, at = [], 0
    for count in counts.tolist():
        if count >= width:
            own = np.sort(rolled[at : at + count - width + 1])
            found.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif count:
            whole = (words[at : at + count] * factors[:count]).sum(dtype=np.uint64) + np.uint64(count)
            found.append(mix(mix(np.array([whole], np.uint64))))
        else:
            found.append(np.empty(0, np.uint64))
        at += count
    return found


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of REGISTERS for each set that is not empty."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    least = np.empty((REGISTERS, len(sets)), np.uint32)
    for i in range(REGISTERS):
        least[i] = np.minimum.reduceat((flat ^ _ADD[i]) * _TIMES[i], starts)
    spaced = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)), 0, TOP).astype(np.uint8)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, fp1, fp2 (fingerprints of the set), registers (binary, null for the empty set)."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            sets = shingle_hashes(frame["text"].tolist(), width)
            full = [i for i, x in enumerate(sets) if len(x)]
            rows: list[bytes | None] = [None] * len(sets)
            if full:
                for i, row in zip(full, registers([sets[i] for i in full]), strict=True):
                    rows[i] = row.tobytes()
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n": [len(x) for x in sets],
                    "fp1": [int(x.sum(dtype=np.uint64).view(np.int64)) for x in sets],
                    "fp2": [int(mix(x ^ _ODD).sum(dtype=np.uint64).view(np.int64)) for x in sets],
                    "registers": rows,
                }
            )

    return python_docs(docs).mapInPandas(sketch, "doc_id long, n long, fp1 long, fp2 long, registers binary")


def similarity_estimate(first: np.ndarray, second: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from how often registers are larger, smaller and equal, and both sizes."""
    larger, smaller = (first > second).sum(axis=1), (first < second).sum(axis=1)
    equal = first.shape[1] - larger - smaller
    u, v = n / (n + m), m / (n + m)
    chance = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        same = np.clip(1 - up - down, 1e-12, 1)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)

    low, high = np.zeros(len(n)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        right = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def unpacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), REGISTERS)


def likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is at least ``least``."""
    side = lambda name: classes.select(F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                found = similarity_estimate(unpacked(frame["r_a"]), unpacked(frame["r_b"]), frame["n_a"].to_numpy(), frame["n_b"].to_numpy())
                yield frame.loc[found >= least, ["a", "b"]]

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInPandas(keep, "a long, b long")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, same, either: sizes of the intersection and the union of the full sets."""
    side = lambda name: sets.select(F.col("rep").alias(name), F.col("shingles").alias(f"s_{name}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    same = both.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).alias("same"), (F.size("s_a") + F.size("s_b")).alias("sum"))
    return same.select("a", "b", "same", (F.col("sum") - F.col("same")).alias("either"))


def shingle_sets(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """rep, shingles (distinct hashes) of the documents that stand for a class in some shared bucket."""
    chosen = python_docs(docs).join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            sets = shingle_hashes(frame["text"].tolist(), width)
            yield pd.DataFrame({"rep": frame["doc_id"], "shingles": [x.view(np.int64) for x in sets]})

    # Rows that share a doc_id are one document; its set is that of all of them.
    found = chosen.mapInPandas(read, "rep long, shingles array<long>")
    return found


def band_keys(registers: Column) -> list[Column]:
    return [F.xxhash64(F.lit(band), F.substring(registers, band * ROWS + 1, ROWS)) for band in range(BANDS)]


def block_pairs(threshold: float, few: int | None):
    """Runs of (bucket, block pair) -> pairs of members of different components that may link.

    With ``few``, each member's nearest partners only, as many as that.
    """
    room, least = 1 - threshold, threshold - MARGIN

    def pairs_of(frame: pd.DataFrame) -> pd.DataFrame | None:
        rows, comp = unpacked(frame["registers"]), frame["root"].to_numpy()
        reps, away, size = frame["rep"].to_numpy(), frame["away"].to_numpy(), frame["n"].to_numpy()
        band, own, mate = int(frame["band"].iloc[0]), frame["own"].to_numpy(), int(frame["mate"].iloc[0])
        low = int(frame["low"].iloc[0])
        left = np.flatnonzero(own == low)
        right = np.flatnonzero(own == mate)
        chunks = []
        for i in left.tolist():
            other = right[(comp[right] != comp[i]) & ((reps[right] > reps[i]) | (low != mate))]
            # Unknown distances (NaN) rule nothing out.
            other = other[~(np.abs(away[other] - away[i]) > room + 1e-9)]
            other = other[np.minimum(size[other], size[i]) >= threshold * np.maximum(size[other], size[i]) - 1e-9]
            if not len(other):
                continue
            equal = rows[other] == rows[i]
            near = equal.sum(axis=1) >= (least - 0.05) * REGISTERS
            if few:
                best = np.argsort(-equal[near].sum(axis=1), kind="stable")[:few]
                if near.any():
                    chunks.append((np.full(len(best), i), other[near][best]))
                continue
            other, equal = other[near], equal[near, : BANDS * ROWS]
            first = equal.reshape(len(other), BANDS, ROWS).all(axis=2).argmax(axis=1) if len(other) else other
            other = other[first == band]
            if len(other):
                chunks.append((np.full(len(other), i), other))
        if not chunks:
            return None
        x, y = (np.concatenate(part) for part in zip(*chunks, strict=True))
        good = similarity_estimate(rows[x], rows[y], size[x], size[y]) >= least
        x, y = reps[x[good]], reps[y[good]]
        return pd.DataFrame({"a": np.maximum(x, y), "b": np.minimum(x, y)})

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            if not len(frame):
                continue
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            names = (held["key"].astype(str) + ":" + held["low"].astype(str) + ":" + held["mate"].astype(str)).to_numpy()
            runs = spans_of(names)
            for start, end in runs[:-1]:
                if (found := pairs_of(held.iloc[start:end])) is not None:
                    yield found
            held = held.iloc[runs[-1][0] :].reset_index(drop=True)
        if held is not None and (found := pairs_of(held)) is not None:
            yield found

    return find


def residual_pairs(members: DataFrame, roots: DataFrame, classes: DataFrame, star: DataFrame, threshold: float, few: int | None = None) -> DataFrame:
    """Pairs (a, b) in buckets that hold several components, members of different ones that may link."""
    placed = members.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep")).drop("node")
    mixed = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size")).where("least < most")
    inside = placed.join(mixed.select("key", (F.col("size") / BLOCK).cast("int").alias("last")), "key")
    distance = star.select(F.col("a").alias("rep"), F.col("b").alias("centre"), (1 - F.col("same") / F.col("either")).alias("away"))
    inside = inside.join(distance, ["rep", "centre"], "left").withColumn("away", F.when(F.col("rep") == F.col("centre"), 0.0).otherwise(F.coalesce("away", F.lit(float("nan")))))
    inside = inside.join(classes.select("rep", "n", "registers"), "rep")
    inside = inside.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("last") + 1).cast("int"))
    inside = inside.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
    inside = inside.withColumns({"low": F.least("own", "with"), "mate": F.greatest("own", "with")}).drop("with", "last")
    key = ["key", "low", "mate"]
    dealt = inside.repartition(partitions_for(members.sparkSession, 1), *key).sortWithinPartitions(*key)
    return dealt.mapInPandas(block_pairs(threshold, few), "a long, b long").distinct()


def near_groups(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; linked when similarity >= threshold (to a hundredth)."""
    percent = round(100 * threshold)
    sketched = tabled(sketches(docs, width), "near-sketches")
    usable = sketched.where((F.col("n") > 0) & (F.col("doc_id") != NO_ID))
    key = ["fp1", "fp2", "n"]
    classes = tabled(usable.groupBy(*key, "registers").agg(F.min("doc_id").alias("rep")), "near-classes")
    bands = classes.select("rep", F.posexplode(F.array(*band_keys(F.col("registers")))).alias("band", "key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("members")).where("members > 1").drop("members")
    members = tabled(bands.join(buckets, "key"), "near-members")
    sets = tabled(shingle_sets(docs, members.select("rep").distinct(), width), "near-sets")
    pairs = members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    star = tabled(compared(likely(pairs, classes, threshold / 2), sets), "near-star")
    linked = lambda frame: frame.where(100 * F.col("same") >= percent * F.col("either")).select("a", "b")
    roots = tabled(components(linked(star)), "near-roots")
    tied = lambda found: components(found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    nearest = residual_pairs(members.where(F.col("band") < FIRST_BANDS), roots, classes, star, threshold, NEAREST)
    more = tabled(linked(compared(nearest, sets)), "near-links")
    if not more.isEmpty():
        roots = tabled(tied(more), "near-roots")
    more = tabled(linked(compared(residual_pairs(members, roots, classes, star, threshold), sets)), "near-links")
    if not more.isEmpty():
        roots = tied(more)
    named = sketched.join(classes.drop("registers"), key, "left").join(roots, F.col("rep") == F.col("node"), "left")
    missing = F.col("doc_id") == NO_ID
    component = F.when(~missing, F.coalesce("root", F.when(F.col("n") > 0, F.col("rep")), "doc_id"))
    named = named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    kept = (F.col("doc_id") == F.col("component_id")) & F.col("component_id").isNotNull()
    return ids_back(named.withColumn("kept", F.coalesce(kept, F.lit(False))))


def drop_near_copies(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """docs with only the smallest doc_id of each group of near copies; all columns stay as they are."""
    dropped = near_groups(docs, width, threshold).where("doc_id is not null and not kept").select(F.col("doc_id").alias("_dropped_id"))
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col("_dropped_id"), "left_anti")
