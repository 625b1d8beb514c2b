"""Language-model scores from a probabilistic suffix tree.

Symbols are the bytes of a document's tokens: words lower-cased in A-Z, a space after each, and one
end. A state is a context of up to DEPTH bytes. A context is retained when its next symbols diverge
from those of its suffix (one byte shorter): the log-likelihood ratio of its counts must exceed
DIVERGENCE for each kind of next symbol and once more. Suffixes of a retained context are retained.
The tree grows with the corpus; no context is left out for its size. A symbol is
predicted in the longest retained suffix of what precedes it; distributions are smoothed by
absolute discounting, the discounted mass going to the suffix state and at the root to all bytes
alike. They sum to one, so the score is the log10 probability of the whole token sequence.

Tree and counts are tables without bound; nothing of them is collected. Tasks write, for each bundle
of documents, its distinct (DEPTH + 1)-grams and word hashes with their training counts, and each
document's symbols. Both are summed by parts of a hash range. Grams are dealt by the
last SHARED bytes of their contexts, so all that a longer context is tested and smoothed with lies
in its part, and no table of the grams is sent for each depth. From the grams of that depth, which
the parts give, Spark derives the shorter ones, tests their contexts, and joins depth by depth until
each has its probability; the parts go on from there. Grams with their probabilities and word totals
return to their bundle, whose documents are scored there, a block of texts at a time. A bundle ends at
BUNDLE_BYTES of symbols or twice FLUSH distinct grams, which bounds what a task holds. Words are told apart
by 64-bit hashes.

``trained`` is an excerpt of the tree for a look at it in one process; scoring doesn't use it.

Defined cases: a null text counts as empty and is its end alone; repeated rows train and are scored
each; rows without doc_id train and are not held out; without training documents every byte has
probability 1/256; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally import settings
from daytally.llm import labelled
from daytally.llm.common import NO_ID, blocks, ids_back, mix, partitions_for, python_docs, spans_of, stored, text_bytes
from daytally.llm.sketch_dedup import word_hashes

DEPTH, DISCOUNT, DIVERGENCE = 6, 0.75, 2.0
#: Bytes of context that all grams of a part's group share; shorter contexts are the DataFrames' work.
SHARED = 3
#: Entries of an excerpt of the tree at most, 24 bytes each; and how often a context must occur.
ENTRIES, LEAST = 1 << 22, 2
#: Distinct grams that are held at a time before they are added up or sent on.
FLUSH = 2_000_000
#: Symbols of one bundle of documents; larger ones repeat fewer grams of each other but take more memory.
BUNDLE_BYTES = 32_000_000
#: Symbols that are counted or scored in one numpy step.
STEP_BYTES = 500_000
#: Keys of a run that are added up or dealt in one numpy step, and bytes that leave a task together.
RANGE, SENT_BYTES = 1 << 18, 4_000_000
#: Text bytes for each part of the grams and words.
PART_BYTES = 16_000_000
END = 0x0A
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CODEC = pa.Codec("zstd", compression_level=1)


def mask(depth: int) -> int:
    """Keeps a symbol and its ``depth`` bytes of context."""
    return (1 << (8 * (depth + 1))) - 1


def compressed(data: bytes) -> bytes:
    """The data's size and the data in less room."""
    return len(data).to_bytes(8, "little") + _CODEC.compress(data, asbytes=True)


def expanded(data: bytes) -> bytes:
    return _CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbol bytes of all texts, and each text's number of them."""
    data = [b" ".join(words) + b" \n" if (words := text.encode().lower().split()) else b"\n" for text in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.array([len(x) for x in data], np.int64)


def grams(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each symbol the key of it and the DEPTH bytes before it; a text is preceded by an end and zeros."""
    wide = np.zeros(len(flat) + 7, np.uint8)
    wide[6], wide[7:] = END, flat
    key = np.ndarray(len(flat), ">u8", wide, strides=(1,)).astype(np.uint64) & np.uint64(mask(DEPTH))
    starts = np.cumsum(counts) - counts
    for own in range(DEPTH - 1):  # the text before ends with an end too
        key[starts[counts > own] + own] &= np.uint64(mask(own + 1))
    return key


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their weights (1 each)."""
    if weights is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def gram_counts(docs: DataFrame) -> DataFrame:
    """key, n of all (DEPTH + 1)-grams; each task adds up its own before the shuffle."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            return counted(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

        for frame in blocks(frames):
            held.append(counted(grams(*symbols(frame["text"].tolist()))))
            if sum(len(k) for k, _ in held) > FLUSH:
                held = [summed()]
                if len(held[0][0]) > FLUSH / 2:
                    yield pd.DataFrame({"key": held[0][0].view(np.int64), "n": held[0][1]})
                    held = []
        if held:
            keys, n = summed()
            yield pd.DataFrame({"key": keys.view(np.int64), "n": n})

    return docs.select("text").mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Tree:
    """Per depth: entry keys with their discounted share, contexts with the share left to their suffix."""

    entries: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    lefts: list[np.ndarray]

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Of the last symbol of each key, in the longest retained suffix of its context."""
        p = np.full(len(keys), 1 / 256)
        for depth in range(len(self.entries)):
            own = keys & np.uint64(mask(depth))
            at, known = located(self.contexts[depth], own >> np.uint64(8))
            slot, seen = located(self.entries[depth], own)
            share = np.where(seen, self.shares[depth][slot] if len(self.shares[depth]) else 0.0, 0.0)
            p = np.where(known, share + self.lefts[depth][at] * p, p) if len(self.contexts[depth]) else p
        return p


def located(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values, and whether they are there."""
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return at, ordered[at] == wanted


class Quick:
    """The tree with a hash table of finished log-probabilities for its deepest entries."""

    def __init__(self, tree: Tree):
        self.tree = tree
        keys = tree.entries[-1]
        self.bits = np.uint64(64 - max(int(len(keys) * 2).bit_length(), 4))
        size = 1 << int(64 - int(self.bits))
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size)
        if len(keys):
            slot = (keys * _SPREAD) >> self.bits
            # Of keys in one slot the last stays; the others take the tree's way.
            self.keys[slot], self.values[slot] = keys, np.log10(tree.probabilities(keys))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys * _SPREAD) >> self.bits
        found = self.values[slot]
        rest = np.flatnonzero(self.keys[slot] != keys)
        distinct, where = np.unique(keys[rest], return_inverse=True)
        found[rest] = np.log10(self.tree.probabilities(distinct))[where]
        return found


def leveled(grams_table: DataFrame, top: int = DEPTH) -> list[DataFrame]:
    """For each depth from 0 to that of the grams the stored table key, n, c, kinds: a gram, its count, that of its context, and how many symbols follow it."""
    spark, levels, level = grams_table.sparkSession, [], grams_table
    folder = settings.new_run_dir(spark, "levels")
    for depth in range(top, -1, -1):
        if depth < top:
            level = level.groupBy(F.col("key").bitwiseAND(F.lit(mask(depth))).alias("key")).agg(F.sum("n").alias("n"))
        same = Window.partitionBy(context())  # at most 256 rows
        level = level.select("key", "n", F.sum("n").over(same).alias("c"), F.count_if(F.col("n") > 0).over(same).alias("kinds"))
        level.write.parquet(f"{folder}/{depth}")  # a checkpoint's rows take several times the disk
        level = spark.read.parquet(f"{folder}/{depth}")
        levels.append(level)
    return levels[::-1]


def context() -> Column:
    return F.shiftrightunsigned("key", 8)


def retained_contexts(levels: list[DataFrame], longer: DataFrame | None = None) -> list[DataFrame]:
    """For each depth from 1 the stored table context; a gram that no training document has teaches nothing.

    ``longer`` has retained contexts whose suffixes these levels begin with.
    """
    kept: list[DataFrame] = []
    for depth in range(len(levels) - 1, 0, -1):
        above = levels[depth - 1].where("n > 0").select(F.col("key").alias("shorter"), (F.col("n") / F.col("c")).alias("expected"))
        here = levels[depth].where((F.col("n") > 0) & (F.col("c") >= LEAST)).withColumn("shorter", F.col("key").bitwiseAND(F.lit(mask(depth - 1))))
        gain = F.sum(F.col("n") * F.ln(F.col("n") / F.col("c") / F.col("expected")))
        tested = here.join(above, "shorter").groupBy(context().alias("context")).agg(gain.alias("gain"), F.count("*").alias("kinds"))
        own = tested.where(F.col("gain") > DIVERGENCE * (F.col("kinds") + 1)).select("context")
        if longer is not None:  # suffixes of deeper ones
            own = own.union(longer.select(F.col("context").bitwiseAND(F.lit(mask(depth - 1))).alias("context"))).distinct()
        longer = stored(own)
        kept.append(longer)
    return kept[::-1]


def finished(levels: list[DataFrame], longer: DataFrame | None = None) -> DataFrame:
    """key, p: every gram of the deepest level with the probability of its symbol in the longest retained suffix."""
    seen, left = (F.try_divide(x, F.col("c")) for x in (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)), DISCOUNT * F.col("kinds")))
    found = levels[0].select("key", F.when(F.col("c") > 0, seen + left / 256).otherwise(1 / 256).alias("p"))
    for depth, own in enumerate(retained_contexts(levels, longer), 1):
        here = levels[depth].join(own.withColumn("known", F.lit(True)), context() == F.col("context"), "left")
        here = here.select("key", F.col("key").bitwiseAND(F.lit(mask(depth - 1))).alias("shorter"), F.when(F.col("known"), seen).alias("seen"), left.alias("left"))
        p = F.coalesce(F.col("seen") + F.col("left") * F.col("p"), F.col("p"))
        found = here.join(found.withColumnRenamed("key", "shorter"), "shorter").select("key", p.alias("p"))
    return found


def retained(levels: list[DataFrame]) -> DataFrame:
    """depth, key, n, c of the entries of all retained contexts."""
    parts = [levels[0].withColumn("depth", F.lit(0))]
    for depth, own in enumerate(retained_contexts(levels), 1):
        parts.append(levels[depth].join(own, context() == F.col("context"), "left_semi").withColumn("depth", F.lit(depth)))
    return functools.reduce(DataFrame.unionByName, parts)


def trained(docs: DataFrame) -> Tree:
    """The tree of these documents, for a look at it; of more than ENTRIES entries, those of the most frequent contexts.

    A suffix is at least as frequent as what it ends, so the tree stays whole.
    """
    entries = stored(retained(leveled(gram_counts(docs.select("text")))))
    sizes = entries.groupBy(F.floor(F.log2("c")).cast("int").alias("power")).count().orderBy(F.desc("power")).collect()
    power, total = 0, 0
    for row in sizes:
        total += row["count"]
        if total > ENTRIES:
            power = row.power + 1
            break

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for depth, own in frame.groupby("depth"):
                blobs = {name: [own[name].to_numpy(np.int64).tobytes()] for name in ("key", "n", "c")}
                yield pd.DataFrame({"depth": [depth], **blobs})

    fitting = entries.where(F.col("c") >= float(2**power)).select("depth", "key", "n", "c")
    rows = fitting.mapInPandas(pack, "depth int, key binary, n binary, c binary").collect()  # at most ENTRIES entries
    tree = Tree([], [], [], [])
    for depth in range(DEPTH + 1):
        key, n, c = (np.frombuffer(b"".join(row[name] for row in rows if row.depth == depth), np.int64) for name in ("key", "n", "c"))
        order = np.argsort(key.view(np.uint64))
        add_level(tree, key.view(np.uint64)[order], n[order], c[order])
    return tree


def add_level(tree: Tree, keys: np.ndarray, n: np.ndarray, c: np.ndarray) -> None:
    contexts, where = np.unique(keys >> np.uint64(8), return_inverse=True)
    share = (n - DISCOUNT) / c
    tree.entries.append(keys)
    tree.shares.append(share)
    tree.contexts.append(contexts)
    tree.lefts.append(np.clip(1 - np.bincount(where, share, len(contexts)), 1e-12, 1.0))


@dataclass
class Answers:
    """Values of distinct keys (in order)."""

    keys: np.ndarray
    values: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        distinct, times = counted(keys[order])
        found = np.empty(len(keys))
        found[order] = np.repeat(self.values[np.searchsorted(self.keys, distinct)], times)
        return found


ROWS = "doc_id long, bundle long, part int, grams boolean, words long, bytes binary, codes binary, times binary, trains boolean"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_ROWS = pa.schema([(name, _TYPES[kind]) for name, kind in map(str.split, ROWS.split(", "))])


def in_tasks(docs: DataFrame, parts: int, folder: str) -> DataFrame:
    """Writes, for each bundle, a row per part of its grams, one per part of its word hashes, and one per document.

    codes and times are numpy arrays: grams or word hashes and their training counts in the first
    kinds of rows (doc_id null); the last has the document's symbols as bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sent(bundled(batches, parts, TaskContext.get().partitionId() << 24))

    docs.select("doc_id", "text", "trains").mapInArrow(read, ROWS).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def text_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The batches in pieces of about STEP_BYTES of text; one very long text is a piece of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        for start, end in spans_of(np.cumsum(sizes, dtype=np.int64) // STEP_BYTES):
            yield batch.slice(start, end - start).to_pandas()


def bundled(batches: Iterator[pa.RecordBatch], parts: int, bundle: int) -> Iterator[tuple]:
    """The rows of all bundles of a task, the first one's number being ``bundle``."""
    held, seen, said, size = [], [], [], 0
    for frame in text_steps(batches):
        texts, trains = frame["text"].tolist(), frame["trains"].to_numpy(bool)
        flat, counts = symbols(texts)
        ends = np.cumsum(counts)
        words, sizes = word_hashes(texts)
        for own, keys, taught in ((seen, grams(flat, counts), np.repeat(trains, counts)), (said, words, np.repeat(trains, sizes))):
            rest, (known, n) = counted(keys[~taught])[0], counted(keys[taught])
            own += [(known, n.astype(np.uint32)), (rest, np.zeros(len(rest), np.uint32))]
            if sum(len(k) for k, _ in own[1:]) > FLUSH / 2:
                own[:] = [summed(own)]
        data = [compressed(flat[end - count : end].tobytes()) for end, count in zip(ends.tolist(), counts.tolist(), strict=True)]
        held.append((frame["doc_id"].to_numpy(), trains, np.array(data, object), sizes))
        size += len(flat)
        if size >= BUNDLE_BYTES or len(seen[0][0]) >= 2 * FLUSH:
            yield from bundle_rows(bundle, held, said, seen, parts)
            bundle, size = bundle + 1, 0
    if held:
        yield from bundle_rows(bundle, held, said, seen, parts)


def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their weights, from runs of keys in order; a range of the keys at a time."""
    cuts = max((keys for keys, _ in held), key=len)[RANGE::RANGE]
    bounds = [np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]]) for keys, _ in held]
    total, end = sum(len(keys) for keys, _ in held), 0
    keys, weights = np.empty(total, np.uint64), np.empty(total, held[0][1].dtype)  # what stays empty takes no memory
    for place in range(len(cuts) + 1):
        own = [(k[at[place] : at[place + 1]], n[at[place] : at[place + 1]]) for (k, n), at in zip(held, bounds, strict=True)]
        some, n = counted(*(np.concatenate(x) for x in zip(*own, strict=True)))
        keys[end : end + len(some)], weights[end : end + len(some)] = some, n
        end += len(some)
    return keys[:end], weights[:end]


def bundle_rows(bundle: int, held: list[tuple], said: list[tuple[np.ndarray, np.ndarray]], seen: list[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[tuple]:
    """The rows of one bundle; what is given is emptied on the way."""
    hashes, taught = summed(said)
    said.clear()
    for part, (start, end) in parts_of(hashes, parts):
        yield None, bundle, part, False, end - start, None, hashes[start:end].tobytes(), compressed(taught[start:end].astype("<u4").tobytes()), None
    del hashes, taught
    keys, n = summed(seen)
    seen.clear()
    for part, own in gram_parts(keys, parts):
        yield None, bundle, part, True, len(own), None, squeezed(keys[own]), compressed(n[own].astype("<i8").tobytes()), None
    del keys, n
    for step in held:
        for doc_id, trains, data, words in zip(*step, strict=True):
            yield int(doc_id), bundle, None, None, int(words), data, None, None, bool(trains)
    held.clear()


def sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about SENT_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= SENT_BYTES:
            yield row_batch(held)
            held, size = [], 0
    if held:
        yield row_batch(held)


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _ROWS.types, strict=True)], schema=_ROWS)


def gram_parts(keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """Each part of the hash range with the places of its keys, in their order; keys of at least SHARED bytes of context."""
    part = np.empty(len(keys), np.min_scalar_type(parts))
    for start in range(0, len(keys), RANGE):
        own = mix((keys[start : start + RANGE] >> np.uint64(8)) & np.uint64(mask(SHARED - 1)))
        part[start : start + RANGE] = ((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    return [(int(part[order[start]]), order[start:end]) for start, end in spans_of(part[order])]


def squeezed(keys: np.ndarray) -> bytes:
    """Keys in order as compressed differences."""
    return compressed(np.diff(keys, prepend=np.uint64(0)).astype("<u8").tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(expanded(data), "<u8"), dtype=np.uint64)


def grams_of(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of one part of the hash range, over all bundles."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for codes, times in zip(frame["codes"], frame["times"], strict=True):
        held.append((unsqueezed(codes), np.frombuffer(expanded(times), "<i8")))
        if sum(len(k) for k, _ in held[1:]) > FLUSH:
            held = [summed(held)]
    return summed(held)


@dataclass
class Level:
    """Grams of one depth in order; of each its count and its context's place; of each context its count and how many symbols follow it."""

    keys: np.ndarray
    n: np.ndarray
    place: np.ndarray
    starts: np.ndarray
    c: np.ndarray
    kinds: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray) -> Level:
        contexts = keys >> np.uint64(8)
        new = np.concatenate([[True], contexts[1:] != contexts[:-1]])
        starts = np.flatnonzero(new)
        return cls(keys, n, np.cumsum(new) - 1, starts, np.add.reduceat(n, starts), np.add.reduceat((n > 0).astype(np.int64), starts))

    @property
    def contexts(self) -> np.ndarray:
        return self.keys[self.starts] >> np.uint64(8)


def long_levels(keys: np.ndarray, n: np.ndarray) -> tuple[list[Level], list[np.ndarray], list[np.ndarray]]:
    """From SHARED to DEPTH, of all grams of some contexts of SHARED bytes: the levels, each gram's place in the level
    before, and whether a context is retained; at SHARED whether a longer one is."""
    levels = [Level.of(keys, n)]
    for depth in range(DEPTH - 1, SHARED - 1, -1):
        levels.append(Level.of(*counted(levels[-1].keys & np.uint64(mask(depth)), levels[-1].n)))
    levels = levels[::-1]
    shorter = [np.empty(0, np.int64)] + [np.searchsorted(above.keys, here.keys & np.uint64(mask(depth))) for depth, (above, here) in enumerate(zip(levels, levels[1:]), SHARED)]
    kept: list[np.ndarray] = []
    longer = np.empty(0, np.uint64)
    for depth in range(DEPTH, SHARED - 1, -1):
        here = levels[depth - SHARED]
        own = np.isin(here.contexts, longer)
        if depth > SHARED:
            above, at = levels[depth - SHARED - 1], shorter[depth - SHARED]
            taught = np.flatnonzero(here.n)
            expected = above.n[at[taught]] / above.c[above.place[at[taught]]]
            share = here.n[taught] / here.c[here.place[taught]]
            gain = np.bincount(here.place[taught], here.n[taught] * np.log(share / expected), len(here.c))
            own |= (here.c >= LEAST) & (gain > DIVERGENCE * (here.kinds + 1))
        kept.append(own)
        longer = np.unique(here.contexts[own] & np.uint64(mask(depth - 2)))
    return levels, shorter, kept[::-1]


def shared_of(frame: pd.DataFrame) -> pd.DataFrame:
    """key, n of one part's grams of SHARED bytes of context, and whether a longer context is retained."""
    levels, _, kept = long_levels(*grams_of(frame))
    return pd.DataFrame({"key": levels[0].keys.view(np.int64), "n": levels[0].n, "longer": kept[0][levels[0].place]})


def long_logs(keys: np.ndarray, n: np.ndarray, known: np.ndarray, p: np.ndarray) -> np.ndarray:
    """log10 probability of every gram in the longest retained suffix, given those at SHARED of the known keys in order."""
    levels, shorter, kept = long_levels(keys, n)
    p = p[np.searchsorted(known, levels[0].keys)]
    for here, at, own in zip(levels[1:], shorter[1:], kept[1:], strict=True):
        p, c = p[at], np.maximum(here.c, 1)[here.place]
        smoothed = np.maximum(here.n - DISCOUNT, 0) / c + DISCOUNT * here.kinds[here.place] / c * p
        p = np.where(own[here.place], smoothed, p)
    return np.log10(p)


def packed(values: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct values, and each one's place among them; most grams have the probability of a shorter one."""
    distinct, place = np.unique(values, return_inverse=True)
    planes = place.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return distinct.tobytes(), compressed(planes.tobytes())


def unpacked(distinct: bytes, places: bytes) -> np.ndarray:
    planes = np.frombuffer(expanded(places), np.uint8).reshape(4, -1)
    return np.frombuffer(distinct, np.float64)[np.ascontiguousarray(planes.T).view("<u4").ravel()]


def in_parts(found: DataFrame, parts: int) -> DataFrame:
    """part, codes, values: the rows key, p as arrays for each part, some at a time."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> pd.DataFrame:
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            own = [(part, keys[at].tobytes(), values[at].tobytes()) for part, at in gram_parts(keys, parts)]
            return pd.DataFrame(own, columns=["part", "codes", "values"])

        for frame in frames:
            held.append((frame["key"].to_numpy(np.int64).view(np.uint64), frame["p"].to_numpy(np.float64)))
            if sum(len(k) for k, _ in held) > FLUSH:
                yield rows()
                held = []
        if held:
            yield rows()

    return found.mapInPandas(pack, "part int, codes binary, values binary")


def answers_of(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """For each bundle of a part, the log-probabilities of its grams; ``known`` has those of SHARED bytes of context."""
    shorter = np.concatenate([np.frombuffer(x, np.uint64) for x in known["codes"]])
    p = np.concatenate([np.frombuffer(x, np.float64) for x in known["values"]])
    order = np.argsort(shorter)
    keys, n = grams_of(asked)
    values = long_logs(keys, n, shorter[order], p[order])
    found = [packed(values[np.searchsorted(keys, unsqueezed(x))]) for x in asked["codes"]]
    return pd.DataFrame({"bundle": asked["bundle"], "part": asked["part"], "codes": asked["codes"], "values": [x for x, _ in found], "logs": [x for _, x in found]})


def parts_of(hashes: np.ndarray, parts: int) -> list[tuple[int, tuple[int, int]]]:
    """Each part of the hash range with the bounds of its hashes."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return [(int(part[start]), (start, end)) for start, end in spans_of(part)]


TOTALS = "bundle long, part int, totals binary, kinds long, tokens long"


def totals_of(frame: pd.DataFrame) -> pd.DataFrame:
    """For each bundle of a part, the training counts of its hashes over all bundles."""
    hashes = [np.frombuffer(x, np.uint64) for x in frame["codes"]]
    taught = [np.frombuffer(expanded(x), "<u4") for x in frame["times"]]
    distinct, n = counted(np.concatenate(hashes), np.concatenate(taught).astype(np.int64))
    rows = [compressed(n[np.searchsorted(distinct, x)].astype("<i8").tobytes()) for x in hashes]
    first = np.arange(len(frame)) == 0
    return pd.DataFrame(
        {"bundle": frame["bundle"].to_numpy(), "part": frame["part"].to_numpy(), "totals": rows, "kinds": first * int((n > 0).sum()), "tokens": first * int(n.sum())}
    )


def block_bounds(data: list[bytes]) -> list[tuple[int, int]]:
    """Bounds of documents of about STEP_BYTES together."""
    return spans_of(np.cumsum([len(x) for x in data]) // STEP_BYTES)


def in_blocks(data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grams of documents' symbols and each document's number of them, about STEP_BYTES at a time."""
    sizes = np.array([len(x) for x in data], np.int64)
    for start, end in block_bounds(data):
        yield grams(np.frombuffer(b"".join(data[start:end]), np.uint8), sizes[start:end]), sizes[start:end]


def in_steps(data: list[bytes]) -> Iterator[list[bytes]]:
    """The symbols of documents from their compressed form, about STEP_BYTES at a time."""
    for start, end in spans_of(np.cumsum([int.from_bytes(x[:8], "little") for x in data]) // STEP_BYTES):
        yield [expanded(x) for x in data[start:end]]


def bundle_logs(answers: pd.DataFrame) -> Answers:
    """The log-probabilities of a bundle's grams from its parts' answers."""
    sizes = [int.from_bytes(x[:8], "little") // 8 for x in answers["codes"]]
    keys, values, end = np.empty(sum(sizes), np.uint64), np.empty(sum(sizes)), 0
    for size, codes, distinct, places in zip(sizes, answers["codes"], answers["values"], answers["logs"], strict=True):
        keys[end : end + size], values[end : end + size] = unsqueezed(codes), unpacked(distinct, places)
        end += size
    order = np.argsort(keys)
    keys = keys[order]
    return Answers(keys, values[order])


def document_words(data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each document's distinct word hashes in order and how often it has them; hashed about STEP_BYTES at a time."""
    for low, high in block_bounds(data):
        words, sizes = word_hashes([x.decode() for x in data[low:high]])
        for own in np.split(words, np.cumsum(sizes)[:-1]):
            yield counted(own)


def scores_of(data: list[bytes], logs: Answers) -> np.ndarray:
    """For each document's symbols the sum of their log-probabilities."""
    return np.concatenate([np.add.reduceat(logs.of(keys), np.cumsum(counts) - counts) for keys, counts in in_blocks(data)])


def scored(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    held = F.coalesce(labelled.remainder() == held_out, F.lit(False))
    docs = python_docs(docs)
    docs = docs.withColumn("trains", ~F.when(F.col("doc_id") == F.lit(NO_ID), F.lit(False)).otherwise(held))
    spark = docs.sparkSession
    parts = text_bytes(docs) // PART_BYTES + 1
    folder = settings.new_run_dir(spark, "words")
    rows = in_tasks(docs, parts, f"{folder}/rows")
    dealt = lambda frame: frame.repartition(partitions_for(spark, parts), "part")
    asked = rows.where("doc_id is null").select("grams", "bundle", "part", "codes", "times")
    kinds_of = "bundle long, part int, codes binary, values binary, logs binary"
    dealt(asked.where("grams")).groupBy("part").applyInPandas(shared_of, "key long, n long, longer boolean").write.parquet(f"{folder}/shared")
    shorter = spark.read.parquet(f"{folder}/shared")
    longer = shorter.where("longer").select(context().alias("context")).distinct()
    known = dealt(in_parts(finished(leveled(shorter.select("key", "n"), SHARED), longer), parts)).groupBy("part")
    logs = dealt(asked.where("grams")).groupBy("part").cogroup(known).applyInPandas(answers_of, kinds_of)
    asked = dealt(asked.where("not grams").drop("grams"))
    asked.groupBy("part").applyInPandas(totals_of, TOTALS).write.parquet(f"{folder}/totals")
    totals = spark.read.parquet(f"{folder}/totals")
    answers = totals.select("bundle", "part", "totals").unionByName(logs, allowMissingColumns=True)
    whole = totals.agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    ends = rows.where("trains").count()
    n, kinds = whole.tokens + ends, whole.kinds + (ends > 0)
    log = lambda c: np.log10((c + 0.5) / (n + 0.5 * (kinds + 1)))

    def combine(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("part")
        data = own["bytes"].tolist()
        logs = bundle_logs(known[known["logs"].notna()])
        scores = np.concatenate([scores_of(step, logs) for step in in_steps(data)])
        del logs  # the words need its room
        counts = np.frombuffer(b"".join(expanded(x) for x in known["totals"].dropna()), "<i8")
        said = [x for step in in_steps(data) for x in document_words(step)]
        hashes = counted(np.concatenate([words for words, _ in said]))[0]
        base, found = [], []
        for words, times in said:
            c = counts[np.searchsorted(hashes, words)]
            base.append(float((times * log(c)).sum() + log(ends)))
            found.append(int(times[c > 0].sum()) + (ends > 0))
        return pd.DataFrame(
            {
                "doc_id": own["doc_id"].astype("int64"),
                "held_out": ~own["trains"].astype(bool),
                "n_tokens": own["words"] + 1,
                "n_known": found,
                "train_tokens": n,
                "base_score": base,
                "score": scores,
            }
        )

    kinds_of = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    left = rows.where("doc_id is not null").select("bundle", "doc_id", "words", "bytes", "trains").groupBy("bundle")
    return ids_back(left.cogroup(answers.groupBy("bundle")).applyInPandas(combine, kinds_of))
