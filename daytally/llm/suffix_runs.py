"""Removal of repeated byte strings by a distributed merge sort of suffix runs.

A byte goes when a LENGTH-byte string that covers it also starts earlier. Sorting every suffix of a
corpus would move it a hundred times over, so suffixes are sorted where they can repeat:

1. Each LENGTH-byte window has an anchor: the position of its least GRAM-byte hash (leftmost of
   equals). Equal windows have equal anchors at equal offsets. Consecutive windows share an anchor
   and are one suffix, from the first window's start to the last one's end, about a thirtieth as
   many as windows. Bundles of documents report how many different suffixes they hold for each
   anchor hash; a suffix whose anchor hash is nowhere else can't repeat, and stays.
2. Each bundle sorts its other suffixes, by anchor hash, anchor offset and bytes, drops those equal
   to an earlier one, front-codes the run and sends it in pieces by ranges of the anchor hash.
3. A part merges its runs with a loser tree that knows, for every run, how many bytes its head shares
   with the last string taken, and compares from there on only; so equal suffixes meet, and suffixes
   of one anchor hash follow each other. Of these, windows are compared from the earliest on.
4. An anchor hash with more than HOT different suffixes would be one task's burden. Its windows go
   one by one, by ranges of their own 128-bit hashes, each once per bundle, and the earliest stays.

Removed ranges return to their bundle, which cuts the texts. Equality is decided on bytes, but for
step 4 on 128-bit hashes. A document is never cut; a task holds one bundle or one part.

Defined cases: a null text counts as empty; texts shorter than LENGTH lose nothing; rows without
doc_id come before all others; of rows that share a doc_id, the one with the smaller bytes, and of
equal ones any, comes first, and the others repeat it; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally import settings
from daytally.llm.common import ids_back, in_bundles, mix, partitions_for, python_docs, spans_of

LENGTH, GRAM = 100, 32
#: Text bytes of a bundle, and of one numpy step inside it; a step holds some twelve 8-byte values for each.
BUNDLE, STEP = 8_000_000, 500_000
#: Different suffixes of one anchor hash that a part compares itself.
HOT = 2000
HEADER = 9  # bytes of anchor hash and offset before a suffix

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LOW = np.uint64(0xFFFFFFFF)

SUFFIXES = np.dtype([("doc", "<i4"), ("low", "<i8"), ("high", "<i8"), ("anchor", "<i8"), ("hash", "<u8"), ("print", "<u8")])
ENTRY = np.dtype([("doc_id", "<i8"), ("doc", "<i4"), ("at", "<i8"), ("shared", "u1"), ("size", "u1")])
WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc_id", "<i8"), ("doc", "<i4"), ("at", "<i8")])
RANGE = np.dtype([("doc", "<i4"), ("start", "<i8"), ("stop", "<i8")])


def suffixes_of(texts: list[bytes]) -> np.ndarray:
    """SUFFIXES of these texts: first and last window of each anchor; positions are within the text."""
    parts, first = [], 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STEP):
            size += len(texts[last])
            last += 1
        found = _block_suffixes(texts[first:last])
        found["doc"] += first
        parts.append(found)
        first = last
    return np.concatenate(parts) if parts else np.empty(0, SUFFIXES)


def _block_suffixes(texts: list[bytes]) -> np.ndarray:
    flat = np.frombuffer(b"".join(texts), np.uint8)
    if len(flat) < LENGTH:
        return np.empty(0, SUFFIXES)
    powers = np.multiply.accumulate(np.full(len(flat), _ODD))
    undone = np.multiply.accumulate(np.full(len(flat), _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * powers)])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * undone[: len(flat) - GRAM + 1])
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    wide, want = 1, LENGTH - GRAM + 1
    while 2 * wide <= want:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < want:
        least = np.minimum(least[: len(least) - (want - wide)], least[want - wide :])
    sizes = np.array([len(x) for x in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - LENGTH + 1, 0)
    place = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    if not len(place):
        return np.empty(0, SUFFIXES)
    anchor = (least[place] & _LOW).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)]))
    end = np.append(begin[1:], len(place)) - 1
    low, high, anchor = place[begin], place[end], anchor[begin]
    found = np.empty(len(low), SUFFIXES)
    found["doc"] = np.searchsorted(starts, low, "right") - 1
    # Of empty texts at one place the last is the one that has it.
    base = starts[found["doc"]]
    found["low"], found["high"], found["anchor"] = low - base, high - base, anchor - base
    # Least hashes are small ones; mixed again they fill the hash range evenly.
    found["hash"] = mix(grams[anchor])
    found["print"] = mix(mix((sums[high + LENGTH] - sums[low]) * undone[low]) + (anchor - low).astype(np.uint64) * np.uint64(512) + (high - low).astype(np.uint64))
    return found


def opened(frame: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    """A bundle's doc_ids and texts, in order of both."""
    rows = sorted(zip(frame["doc_id"].tolist(), map(zlib.decompress, frame["text"]), strict=True))
    return np.array([i for i, _ in rows], np.int64), [x for _, x in rows]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash range; ordered as the hashes are."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def distinct_counts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hashes in order, and how many different suffixes each has here."""
    order = np.lexsort((found["print"], found["hash"]))
    h, p = found["hash"][order], found["print"][order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])]) if len(h) else np.empty(0, bool)
    return np.unique(h[new], return_counts=True)


def count_rows(parts: int):
    def count(frame: pd.DataFrame) -> pd.DataFrame:
        hashes, n = distinct_counts(suffixes_of(opened(frame)[1]))
        part, bundle = part_of(hashes, parts), int(frame["bundle"].iloc[0])
        rows = [(int(part[a]), bundle, hashes[a:b].tobytes(), zlib.compress(n[a:b].astype("<u4").tobytes(), 1)) for a, b in spans_of(part)]
        return pd.DataFrame(rows, columns=["part", "bundle", "hashes", "counts"])

    return count


def total_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """For each bundle the sums over all bundles, at most HOT + 1."""
    hashes = [np.frombuffer(x, np.uint64) for x in frame["hashes"]]
    n = np.concatenate([np.frombuffer(zlib.decompress(x), "<u4") for x in frame["counts"]])
    distinct, where = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.minimum(np.bincount(where, n), HOT + 1).astype("<u2")[where]
    cuts = np.cumsum([len(x) for x in hashes])[:-1]
    return pd.DataFrame({"bundle": frame["bundle"], "part": frame["part"], "totals": [zlib.compress(x.tobytes(), 1) for x in np.split(totals, cuts)]})


def shared_bytes(one: bytes, two: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are."""
    most = min(len(one), len(two))
    if one[known:most] == two[known:most]:
        return most
    low, high = known, most
    while high - low > 8:
        middle = (low + high) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle
    while one[low] == two[low]:
        low += 1
    return low


def run_rows(bundle: int, doc_ids: np.ndarray, texts: list[bytes], found: np.ndarray, parts: int) -> tuple[list[tuple], list[tuple[int, int, int]]]:
    """Front-coded pieces of the sorted run of these suffixes, and the ranges of those equal to an earlier one here."""
    heads = found["hash"].byteswap().tobytes()
    items = []
    for i, (doc, low, high, anchor) in enumerate(zip(*(found[c].tolist() for c in ("doc", "low", "high", "anchor")), strict=True)):
        items.append((heads[8 * i : 8 * i + 8] + bytes([anchor - low]) + texts[doc][low : high + LENGTH], doc, low))
    items.sort()
    kept, gone, last = [], [], b""
    for key, doc, low in items:
        shared = shared_bytes(last, key)
        if shared == len(key) == len(last):
            gone.append((doc, low, low + len(key) - HEADER))
            continue
        kept.append((key, doc, low, shared))
        last = key
    hashes = np.array([int.from_bytes(key[:8], "big") for key, *_ in kept], np.uint64)
    part, rows = part_of(hashes, parts), []
    for a, b in spans_of(part):
        entries, tails = np.empty(b - a, ENTRY), []
        for i, (key, doc, low, shared) in enumerate(kept[a:b]):
            shared = shared if i else 0
            entries[i] = (doc_ids[doc], doc, low, shared, len(key))
            tails.append(key[shared:])
        rows.append(("run", int(part[a]), bundle, zlib.compress(entries.tobytes(), 1), zlib.compress(b"".join(tails), 1)))
    return rows, gone


def add_range(gone: list[tuple[int, int, int]], doc: int, start: int, stop: int) -> None:
    """Windows that follow each other become one range."""
    if gone and gone[-1][0] == doc and gone[-1][1] <= start <= gone[-1][2]:
        start, stop = gone[-1][1], max(stop, gone.pop()[2])
    gone.append((doc, start, stop))


def window_rows(bundle: int, doc_ids: np.ndarray, texts: list[bytes], found: np.ndarray, parts: int) -> tuple[list[tuple], list[tuple[int, int, int]]]:
    """Hashes of all windows of these suffixes by parts, each once; and the ranges of later equal ones here."""
    seen: dict[bytes, int] = {}
    rows, gone = [], []
    order = np.lexsort((found["low"], found["doc"]))
    for doc, low, high in zip(*(found[c][order].tolist() for c in ("doc", "low", "high")), strict=True):
        text = texts[doc]
        for at in range(low, high + 1):
            name = hashlib.blake2b(text[at : at + LENGTH], digest_size=16).digest()
            if name in seen:
                add_range(gone, doc, at, at + LENGTH)
            else:
                seen[name] = 1
                rows.append((int.from_bytes(name[:8], "big"), int.from_bytes(name[8:], "big"), doc_ids[doc], doc, at))
    windows = np.array(rows, WINDOW)
    windows = windows[np.argsort(windows["one"], kind="stable")]
    part = part_of(windows["one"], parts)
    return [("window", int(part[a]), bundle, windows[a:b].tobytes(), b"") for a, b in spans_of(part)], gone


def ranges(found: list[tuple[int, int, int]]) -> bytes:
    return zlib.compress(np.array(found, RANGE).tobytes(), 1)


SENT = "kind string, part int, bundle int, entries binary, tails binary"
GONE = "bundle int, ranges binary"


def send_rows(parts: int):
    def send(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["kind", "part", "bundle", "entries", "tails"]
        if not len(frame) or not len(known):
            return pd.DataFrame({name: [] for name in names})
        doc_ids, texts = opened(frame)
        bundle = int(frame["bundle"].iloc[0])
        found = suffixes_of(texts)
        hashes, where, times = np.unique(found["hash"], return_inverse=True, return_counts=True)
        totals = np.frombuffer(b"".join(zlib.decompress(x) for x in known.sort_values("part")["totals"]), "<u2")
        hot = totals[where] > HOT
        again = ~hot & ((totals[where] > 1) | (times[where] > 1))
        rows, gone = run_rows(bundle, doc_ids, texts, found[again], parts)
        more, later = window_rows(bundle, doc_ids, texts, found[hot], parts)
        rows += [*more, ("gone", 0, bundle, ranges(gone + later), b"")]
        return pd.DataFrame(rows, columns=names)

    return send


class Run:
    """A front-coded run, read one string at a time."""

    def __init__(self, bundle: int, entries: bytes, tails: bytes):
        self.bundle = bundle
        self.entries = np.frombuffer(zlib.decompress(entries), ENTRY).tolist()
        self.tails, self.at, self.read, self.key = zlib.decompress(tails), -1, 0, b""
        self.advance()

    def advance(self) -> int:
        """Bytes that the next string shares with this one; key is None after the last."""
        self.at += 1
        if self.at == len(self.entries):
            self.key = None
            return 0
        shared, size = self.entries[self.at][3:]
        end = self.read + size - shared
        self.key = self.key[:shared] + self.tails[self.read : end]
        self.read = end
        return shared


def merged(runs: list[Run]) -> Iterator[tuple[int, Run]]:
    """(bytes shared with the string before, run) in order; the run's key and entry are current when it is given.

    Every loser in the tree keeps how much it shares with the winner that passed it. Against the
    next winner from below, the one that shares more comes first; only on a tie are bytes compared,
    from where both are known to be equal.
    """
    size = 1
    while size < len(runs):
        size *= 2
    tree, shares = [-1] * size, [0] * size

    def play(new: int, share: int, node: int) -> tuple[int, int]:
        """The winner of ``new`` against the loser kept at node; the other one stays there."""
        old = tree[node]
        old_key = runs[old].key if 0 <= old < len(runs) else None
        new_key = runs[new].key if 0 <= new < len(runs) else None
        if old_key is None:
            return new, share
        if new_key is None:
            tree[node] = new
            kept, shares[node] = shares[node], 0
            return old, kept
        if share != shares[node]:
            if share > shares[node]:
                return new, share
            tree[node] = new
            kept, shares[node] = shares[node], share
            return old, kept
        both = shared_bytes(new_key, old_key, share)
        new_first = both == len(new_key) if both in (len(new_key), len(old_key)) else new_key[both] < old_key[both]
        if new_first:
            shares[node] = both
            return new, share
        tree[node] = new
        kept, shares[node] = shares[node], both
        return old, kept

    def build(node: int) -> int:
        if node >= size:
            return node - size
        left, right = build(2 * node), build(2 * node + 1)
        tree[node], shares[node] = right, 0
        return play(left, 0, node)[0]

    winner, share = build(1) if size > 1 else 0, 0
    while winner < len(runs) and runs[winner].key is not None:
        yield share, runs[winner]
        share, node = runs[winner].advance(), (winner + size) // 2
        while node:
            winner, share = play(winner, share, node)
            node //= 2


def merge_part(frame: pd.DataFrame) -> pd.DataFrame:
    """Ranges that repeat an earlier window, by bundle."""
    runs = [Run(*row) for row in zip(frame["bundle"].tolist(), frame["entries"], frame["tails"], strict=True)]
    gone: dict[int, list[tuple[int, int, int]]] = {}
    group: list[tuple[int, int, int, int, bytes, int]] = []
    distinct, last = 0, b""

    def settle() -> None:
        whole, windows = set(), set()
        lonely = len({entry[5] for entry in group}) == 1
        for doc_id, doc, at, bundle, key, number in sorted(group):
            if number in whole:
                gone.setdefault(bundle, []).append((doc, at, at + len(key) - HEADER))
                continue
            whole.add(number)
            if lonely:
                continue
            offset, body = key[8], key[HEADER:]
            for i in range(len(body) - LENGTH + 1):
                window = (offset - i, body[i : i + LENGTH])
                if window in windows:
                    add_range(gone.setdefault(bundle, []), doc, at + i, at + i + LENGTH)
                else:
                    windows.add(window)

    for share, run in merged(runs):
        key = run.key
        if share < 8 and group:
            settle()
            group = []
        distinct += not share == len(key) == len(last)
        doc_id, doc, at = run.entries[run.at][:3]
        group.append((doc_id, doc, at, run.bundle, key, distinct))
        last = key
    if group:
        settle()
    return pd.DataFrame([(bundle, ranges(found)) for bundle, found in gone.items()], columns=["bundle", "ranges"])


def first_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Ranges of all but the earliest window of each hash, by bundle."""
    parts = [np.frombuffer(x, WINDOW) for x in frame["entries"]]
    windows = np.concatenate(parts)
    bundle = np.repeat(frame["bundle"].to_numpy(np.int64), [len(x) for x in parts])
    order = np.lexsort((windows["at"], windows["doc"], windows["doc_id"], windows["two"], windows["one"]))
    windows, bundle = windows[order], bundle[order]
    later = np.concatenate([[False], (windows["one"][1:] == windows["one"][:-1]) & (windows["two"][1:] == windows["two"][:-1])])
    windows, bundle = windows[later], bundle[later]
    rows = []
    for number in np.unique(bundle).tolist():
        own = windows[bundle == number]
        found = np.empty(len(own), RANGE)
        found["doc"], found["start"], found["stop"] = own["doc"], own["at"], own["at"] + LENGTH
        rows.append((number, zlib.compress(found.tobytes(), 1)))
    return pd.DataFrame(rows, columns=["bundle", "ranges"])


def cut_texts(frame: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    """doc_id, n_bytes, starts and stops of the removed runs, kept bytes."""
    doc_ids, texts = opened(frame) if len(frame) else (np.empty(0, np.int64), [])
    found = np.concatenate([np.empty(0, RANGE), *(np.frombuffer(zlib.decompress(x), RANGE) for x in gone["ranges"])])
    found = found[np.lexsort((found["start"], found["doc"]))]
    bounds = np.searchsorted(found["doc"], np.arange(len(texts) + 1))
    rows = []
    for i, text in enumerate(texts):
        own = found[bounds[i] : bounds[i + 1]]
        reach = np.maximum.accumulate(own["stop"]) if len(own) else own["stop"]
        fresh = np.concatenate([[True], own["start"][1:] > reach[:-1]]) if len(own) else np.empty(0, bool)
        starts, stops = own["start"][fresh].tolist(), reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(own) - 1)].tolist() if len(own) else []
        kept = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True))
        rows.append((int(doc_ids[i]), len(text), starts, stops, kept))
    return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "starts", "stops", "kept"])


CUT = "doc_id long, n_bytes long, starts array<long>, stops array<long>, kept binary"


def packed_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """bundle, doc_id, text (compressed UTF-8), dealt by bundle; and the number of bundles."""
    dealt, count = in_bundles(python_docs(docs), BUNDLE)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=[zlib.compress(x.encode(), 1) for x in frame["text"]])

    packed = dealt.select("bundle", "doc_id", "text").mapInPandas(pack, "bundle int, doc_id long, text binary")
    return packed.repartition(partitions_for(docs.sparkSession, min(count, 100_000)), "bundle"), count


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, starts, stops (removed runs), kept (remaining bytes) of every row."""
    spark = docs.sparkSession
    texts, parts = packed_texts(docs)
    spread = partitions_for(spark, min(parts, 100_000))
    counts = texts.groupBy("bundle").applyInPandas(count_rows(parts), "part int, bundle int, hashes binary, counts binary")
    totals = counts.repartition(spread, "part").groupBy("part").applyInPandas(total_rows, "bundle int, part int, totals binary")
    folder = settings.new_run_dir(spark, "suffixes")
    texts.groupBy("bundle").cogroup(totals.groupBy("bundle")).applyInPandas(send_rows(parts), SENT).write.parquet(folder)
    sent = spark.read.parquet(folder)
    of = lambda kind: sent.where(F.col("kind") == kind)
    gone = of("run").repartition(spread, "part").groupBy("part").applyInPandas(merge_part, GONE)
    gone = gone.union(of("window").repartition(spread, "part").groupBy("part").applyInPandas(first_windows, GONE))
    gone = gone.union(of("gone").select("bundle", F.col("entries").alias("ranges")))
    return ids_back(texts.groupBy("bundle").cogroup(gone.groupBy("bundle")).applyInPandas(cut_texts, CUT))
