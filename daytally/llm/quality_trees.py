"""A quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics of every whole text are computed once and stored; the trees are fitted on those of a
bounded sample of labelled documents (labelled.SAMPLE_ROWS, a few megabytes) and scored over all.
Statistics are cut into at most BINS quantile bins, each node takes the split of largest gain from
per-bin sums of gradients, and the finished trees are flat arrays that numpy walks for all rows at
once. Labels, language, source and doc_id are no inputs of a score.

Defined cases: a null text counts as empty and has a score; repeated rows are scored each; without
usable labels, or with labels of one kind only, every document gets the smoothed share of good
labels; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm import labelled
from daytally.llm.common import blocks, ids_back, python_docs, stored

BINS, TREES, DEPTH, RATE, SMOOTH, LEAST_ROWS = 64, 60, 4, 0.15, 1.0, 8

#: Byte classes by their members; the last one takes all others.
BYTE_CLASSES = (
    ("lower", b"abcdefghijklmnopqrstuvwxyz"),
    ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", b"0123456789"),
    ("space", b" \t\r\x0b\x0c"),
    ("line", b"\n"),
    ("stop", b".,;:?'\"()-"),
    ("shout", b"!"),
    ("bar", b"|"),
    ("symbol", b"#$%&*+/<=>@[\\]^_`{}~"),
    ("lead", bytes(range(0xC0, 0x100))),
    ("tail", bytes(range(0x80, 0xC0))),
    ("control", b""),
)
STATISTICS = (
    *(name for name, _ in BYTE_CLASSES),
    "size", "words", "word_size", "distinct", "top", "again", "longest", "lines", "distinct_lines", "marked", "doubled",
)


def _class_table() -> np.ndarray:
    table = np.full(256, len(BYTE_CLASSES) - 1, np.int64)
    for number, (_, members) in enumerate(BYTE_CLASSES):
        table[list(members)] = number
    return table


CLASS_OF = _class_table()
MARKS = tuple("#$%&*+=@~^|!<>")


def statistics(texts: list[str]) -> np.ndarray:
    """One row of STATISTICS for each text."""
    data = [text.encode() for text in texts]
    sizes = np.array([len(x) for x in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8)
    kinds, width = CLASS_OF[flat], len(BYTE_CLASSES)
    owner = np.repeat(np.arange(len(data)), sizes)
    counts = np.bincount(owner * width + kinds, minlength=len(data) * width).reshape(-1, width)
    same = (flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])
    doubled = np.bincount(owner[1:][same], minlength=len(data))
    rows = []
    for text in texts:
        words = text.split()
        lines = text.split("\n")
        n = max(len(words), 1)
        tally = Counter(words)
        rows.append(
            (
                len(words),
                len(text) / n,
                len(tally) / n,
                max(tally.values(), default=0) / n,
                sum(map(str.__eq__, words[1:], words)) / n,
                max(map(len, tally), default=0),
                len(lines),
                len(set(lines)) / len(lines),
                sum(word.endswith(MARKS) for word in tally) / max(len(tally), 1),
            )
        )
    own = np.array(rows, np.float64).reshape(-1, 9)
    each = np.maximum(sizes, 1)[:, None]
    return np.hstack([counts / each, np.log1p(sizes)[:, None], np.log1p(own[:, :1]), own[:, 1:], (doubled / each[:, 0])[:, None]])


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats array<double> of every row."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "stats": list(statistics(frame["text"].tolist()))})

    return python_docs(docs).mapInPandas(measure, "doc_id long, stats array<double>")


@dataclass
class Trees:
    """Flat trees: for each node its statistic, threshold, left child (the right one follows) and leaf value."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of a good document for each row; all rows go down one level at a time."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                inner = self.left[node] >= 0
                right = rows[every, self.feature[node]] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fitted(rows: np.ndarray, good: np.ndarray) -> Trees:
    """Boosted trees for the logistic loss."""
    share = (good.sum() + 1.0) / (len(good) + 2.0)
    base = float(np.log(share / (1 - share)))
    empty = np.empty(0)
    if not len(good) or good.min() == good.max():
        return Trees(base, empty.astype(int), empty.astype(int), empty, empty.astype(int), empty)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T, strict=True)], axis=1)
    features, total = rows.shape[1], np.full(len(good), base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def new_node() -> int:
        for part, blank in ((feature, 0), (threshold, 0.0), (left, -1), (value, 0.0)):
            part.append(blank)
        return len(left) - 1

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = good - p, p * (1 - p)
        level = [(new_node(), np.arange(len(good)))]
        roots.append(level[0][0])
        for depth in range(DEPTH + 1):
            following = []
            for node, own in level:
                g, h = gradient[own].sum(), weight[own].sum()
                value[node] = RATE * g / (h + SMOOTH)
                best = (1e-6, -1, -1)
                if depth < DEPTH and len(own) >= 2 * LEAST_ROWS:
                    slots = (binned[own] + np.arange(features) * BINS).ravel()
                    sums = [np.bincount(slots, np.repeat(x, features), features * BINS).reshape(features, BINS) for x in (gradient[own], weight[own], np.ones(len(own)))]
                    lower_g, lower_h, lower_n = (np.cumsum(x, axis=1)[:, :-1] for x in sums)
                    gain = lower_g**2 / (lower_h + SMOOTH) + (g - lower_g) ** 2 / (h - lower_h + SMOOTH) - g * g / (h + SMOOTH)
                    gain[(lower_n < LEAST_ROWS) | (len(own) - lower_n < LEAST_ROWS)] = -1
                    at = int(np.argmax(gain))
                    best = max(best, (float(gain.flat[at]), *divmod(at, BINS - 1)))
                _, split, cut = best
                if split < 0 or cut >= len(edges[split]):
                    total[own] += value[node]
                    continue
                low, high = new_node(), new_node()
                feature[node], threshold[node], left[node] = split, edges[split][cut], low
                goes = binned[own, split] > cut
                following += [(low, own[~goes]), (high, own[goes])]
            level = following
    return Trees(base, *(np.array(x) for x in (roots, feature, threshold, left, value)))


def trained(stats: DataFrame, labels: DataFrame, held_out: int = 0, rows: int = labelled.SAMPLE_ROWS) -> Trees:
    """Trees for labels.quality from at most ``rows`` labelled documents outside the held-out fold."""
    chosen = labelled.sample(labels, ["quality"], held_out, rows)
    known = stats.join(F.broadcast(chosen), "doc_id").select("doc_id", "stats", "quality")
    # Repeated rows of a document are one example.
    known = known.groupBy("doc_id").agg(F.min("stats").alias("stats"), F.max("quality").alias("quality"))
    examples = known.orderBy("doc_id").collect()  # at most ``rows`` rows
    values = np.array([row.stats for row in examples], np.float64).reshape(-1, len(STATISTICS))
    return fitted(values, np.array([row.quality for row in examples], np.float64))


def scored(docs: DataFrame, labels: DataFrame, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score (probability of a good document) of every row."""
    stats = stored(with_statistics(docs))
    trees = docs.sparkSession.sparkContext.broadcast(trained(stats, labels, held_out))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = np.array(frame["stats"].tolist(), np.float64).reshape(-1, len(STATISTICS))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": trees.value.scores(rows)})

    found = ids_back(stats.mapInPandas(score, "doc_id long, score double"))
    return found.select("doc_id", F.coalesce(labelled.remainder() == held_out, F.lit(False)).alias("held_out"), "score")
