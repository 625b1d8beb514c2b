"""Approximate nearest neighbours by inner product with a permutation index.

A vector is represented by its PREFIX nearest pivots in order. Vectors are dealt into shards of
about SHARD_ROWS; a shard posts each vector in the inverted files of its POSTED nearest pivots. A
query reads the files of its PROBED nearest pivots in every shard, and of further ones until it has
the share REACHED of the shard's distinct vectors, ranks what it finds there by the
footrule distance between the two pivot orders (a pivot outside a prefix counts as place PREFIX),
and takes exact inner products of the nearest RERANKED share. Queries come in blocks of about
BLOCK_ROWS, so a task holds one shard and one block, whatever the number of either; a vector or a
pivot that a third of all rows share is spread over all shards.

Largest inner product is nearest distance once every vector gets one more component that brings it
to the largest norm (queries get 0); pivots are chosen and ordered in that space. Pivots are the
PIVOTS of the SAMPLE distinct vectors of smallest hash that lie farthest apart: a bounded sample.
Every vector is indexed; in a shard, equal ones are one entry with all the vec_ids a query may need.

Measured recall of the 20 nearest is in the README.

Defined cases: vectors that are null, zero, or that hold null or non-finite components take no part;
each dimension is searched as a table of its own, with its own pivots; a vector is no candidate of a query with its own
vec_id, repeated rows included; repeated query rows are one query; ties go to the smaller vec_id;
fewer candidates than asked for are all returned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.common import partitions_for, stored

PIVOTS, PREFIX, POSTED, PROBED = 128, 32, 8, 16
SHARD_ROWS, BLOCK_ROWS = 8192, 4096
#: Distinct vectors that pivots are chosen from, and the share of a shard's distinct vectors that a query finds at least.
SAMPLE, REACHED = 1024, 0.75
#: Share of a shard's distinct vectors that a query reranks, whatever its size.
RERANKED = 0.5

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector array<double>, norm2; only vectors that take part."""
    values = F.col("vector")
    good = (F.size(values) > 0) & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm2 = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    cast = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    cast = cast.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    return cast.withColumn("norm2", norm2).where("norm2 > 0")


def spaces(vectors: DataFrame) -> dict[int, tuple[np.ndarray, float]]:
    """For each dimension its pivots and its largest squared norm."""
    sizes = vectors.groupBy("size").agg(F.max("norm2").alias("most")).orderBy("size").collect()
    return {row.size: (pivots_of(vectors.where(F.col("size") == row.size), row.size, row.most), row.most) for row in sizes}


def lifted(rows: np.ndarray, most: float) -> np.ndarray:
    """Rows with the component that brings them to the squared norm ``most``."""
    gap = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", rows, rows), 0.0))
    return np.hstack([rows, gap[:, None]])


def pivots_of(vectors: DataFrame, dimension: int, most: float) -> np.ndarray:
    """Lifted pivots; copies of a vector, however many, count as one."""
    own = vectors.select(F.xxhash64("vector").alias("hash"), "vector")
    hashes = [row.hash for row in own.select("hash").distinct().orderBy("hash").limit(SAMPLE).collect()]
    chosen = own.where(F.col("hash") <= max(hashes, default=0)).groupBy("hash").agg(F.min("vector").alias("vector")).orderBy("hash").limit(SAMPLE).collect()
    return spread_out(lifted(np.array([row.vector for row in chosen], np.float64).reshape(len(chosen), dimension), most))


def spread_out(rows: np.ndarray) -> np.ndarray:
    """PIVOTS of the rows at most, each the farthest from those before it."""
    taken, gap = [0][: len(rows)], np.full(len(rows), np.inf)
    while taken and len(taken) < min(PIVOTS, len(rows)):
        gap = np.minimum(gap, ((rows - rows[taken[-1]]) ** 2).sum(axis=1))
        gap[taken] = -1.0
        taken.append(int(np.argmax(gap)))
    return rows[taken]


def orders(rows: np.ndarray, pivots: np.ndarray, most: int = PREFIX) -> np.ndarray:
    """For each row its ``most`` nearest pivots, nearest first, as bytes; all rows of one space have equal norms."""
    near = rows @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :most].astype(np.uint8)


def represented(vectors: DataFrame, found: dict[int, tuple[np.ndarray, float]]) -> DataFrame:
    """vec_id, size, packed (the vector as bytes), near and asks (its pivot order as a candidate and as a query)."""
    shared = vectors.sparkSession.sparkContext.broadcast(found)

    def represent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, own in frame.groupby("size"):
                rows, (pivots, most) = np.array(own["vector"].tolist(), np.float64), shared.value[size]
                packed = {"packed": rows, "near": orders(lifted(rows, most), pivots), "asks": orders(rows, pivots[:, :-1], PIVOTS)}
                yield pd.DataFrame({"vec_id": own["vec_id"].to_numpy(), "size": size} | {name: [x.tobytes() for x in part] for name, part in packed.items()})

    return vectors.select("vec_id", "size", "vector").mapInPandas(represent, "vec_id long, size int, packed binary, near binary, asks binary")


def portions(rows: DataFrame, most: int) -> dict[int, int]:
    """For each dimension the number of portions of about ``most`` rows."""
    return {row.size: row["count"] // most + 1 for row in rows.groupBy("size").count().collect()}


def of_size(values: dict[int, int]) -> Column:
    """The value of a row's dimension; null where there is none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("size")) if values else F.lit(None).cast("int")


class Shard:
    """Distinct vectors, their pivot places, one inverted file for each pivot, and their vec_ids in order."""

    def __init__(self, frame: pd.DataFrame, pivots: int, prefix: int):
        frame = frame.sort_values("vec_id", kind="stable")
        entry, first = pd.factorize(frame["packed"])[0], ~frame["packed"].duplicated().to_numpy()
        order = np.argsort(entry, kind="stable")
        self.ids, self.starts = frame["vec_id"].to_numpy(np.int64)[order], np.searchsorted(entry[order], np.arange(first.sum() + 1))
        frame = frame[first]
        self.rows = np.frombuffer(b"".join(frame["packed"]), np.float64).reshape(len(frame), -1)
        near = np.frombuffer(b"".join(frame["near"]), np.uint8).reshape(len(frame), -1)
        self.prefix = prefix
        self.places = np.full((pivots, len(frame)), prefix, np.int16)
        every = np.arange(len(frame))
        for place in range(near.shape[1]):
            self.places[near[:, place], every] = place
        self.files = [np.flatnonzero(row < POSTED) for row in self.places]
        self.rerank, self.reached = (int(np.ceil(share * len(frame))) for share in (RERANKED, REACHED))

    def nearest(self, query_id: int, row: np.ndarray, near: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``wanted`` vec_ids and scores, best first."""
        # An answer needs so many entries, its own aside; beyond that the shares hold at any size.
        rerank, reached = (max(share, wanted + 1) for share in (self.rerank, self.reached))
        hit = np.zeros(len(self.rows), bool)
        for probed, pivot in enumerate(near):
            if probed >= PROBED and np.count_nonzero(hit) >= reached:
                break
            hit[self.files[pivot]] = True
        found, near = np.flatnonzero(hit), near[: self.prefix]
        if len(found) > rerank:
            # Footrule over the query's pivots; those of the vector alone add what its other places leave.
            places = self.places[near][:, found]
            distance = (np.abs(places - np.arange(len(near), dtype=np.int16)[:, None]) + places).sum(axis=0, dtype=np.int32)
            cut = np.partition(distance, rerank - 1)[rerank - 1]
            inside, edge = found[distance < cut], found[distance == cut]
            found = np.concatenate([inside, edge[: rerank - len(inside)]])
        score = self.rows[found] @ row
        if len(score) > wanted + 1:  # one may be the query's own
            cut = np.partition(score, len(score) - wanted - 1)[len(score) - wanted - 1]
            found, score = found[score >= cut], score[score >= cut]
        # Of an entry's vec_ids the smallest suffice, its own and repeated rows aside.
        own = [(ids := self.ids[self.starts[i] : self.starts[i + 1]])[ids != query_id][:wanted] for i in found]
        ids, score = np.concatenate([self.ids[:0], *own]), np.repeat(score, [len(x) for x in own])
        best = np.lexsort((ids, -score))[:wanted]
        return ids[best], score[best]


def search(vectors: DataFrame, is_query: Column, wanted: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for every row that ``is_query`` picks, among all rows."""
    kept = usable(vectors).withColumn("size", F.size("vector"))
    found = spaces(kept)
    pivots = {size: len(own) for size, (own, _) in found.items()}
    coded = stored(represented(kept, found))
    queries = coded.where(is_query).dropDuplicates(["vec_id"])
    shards, blocks = portions(coded, SHARD_ROWS), portions(queries, BLOCK_ROWS)
    place = lambda counts: F.pmod(F.xxhash64("vec_id"), of_size(counts)).cast("int")
    every = lambda counts: F.explode(F.sequence(F.lit(0), of_size(counts) - 1))
    left = coded.drop("asks").withColumn("shard", place(shards)).withColumn("block", every(blocks))
    right = queries.drop("near").withColumn("block", place(blocks)).withColumn("shard", every(shards))

    def find(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        count = pivots[int(shard["size"].iloc[0])]
        index = Shard(shard, count, min(PREFIX, count))
        parts = []
        for query_id, packed, near in zip(block["vec_id"], block["packed"], block["asks"], strict=True):
            ids, score = index.nearest(query_id, np.frombuffer(packed, np.float64), np.frombuffer(near, np.uint8), wanted)
            parts.append((np.full(len(ids), query_id), ids, score))
        query, ids, score = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pd.DataFrame({"query_id": query, "vec_id": ids, "score": score})

    spread = partitions_for(vectors.sparkSession, min(sum(shards[size] * n for size, n in blocks.items()), 100_000))
    key = ["size", "shard", "block"]
    both = left.repartition(spread, *key).groupBy(*key).cogroup(right.repartition(spread, *key).groupBy(*key))
    found = both.applyInPandas(find, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")
