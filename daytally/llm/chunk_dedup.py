"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so, never by position alone. Equal chunks get one
identifier, a document becomes the ordered list of its chunks' identifiers (its recipe), and
documents are equal when their recipes are. Chunk texts move once, each distinct chunk of a task
one time; recipes, a few bytes per chunk, are what is grouped and joined.

An identifier is a 64-bit fingerprint that was verified: the distinct chunks are grouped by
content first, and a fingerprint that two different chunks share is told apart by an ordinal in
every recipe that holds it. So the result is exact whatever the fingerprint does.

Defined cases: a null text counts as empty, and all empty texts are equal; repeated rows count in
group_size and share one decision; among rows without doc_id none is kept unless the whole group
has none; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.common import plain_docs, stored

#: Characters of a chunk at least, and at most where no cut is found.
SHORTEST, LONGEST = 512, 8192
#: A cut: after white space between two characters of these sets, about once in a hundred characters of prose.
CUT = r"[dglnrst][.,;:]?\s(?=[b-df-hB-DF-H0-9])"
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?{CUT}|.{{1,{LONGEST}}}"

Fingerprint = Callable[[Column], Column]


def chunks_of(text: Column) -> Column:
    """The chunks of a text in order; joined, they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def clashing_chunks(docs: DataFrame, fingerprint: Fingerprint) -> DataFrame | None:
    """(fp, chunk, ordinal) of all chunks whose fingerprint another chunk has too; nearly always there are none."""
    distinct = docs.select(F.explode(chunks_of(F.col("text"))).alias("chunk")).groupBy("chunk").agg(F.lit(1).alias("one"))
    distinct = distinct.select("chunk", fingerprint(F.col("chunk")).alias("fp"))
    shared = stored(distinct.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"))
    if not shared.count():
        return None
    order = Window.partitionBy("fp").orderBy("chunk")
    return stored(distinct.join(shared, "fp").select("fp", "chunk", F.row_number().over(order).alias("ordinal")))


def recipes(docs: DataFrame, fingerprint: Fingerprint = F.xxhash64) -> DataFrame:
    """doc_id, text_sha256, recipe (verified identifiers in order), ordinals (empty but for clashes)."""
    docs = plain_docs(docs)
    clashes = clashing_chunks(docs, fingerprint)
    named = docs.select(
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("text")), lambda chunk: fingerprint(chunk)).alias("recipe"),
    ).withColumn("ordinals", F.array().cast("array<int>"))
    if clashes is None:
        return stored(named)
    # Equal texts have equal ordinals, so the text's digest is key enough here; only copies share it.
    key = ["text_sha256"]
    places = docs.select(F.sha2("text", 256).alias("text_sha256"), F.posexplode(chunks_of(F.col("text"))).alias("at", "chunk"))
    found = places.withColumn("fp", fingerprint(F.col("chunk"))).join(clashes, ["fp", "chunk"])
    told = found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("at", "ordinal"))).alias("told"))
    whole = named.drop("ordinals").join(told, key, "left")
    return stored(whole.withColumn("ordinals", F.coalesce(F.col("told.ordinal"), F.array().cast("array<int>"))).drop("told"))


def exact_groups(docs: DataFrame, fingerprint: Fingerprint = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; the largest doc_id of equal texts stays.

    Groups are aggregated before the shuffle; the join back to the rows is one that adaptive
    execution splits where a group holds a large share of them.
    """
    named = recipes(docs, fingerprint)
    key = ["recipe", "ordinals"]
    groups = named.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return named.join(groups, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs without the rows whose text a larger doc_id has too; all columns stay as they are.

    Repeated rows of a document that stays are that document, and stay.
    """
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id"))
    same = same & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("_kept_text"))
    return docs.join(kept, same, "left_semi")
