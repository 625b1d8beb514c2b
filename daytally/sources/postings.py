"""Words of sale lines as a table: which line of a day holds a word, how often, and how long its name is.

Two tables, both partitioned by day (``dt``), so that a day is put in, or put in again, on its own:

postings    word, the line's key, tf (how often), length (words of the name), head (one row of each line has it)
words       word, df (lines of the day that hold it), total (the words of those lines); the empty word stands
            for the day: its lines with a word, and the words of all of them

Postings are sorted by word in their files, so a search reads its own words' pages of one day.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.functions.text import words

# The usual constants of BM25.
K1, B = 1.2, 0.75
#: The word under which a day's own counts stand; no name has it.
THE_DAY = ""
#: Digits of a score, so that equal scores are equal whatever the order of additions.
DIGITS = 6


class Postings:
    """The three tables below one folder; ``key`` gives the columns that tell lines apart, and their types."""

    def __init__(self, spark: SparkSession, path: str, key: StructType):
        self.spark, self.path, self.fields, self.key = spark, path.rstrip("/"), key, tuple(key.fieldNames())

    def add(self, lines: DataFrame) -> None:
        """Index the days that ``lines`` (dt, sku_name, the key) has; days that are there already are replaced.

        The lines are read once; only the names of their days come to the driver. Names without words, and null names, have no postings. After a failure the days
        must be added again.
        """
        named = lines.select("dt", *self.key, words(F.col("sku_name")).alias("_words")).where("size(_words) > 0")
        spread = named.select("dt", *self.key, "_words", F.posexplode(F.array_distinct("_words")).alias("_at", "word"))
        tf = F.size("_words") - F.size(F.array_remove("_words", F.col("word")))
        rows = spread.select("word", *self.key, tf.alias("tf"), F.size("_words").alias("length"), (F.col("_at") == 0).alias("head"), "dt")
        # A day with most of the rows is split; its pieces are sorted each.
        sorted_rows = rows.hint("rebalance", "dt").sortWithinPartitions("dt", "word")
        seen = Observation("days")
        self._put("postings", sorted_rows.observe(seen, F.collect_set("dt").alias("days")))
        written = self._read("postings").where(F.col("dt").isin(list(seen.get["days"] or [])))
        counted = written.groupBy("dt", "word").agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("total"))
        whole = written.where("head").groupBy("dt").agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("total"))
        both = counted.unionByName(whole.withColumn("word", F.lit(THE_DAY)))
        self._put("words", both.hint("rebalance", "dt").sortWithinPartitions("dt", "word"))

    def _put(self, name: str, rows: DataFrame) -> None:
        rows.write.partitionBy("dt").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")

    def _read(self, name: str) -> DataFrame:
        schema = StructType().add("word", "string")
        if name == "postings":
            schema = StructType([*schema, *self.fields]).add("tf", "integer").add("length", "integer").add("head", "boolean")
        else:
            schema = schema.add("df", "long").add("total", "long")
        return self.spark.read.schema(schema.add("dt", "string")).parquet(f"{self.path}/{name}")

    def hits(self, date: str, keyword: str) -> DataFrame:
        """The key and ``score`` of every line of the day whose name holds every word of the keyword.

        The score is BM25 with the day's own statistics and exact lengths. What comes to the driver is one row
        for the day and one for each word of the keyword. A keyword without words, with a word that the day
        does not have, or a day without lines has no hits, and no postings are read for it.
        """
        wanted = sorted(set(self.spark.range(1).select(words(F.lit(keyword))).first()[0]))
        of_day = F.col("dt") == date
        told = self._read("words").where(of_day & F.col("word").isin([THE_DAY, *wanted])).collect()
        common = {row["word"]: row for row in told}
        found = self._read("postings").where(of_day & F.col("word").isin(wanted))
        if not wanted or len(common) <= len(wanted):
            return found.where(F.lit(False)).select(*self.key, F.lit(0.0).alias("score"))
        lines = common[THE_DAY]["df"]
        mean = common[THE_DAY]["total"] / lines
        parts = [
            F.max(F.when(F.col("word") == word, _part(lines, common[word]["df"], mean))).alias(f"part_{i}")
            for i, word in enumerate(wanted)
        ]
        # One row of a line per word; lines that lack a word have no part for it.
        joined = found.groupBy(*self.key).agg(*parts)
        score = sum((F.col(f"part_{i}") for i in range(1, len(wanted))), F.col("part_0"))
        return joined.select(*self.key, F.round(score, DIGITS).alias("score")).where(F.col("score").isNotNull())

    def page(self, hits: DataFrame, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) of the hits, best first, ties by key; each task keeps no more than its end."""
        return hits.orderBy(F.desc("score"), *self.key).offset((number - 1) * size).limit(size)

    def page_after(self, hits: DataFrame, last: tuple, size: int) -> DataFrame:
        """The page that follows the hit (score, key...); its cost does not grow with depth."""
        score, *key = last
        given = F.struct(*[F.lit(value).cast(hits.schema[name].dataType).alias(name) for name, value in zip(self.key, key, strict=True)])
        behind = (F.col("score") < score) | ((F.col("score") == score) & (F.struct(*self.key) > given))
        return hits.where(behind).orderBy(F.desc("score"), *self.key).limit(size)


def _part(n: int, df: int, mean: float) -> Column:
    """What one word adds to the score of a line that holds it."""
    rarity = math.log(1 + (n - df + 0.5) / (df + 0.5))
    tf = F.col("tf")
    return F.lit(rarity) * tf / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("length") / F.lit(mean)))


def lines_of(page: DataFrame, lines: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The whole lines of one page of hits; the page has a stated size, so it is broadcast."""
    return lines.join(F.broadcast(page), list(key)).select(*lines.columns, "score")
