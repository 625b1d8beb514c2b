"""Tables with one row per key, kept by changes: the newest change of a key wins, deletes included.

Changes are appended as files of their own; reading merges them with the base, and :func:`KeyedTable.merge`
writes the merged rows as a new base behind the readers' backs. What is newest says the change's place in
the log (``at``), not the order of delivery: a change that comes late or twice changes nothing that a newer
one has set. So deletes stay in the table as marks, which readers don't see.

The base is never shuffled to be read: its rows leave where the newest changes have their key, so only the
changes are put in order by key. Whether a change is older than its base row must be asked of the base only
if the positions overlap, which the lists of files say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.sources.snapshots import DayTable

#: Where a change stands in its log: the record's position, then the row's place in the record.
AT = "struct<position:bigint,place:int>"
BASE, CHANGES = "base", "changes"


def newest(rows: DataFrame, key: str) -> DataFrame:
    """The newest change of each key, whole. Spark keeps one candidate per key in every task before it shuffles."""
    others = [F.col(name) for name in sorted(rows.columns) if name not in (key, "at")]
    order = Window.partitionBy(key).orderBy(F.col("at").desc(), *others)
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


class KeyedTable:
    """Rows of ``schema`` by ``key``; the base is laid out by ``near``, the column that readers filter on."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, near: str):
        self.spark, self.key, self.near = spark, key, near
        self.names = schema.fieldNames()
        self.stored = StructType.fromDDL(f"at {AT}, deleted boolean, part string")
        self.table = DayTable(spark, path, StructType([*schema.fields, *self.stored.fields]), "part")

    def _put(self, rows: DataFrame, part: str) -> list[dict]:
        """The rows as new files of a part, each list entry with the least and greatest position of them all."""
        found = self.table._written(rows.withColumn("part", F.lit(part))).get(part, [])
        position = F.col("at.position")
        low, high = self.table.frame(found).agg(F.min(position), F.max(position)).first() if found else (None, None)
        return [entry | {"low": low, "high": high} for entry in found]

    def append(self, changes: DataFrame, writer: str, batch: int) -> bool:
        """Add changes (the columns, ``at`` and ``deleted``); False if the writer's batch is there already."""
        version = self.table.version()
        if version["writers"].get(writer, -1) >= batch:
            return False
        new = self._put(newest(changes.select(*self.names, "at", "deleted"), self.key), CHANGES)
        before = self.table.files_of(version, [CHANGES]).get(CHANGES, [])
        self.table._commit(version, {CHANGES: before + new}, {writer: batch})
        return True

    def _parts(self, version: dict) -> tuple[list[dict], list[dict]]:
        found = self.table.files_of(version, [BASE, CHANGES])
        return found.get(BASE, []), found.get(CHANGES, [])

    def _merged(self, version: dict, wanted: str = "true") -> DataFrame:
        """The newest row of each key, delete marks included, of those rows for which ``wanted`` holds."""
        old, new = self._parts(version)
        base = self.table.frame(old)
        if not new:
            return base.where(wanted)
        changes = newest(self.table.frame(new), self.key)
        newer = changes.select(F.col(self.key).alias("_key"), F.col("at").alias("_at"))
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        if old and min(entry["low"] for entry in new) <= max(entry["high"] for entry in old):
            stale = base.select(self.key, "at").join(newer, same & (F.col("at") >= F.col("_at"))).select("_key")
            changes = changes.join(stale, same, "left_anti")
        # The filter may stand on either side alone: a row that leaves the wanted range leaves the base by its key.
        kept = base.where(wanted).join(newer, same & (F.col("_at") > F.col("at")), "left_anti")
        return kept.unionByName(changes.where(wanted))

    def read(self, wanted: str = "true", version: dict | None = None) -> DataFrame:
        """The rows as of one version for which ``wanted``, a condition on the row alone, holds; it reaches the base's scan."""
        return self._merged(version or self.table.version(), wanted).where("not deleted").select(*self.names)

    def merge(self) -> int:
        """Write base and changes as a new base, in one version; gives how many files of changes are gone.

        FileExistsError if a batch has come between: it is not lost, and the merge can be run again.
        """
        version = self.table.version()
        old, new = self._parts(version)
        if not new:
            return 0
        dealt = self._merged(version).repartitionByRange(F.col(self.near), F.col(self.key)).sortWithinPartitions(self.near)
        written = self._put(dealt, BASE)
        self.table._commit(version, {BASE: written, CHANGES: []}, {})
        return len(new)

    def vacuum(self, versions: int = 2) -> int:
        return self.table.vacuum(versions)
