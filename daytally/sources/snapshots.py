"""Day tables with versions: appended once per batch, compacted behind the readers' backs.

The rows are plain Parquet that Spark writes and reads. Beside them a list per day names its files, and a
version names the lists of all days and the last batch of every writer. A version is one small file that
is there whole or not at all, so a reader sees one version, and a batch that is delivered again after a
failure changes nothing. A step that fails before its version is written leaves files that no version
names; :func:`DayTable.vacuum` removes them. A table has one writing process at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.sources import files

#: Size that compaction aims at.
TARGET_BYTES = 128 * 1024 * 1024


def bins(sizes: list[int], target: int) -> list[list[int]]:
    """Positions in groups of at most ``target`` together: the largest first, each to the first group with room.

    Any two groups hold more than ``target`` together, so there are fewer than 2 * total / target + 1.
    """
    groups: list[list[int]] = []
    room: list[int] = []
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place = next((i for i, left in enumerate(room) if left >= sizes[at]), None)
        if place is None:
            groups.append([at])
            room.append(max(0, target - sizes[at]))
        else:
            groups[place].append(at)
            room[place] -= sizes[at]
    return groups


class DayTable:
    """A table of ``schema`` whose text column ``day`` deals its rows to days."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, day: str):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day
        # Lists never change, so those of the version at hand are read once.
        self.lists: dict[str, list[dict]] = {}

    # Versions

    def versions(self) -> list[str]:
        return files.listed(self.spark, f"{self.path}/versions", ".json")

    def version(self, path: str | None = None) -> dict:
        """``number``, ``days`` (day to the name of its list) and ``writers`` (writer to its last batch)."""
        found = self.versions()
        if path is None and not found:
            return {"number": 0, "days": {}, "writers": {}}
        return json.loads(files.text_of(self.spark, path or found[-1]))

    def files_of(self, version: dict, days: Iterable[str]) -> dict[str, list[dict]]:
        """Files with their bytes, by day; only the lists of those days are opened."""
        found = {}
        for day in days:
            if name := version["days"].get(day):
                if name not in self.lists:
                    self.lists[name] = json.loads(files.text_of(self.spark, f"{self.path}/lists/{name}"))
                found[day] = self.lists[name]
        return found

    def days(self, first: str | None = None, last: str | None = None, version: dict | None = None) -> list[str]:
        known = (version or self.version())["days"]
        return sorted(day for day in known if (first is None or day >= first) and (last is None or day <= last))

    def _commit(self, version: dict, lists: dict[str, list[dict]], writers: dict[str, int]) -> dict:
        """Write the version that follows ``version``; FileExistsError if another has come between."""
        days = dict(version["days"])
        for day, found in lists.items():
            days[day] = f"{uuid.uuid4().hex}.json"
            files.put_text(self.spark, f"{self.path}/lists/{days[day]}", json.dumps(found))
            self.lists[days[day]] = found
        following = {"number": version["number"] + 1, "days": days, "writers": version["writers"] | writers}
        files.put_text(self.spark, f"{self.path}/versions/{following['number']:012d}.json", json.dumps(following))
        named = set(days.values())
        self.lists = {name: found for name, found in self.lists.items() if name in named}
        return following

    # Rows

    def _written(self, rows: DataFrame, *others: str) -> dict[str, list[dict]]:
        """The rows as new files that no version names yet, by day."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        names = self.schema.fieldNames()
        rows.select(*names, *others, F.col(self.day).alias("_day")).write.partitionBy("_day", *others).parquet(folder)
        found: dict[str, list[dict]] = {}
        for path, size in files.below(self.spark, folder, ".parquet"):
            day = path.split("/_day=", 1)[1].split("/", 1)[0]
            found.setdefault(day, []).append({"file": path.removeprefix(self._full()).lstrip("/"), "bytes": size})
        return found

    def _full(self) -> str:
        return files.full(self.spark, self.path)

    def frame(self, found: Iterable[dict]) -> DataFrame:
        paths = [f"{self.path}/{entry['file']}" for entry in found]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, first: str | None = None, last: str | None = None, version: dict | None = None) -> DataFrame:
        """The rows of the days from ``first`` to ``last``, as of one version; other days' files are not touched."""
        version = version or self.version()
        found = self.files_of(version, self.days(first, last, version))
        return self.frame(entry for day in found.values() for entry in day)

    def append(self, rows: DataFrame, writer: str = "", batch: int | None = None) -> bool:
        """Add rows; False, and nothing done, if the writer's batch (they count up) is in the table already."""
        version = self.version()
        if batch is not None and version["writers"].get(writer, -1) >= batch:
            return False
        found = self._written(rows)
        before = self.files_of(version, found)
        self._commit(version, {day: before.get(day, []) + new for day, new in found.items()}, {} if batch is None else {writer: batch})
        return True

    def append_batches(self, rows: DataFrame, number: str, writer: str) -> int:
        """Add a backlog of batches, each row's in column ``number``: one job, and one version for each batch.

        Batches that the table has already are left out. Gives how many were added.
        """
        version = self.version()
        known = version["writers"].get(writer, -1)
        left = rows.where(F.col(number) > known)
        by_batch: dict[int, dict[str, list[dict]]] = {}
        for day, found in self._written(left.repartition(F.col(number)), number).items():
            for entry in found:
                batch = int(entry["file"].split(f"/{number}=", 1)[1].split("/", 1)[0])
                by_batch.setdefault(batch, {}).setdefault(day, []).append(entry)
        for batch in sorted(by_batch):
            before = self.files_of(version, by_batch[batch])
            version = self._commit(version, {day: before.get(day, []) + new for day, new in by_batch[batch].items()}, {writer: batch})
        return len(by_batch)

    def replace(self, rows: DataFrame, days: Iterable[str], writer: str = "", batch: int | None = None) -> bool:
        """Put rows in the place of all that the table has of ``days``."""
        version = self.version()
        if batch is not None and version["writers"].get(writer, -1) >= batch:
            return False
        wanted = set(days)
        found = self._written(rows.where(F.col(self.day).isin(*wanted))) if wanted else {}
        self._commit(version, {day: found.get(day, []) for day in wanted}, {} if batch is None else {writer: batch})
        return True

    # Upkeep

    def compact(self, before: str, target: int = TARGET_BYTES) -> int:
        """Rewrite the small files of days earlier than ``before`` into files of about ``target`` bytes.

        Each group of files is one task's work and becomes one file. Days without two files that fit
        together stay as they are. Gives the number of files that are gone.
        """
        version = self.version()
        merged, kept, gone = {}, {}, 0
        for day, found in self.files_of(version, [d for d in self.days(version=version) if d < before]).items():
            groups = bins([entry["bytes"] for entry in found], target)
            several = [group for group in groups if len(group) > 1]
            if several:
                kept[day] = [found[group[0]] for group in groups if len(group) == 1]
                gone += sum(len(group) - 1 for group in several)
                for group in several:
                    merged |= {found[at]["file"]: len(merged) for at in group[:1]}
                    merged |= {found[at]["file"]: merged[found[group[0]]["file"]] for at in group[1:]}
        if not merged:
            return 0
        # One row per file, in a table of its own size; the join is left to Spark.
        entries = self.spark.createDataFrame([(name, group) for name, group in merged.items()], "_name string, _bin int")
        name = F.regexp_extract(F.col("_metadata.file_path"), "(data/[^/]+/_day=.*)$", 1)
        rows = self.frame({"file": f} for f in merged).withColumn("_name", name).join(entries, "_name")
        dealt = rows.repartition(len(set(merged.values())), "_bin")
        written = self._written(dealt, "_bin")
        self._commit(version, {day: entries + written.get(day, []) for day, entries in kept.items()}, {})
        return gone

    def vacuum(self, versions: int = 2) -> int:
        """Remove files and lists that none of the newest versions names; readers of older ones must be done."""
        alive = [self.version(path) for path in self.versions()[-versions:]]
        lists = {name for version in alive for name in version["days"].values()}
        named = {entry["file"] for version in alive for day in self.files_of(version, version["days"]).values() for entry in day}
        full = self._full()
        written = [path for path, _ in files.below(self.spark, f"{self.path}/data", ".parquet")]
        gone = [path for path in written if path.removeprefix(full).lstrip("/") not in named]
        # Old versions go first: a version whose lists are gone could not be read.
        old = [path for path in files.listed(self.spark, f"{self.path}/lists", ".json") if path.rsplit("/", 1)[1] not in lists]
        files.remove(self.spark, *self.versions()[:-versions], *old, *gone)
        return len(gone)
