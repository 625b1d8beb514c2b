"""Small files next to tables, through the file systems that Spark knows; used on the driver only."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def listed(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Finished files of a folder in the order of their names; none if it is not there."""
    system, place = _at(spark, folder)
    if not system.exists(place):
        return []
    found = [entry.getPath() for entry in system.listStatus(place) if entry.isFile()]
    return sorted(str(path) for path in found if path.getName().endswith(suffix) and not path.getName().startswith("."))


def text_of(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file, whole or not at all; FileExistsError if the name is taken."""
    jvm = spark._jvm
    system, place = _at(spark, path)
    parent = place.getParent()
    system.mkdirs(parent)
    hidden = jvm.org.apache.hadoop.fs.Path(parent, f".{place.getName()}.{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # rename of some file systems overwrites, so the name is looked up first; tables have one writer.
    if system.exists(place) or not system.rename(hidden, place):
        system.delete(hidden, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders of one file system, in this order."""
    if paths:
        system, _ = _at(spark, paths[0])
        for path in paths:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def full(spark: SparkSession, path: str) -> str:
    """The path as the file system writes it, with its scheme."""
    system, place = _at(spark, path)
    return str(system.makeQualified(place))


def below(spark: SparkSession, folder: str, suffix: str) -> list[tuple[str, int]]:
    """All files below a folder with their bytes."""
    system, place = _at(spark, folder)
    if not system.exists(place):
        return []
    entries, found = system.listFiles(place, True), []
    while entries.hasNext():
        entry = entries.next()
        if entry.getPath().getName().endswith(suffix):
            found.append((str(entry.getPath()), entry.getLen()))
    return sorted(found)


def folder(spark: SparkSession, path: str) -> None:
    """Make the folder if it is not there."""
    system, place = _at(spark, path)
    system.mkdirs(place)
