"""Names of stored folders and small lists, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    system, place = _open(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def parents(spark: SparkSession, path: str, name: str) -> set[str]:
    """Names of the folders in a folder that hold something of the given name: one call, however many they are."""
    system, place = _open(spark, f"{path}/*/{name}")
    return {f.getPath().getParent().getName() for f in system.globStatus(place) or ()}


def delete(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.delete(place, True)


def write(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which has its name only once it is complete."""
    unfinished = f"{path}.{uuid.uuid4().hex}.tmp"
    system, place = _open(spark, unfinished)
    stream = system.create(place, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not system.rename(place, _open(spark, path)[1]):
        raise FileExistsError(path)


def read(spark: SparkSession, path: str) -> str:
    system, place = _open(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
