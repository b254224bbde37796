"""Looking at and dropping folders in whatever store the tables live in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Full names of what lies in a folder, in order; nothing if it is not there."""
    store, place = _store(spark, path)
    if not store.exists(place):
        return []
    return sorted(status.getPath().toString() for status in store.listStatus(place))


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a file, or of the files of a folder: changes if the data does."""
    store, place = _store(spark, path)
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in store.listStatus(place)))


def drop(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that a table no longer needs."""
    store, place = _store(spark, path)
    store.delete(place, True)
