"""Folders on whatever storage Spark can reach: asked about, moved and left out on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _of(spark, path)
    return system.exists(place)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder to one that is not there yet; false if it cannot, as when another was first."""
    system, place = _of(spark, source)
    _, goal = _of(spark, target)
    if system.exists(goal):
        return False
    system.mkdirs(goal.getParent())
    return system.rename(place, goal)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _of(spark, path)
    system.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    system, place = _of(spark, path)
    system.mkdirs(place.getParent())
    system.create(place, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, place = _of(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files directly in a folder with their sizes."""
    system, place = _of(spark, path)
    if not system.exists(place):
        return []
    return sorted((s.getPath().getName(), s.getLen()) for s in system.listStatus(place)
                  if s.isFile() and not s.getPath().getName().startswith(("_", ".")))
