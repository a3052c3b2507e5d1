"""Files of a shared folder: what Spark's readers and writers do not offer, by the file system Spark itself uses."""

from __future__ import annotations

from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file unless it is there; of several that try at once, one succeeds."""
    system, place = _place(spark, path)
    try:
        out = system.create(place, False)
    except Py4JJavaError as error:
        if system.exists(place):
            return False
        raise error
    out.write(bytearray(content.encode()))
    out.close()
    return True


def content_of(spark: SparkSession, path: str) -> str:
    """The content of a small file, empty if it is gone."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return ""
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if there is none."""
    system, place = _place(spark, path)
    system.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.mkdirs(place)


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, place = _place(spark, old)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not be renamed to {new}")


def set_age(spark: SparkSession, path: str, moment: datetime) -> None:
    system, place = _place(spark, path)
    system.setTimes(place, int(moment.timestamp() * 1000), -1)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, none if there is no such folder."""
    system, place = _place(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(place)) if system.exists(place) else []
