"""Folders on whatever file system a path names, through Hadoop's client."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from driftledger.session import local_frame


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if there is no such place."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[tuple[str, int]] | None:
    """(path, length) of a file, or of the files right below a folder; None if there is
    no such place. Names are taken as they are: nothing in them is a pattern."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return None
    status = system.getFileStatus(place)
    if status.isFile():
        return [(status.getPath().toString(), status.getLen())]
    return sorted((s.getPath().toString(), s.getLen()) for s in system.listStatus(place) if s.isFile())


def is_folder(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``; none if there is no such place."""
    return [p.rsplit("/", 1)[-1] for p, _ in files(spark, path) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; one that exists is left alone."""
    system, place = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    stream = system.create(draft, True)
    stream.write(text.encode())
    stream.close()
    if not system.rename(draft, place):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.mkdirs(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def read_table(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """A Parquet folder, empty as long as nothing has been written to it."""
    if not exists(spark, path):
        return local_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(path)
