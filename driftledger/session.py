"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Batches of a few thousand scan files are normal; keep read tasks near the
    # size of one parquet row group so a task's output fits in memory.
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app_name: str = "driftledger", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates, months and run ids are all read off the clock in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for what is run inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="driftledger-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "smallint": pa.int16(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "timestamp": pa.int64(),
    "date": pa.date32(),
}


def local_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A short driver-side list as a relation whose size the planner knows.

    Timestamps are given as microseconds since the epoch, free of any time zone.
    """
    kinds = [f.dataType.simpleString() for f in schema.fields]
    columns = list(zip(*rows)) or [()] * len(kinds)
    arrays = [pa.array(values, _ARROW_TYPES[kind]) for values, kind in zip(columns, kinds)]
    frame = spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names))
    return frame.select(
        *[F.timestamp_micros(n).alias(n) if kind == "timestamp" else F.col(n) for n, kind in zip(schema.names, kinds)]
    )
