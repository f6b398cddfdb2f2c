"""What several operators need: columns, shared tables, salted groups, Arrow passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftledger.session import scratch_dir

#: White space of every contract here: the six ASCII characters, nothing of Unicode's.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"
SALTS = 64
NO_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(docs: DataFrame, name: str) -> Column:
    """A column of a caller's table, whatever characters its name has."""
    return docs["`" + name.replace("`", "``") + "`"]


def staged(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_exchanges(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def held_out(doc_id: Column) -> Column:
    """Rows that no model here learns from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def salt_of(*columns: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def through_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType, most_bytes: str = "16m") -> DataFrame:
    """One Arrow batch in, any number out, as a narrow stage.

    Batches are bounded in bytes as well as rows, since texts may be very long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)

    return in_batches(df, most_bytes).mapInArrow(run, schema)


def in_batches(df: DataFrame, most_bytes: str = "16m") -> DataFrame:
    """From here on Arrow batches have so many bytes and 4,000 rows at most."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes)
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return df


def in_pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``most_bytes`` of text (or one row)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


def spread_join(rows: DataFrame, groups: DataFrame, key: str, salt: str) -> DataFrame:
    """Give every row the columns of its group, however many rows one group has.

    ``groups`` has one row per ``key``. The pairs (key, salt) that occur are found with
    a partial aggregate, take the group's columns first (at most one row per salt), and
    the rows then join on the pair, so one key's rows arrive at as many places as there
    are salts. Keys must not be null.
    """
    pairs = rows.select(key, salt).groupBy(key, salt).agg(F.lit(1).alias("_n")).drop("_n")
    return rows.join(pairs.join(groups, key), [key, salt])
