"""The register in buckets of the key's hash, copied on write.

A version of a bucket is a folder that never changes; which version of each bucket counts
is the manifest's to say. A load rewrites the buckets in which something changed and leaves
all others where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger import storage
from driftledger.operators.register import KEY
from driftledger.schemas import REGISTER
from driftledger.session import local_frame


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def read(spark: SparkSession, folder: str, versions: dict[int, int]) -> DataFrame:
    """The register rows of the given buckets, each from its version."""
    if not versions:
        return local_frame(spark, [], REGISTER)  # of a size that the planner knows
    paths = [f"{folder}/version={version}/bucket={bucket}" for bucket, version in sorted(versions.items())]
    return spark.read.schema(REGISTER).parquet(*paths)


def write(register: DataFrame, folder: str, version: int, buckets: int) -> None:
    """Write whole buckets as ``version``; what a load that died left there is replaced."""
    place = f"{folder}/version={version}"
    storage.delete(register.sparkSession, place)
    rows = register.select(*REGISTER.names, bucket_of(buckets).alias("bucket"))
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(place)


def rewritten(current: DataFrame, changed: DataFrame) -> DataFrame:
    """Buckets with their changed rows put in place of the old ones."""
    return current.join(changed.select(*KEY), KEY, "left_anti").unionByName(changed.select(*REGISTER.names))


def forget(spark: SparkSession, folder: str, kept: set[tuple[int, int]], newest: int) -> int:
    """Delete the bucket folders up to version ``newest`` that are not among ``kept`` (bucket, version)."""
    gone = 0
    for name in storage.folders(spark, folder):
        version = int(name.split("=")[1])
        if version > newest:
            continue
        for bucket in storage.folders(spark, f"{folder}/{name}"):
            if (int(bucket.split("=")[1]), version) not in kept:
                storage.delete(spark, f"{folder}/{name}/{bucket}")
                gone += 1
        if not storage.folders(spark, f"{folder}/{name}"):
            storage.delete(spark, f"{folder}/{name}")
    return gone
