"""From documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftledger.llm import exact_dedup, mixing, packing, quality, simhash
from driftledger.llm.common import documents, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_bad(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, *packing.VOCABULARY)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL fits a model or encodes text: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
