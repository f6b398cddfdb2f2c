"""Keyed writes expressed on DataFrames: keep-first, insert-if-absent, upsert.

Keep-first and upsert reduce with an aggregate, so map tasks combine copies
before the shuffle; a key holding a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the least by ``order``, then by the other columns as they
    stand, so the choice never depends on how rows were distributed."""
    return _extreme(F.min, df, keys, order)


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _extreme(F.max, df, keys, order)


def _extreme(pick, df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = [column.alias(f"_order{i}") for i, column in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*ranked, *rest)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def insert_if_absent(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows whose key is not stored yet, ready to append; of rows that
    share a key the least by the other columns."""
    single = keep_first(incoming, keys, []) if set(incoming.columns) - set(keys) else incoming.distinct()
    return single.join(existing.select(*keys), keys, "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows overlaid by incoming ones; an incoming row wins whole."""
    stacked = existing.withColumn("_rank", F.lit(0)).unionByName(
        incoming.select(*existing.columns).withColumn("_rank", F.lit(1))
    )
    return keep_last(stacked, keys, [F.col("_rank")]).drop("_rank")
