"""Exact dedup by skew-safe combining.

Equal texts are reduced three times, each time comparing the whole normalised text and
not only its digest: inside every input task (the partial aggregate in front of the
first shuffle), then per digest and salt, then over the salts of a digest. A text that
fills a third of all rows so leaves at most one row per task, and the last step gets at
most one row per salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import SALTS, column, documents, fresh, salt_of, spread_join, staged

#: Deleted before texts are compared.
DELETED = "\x20\x09\x0a\x0b\x0c\x0d"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def keyed(docs: DataFrame, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    text = F.coalesce(column(docs, "text"), F.lit(""))
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), text.alias("whole"))
    rows = rows.select("doc_id", F.translate("whole", DELETED, "").alias("norm"), F.char_length("whole").alias("size"))
    return rows.select("doc_id", digest(F.col("norm")).alias("digest"), salt_of(F.col("doc_id"), salts=salts).alias("salt"), "norm", "size")


def best(rank: Column) -> Column:
    """Most code points, then the smallest id; a null id comes last."""
    return F.max(rank)


def classes(rows: DataFrame) -> DataFrame:
    """digest, norm, keep_id, group_size: one row per distinct normalised text."""
    rank = F.struct(F.col("size"), F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("first"))
    task = F.pmod(F.spark_partition_id(), F.lit(SALTS))  # any value is right here: it only deals the groups out
    local = rows.withColumn("task", task).groupBy("digest", "task", "norm").agg(best(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    whole = local.groupBy("digest", "norm").agg(best(F.col("best")).alias("best"), F.sum("n").alias("group_size"))
    return whole.select("digest", "norm", F.bitwise_not("best.first").alias("keep_id"), "group_size")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical after deleting ASCII white space; null counts as
    empty. The row with the most code points stays, of those the smallest doc_id (a null
    id is the largest). Rows that repeat one doc_id with equal texts are one group, and
    ``kept`` is true for each of the winner's rows. An empty table gives no rows. Extra
    columns are ignored. Two texts under one digest stay apart: where that happens, the
    groups of such digests are made again and their rows join on the text itself.
    """
    rows = keyed(docs, digest, salts)
    groups = staged(classes(rows).select("digest", "keep_id", "group_size"), "exact-groups")
    clash = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    if clash.isEmpty():
        out = spread_join(rows.drop("norm", "size"), groups, "digest", "salt")
    else:
        clash = staged(clash, "exact-clashes")
        plain = spread_join(rows.drop("norm", "size").join(clash, "digest", "left_anti"), groups.join(clash, "digest", "left_anti"), "digest", "salt")
        same = rows.join(clash, "digest", "left_semi")
        same = same.drop("size").join(classes(same), ["digest", "norm"])
        out = plain.unionByName(same.drop("norm"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one per group.

    Where rows share both id and normalised text, one of them is taken.
    """
    id_, digest, kept_digest = fresh(docs.columns, "keep_id"), fresh(docs.columns, "digest"), fresh(docs.columns, "kept_digest")
    groups = exact_groups(docs).filter("kept")
    winners = staged(groups.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")), "exact-winners")
    text = F.translate(F.coalesce(column(docs, "text"), F.lit("")), DELETED, "")
    rows = docs.withColumn(digest, sha256(text))
    keys = winners.select(F.col("doc_id").alias(id_), F.col("digest").alias(kept_digest))
    kept = rows.join(keys, column(docs, "doc_id").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(kept_digest)), "left_semi")
    if not winners.filter("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", digest])
    return kept.drop(digest)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


SQL = """
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(whole) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(whole) DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS whole,
             regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents)
"""
