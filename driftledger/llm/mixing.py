"""Mixing sources to target weights.

Documents get a hash-random key and are range-sorted by it within their source: the key
is uniform, so equal ranges of it hold equal shares and need no sampling. Word counts are
summed per range, the ranges' sums are accumulated (a small table), and a row's place is
its range's offset plus a running sum inside the range. Each source is then cut at its
exact budget; a budget above the source's size repeats whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftledger.llm.common import SPACES, WORD, column, documents, fresh, staged

#: Ranges of the random key per source: a power of two, as many as a source's rows need
#: to fit a task each (1,024 ranges of a million rows hold 10^9 documents a source).
RANGES = 1024
KEY_BITS = 60
CAP = 3
WEIGHTS = (1, 2, 3)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id; equal on every engine and in every run."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target: shares by weight, none above ``cap`` times its source.

    ``sizes`` has one row per source. Sharing the excess again and again ends where every
    source has min(cap * size, weight * level) for one level. With sources in order of
    cap * size / weight, those up to some place are full; the level then follows from what
    the full ones leave. Runs over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    table = sizes.select("source", "source_size", weight.cast("long").alias("w"), (F.col("source_size") * cap).alias("most"))
    fill = W.orderBy((F.col("most") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, every = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    table = table.select(
        "*",
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("full"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("full_w"),
        F.sum("source_size").over(every).alias("whole"),
        F.sum("w").over(every).alias("all_w"),
    )
    # The level if everything before this row is full and nothing from here on is: from the
    # first row where that holds, later ones only give lower levels.
    level = (F.col("whole") - F.col("full")) / (F.col("all_w") - F.col("full_w"))
    table = table.withColumn("level", F.when(level * F.col("w") <= F.col("most"), level))
    level = F.coalesce(F.max("level").over(every), F.lit(0.0))
    return table.select("source", "source_size", F.least(F.col("most").cast("double"), level * F.col("w")).alias("target"))


def mixed(docs: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken, epochs, rest.

    A source's budget is its target rounded to whole words. ``epochs`` is how often the
    document is taken whole and ``rest`` how many of its words the last, partial epoch
    takes (taken = epochs * size + rest); the document at the cut is taken in part, so the
    budget is met to the word. Null texts and texts without words have size 0 and take
    nothing; a null source is a source of its own, last in order. Rows that repeat an id
    sort by size after the key. An empty table gives no rows; extra columns are ignored.
    """
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "source").alias("source"), n_words(column(docs, "text")).alias("size"))
    return placed(staged(rows, "mixing-sizes"), ranges)


def placed(rows: DataFrame, ranges: int = RANGES) -> DataFrame:
    key = random_key(F.col("doc_id"))
    rows = rows.withColumn("key", key).withColumn("range", F.shiftright(F.col("key"), KEY_BITS - (ranges.bit_length() - 1)).cast("int"))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    by_source = sums.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    budget = targets(by_source)
    ahead = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("source", "range", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.join(budget, offsets["source"].eqNullSafe(budget["source"])).drop(budget["source"])
    offsets = offsets.withColumnsRenamed({"source": "of", "range": "part"})
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets, rows["source"].eqNullSafe(offsets["of"]) & (rows["range"] == offsets["part"]))
    goal = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), goal - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("inside")))
    out = rows.withColumn("epochs", epochs.cast("long")).withColumn("rest", rest.cast("long"))
    return out.withColumn("taken", F.col("epochs") * F.col("size") + F.col("rest")).drop("key", "range", "inside", "of", "part", "offset")


def mix(docs: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The mixed table itself: the rows of ``docs``, repeated and cut as the budgets say.

    A document taken k times whole is k rows. The document at a source's cut gives one
    more row with the first words of its text, joined by one blank each, and ``n_chars``,
    where there is such a column, follows. Rows that take no words are left out.
    """
    names = docs.columns
    rows = docs.select(
        column(docs, "doc_id").alias("doc_id"),
        column(docs, "source").alias("source"),
        n_words(column(docs, "text")).alias("size"),
        F.struct(*[column(docs, c).alias(c) for c in names]).alias("row"),
    )
    plan = placed(rows, ranges).filter("taken > 0")
    whole = F.array_repeat(F.lit(0).cast("long"), F.col("epochs").cast("int"))
    part = F.when(F.col("rest") > 0, F.array("rest")).otherwise(F.array().cast("array<bigint>"))
    part = F.when(F.col("rest") == F.col("size"), F.array(F.lit(0).cast("long"))).otherwise(part)
    plan = plan.select("row", F.explode(F.concat(whole, part)).alias("cut"))
    text = F.col("row").getField("text")
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), 1, F.col("cut").cast("int")), " ")
    text = F.when(F.col("cut") == 0, text).otherwise(first)
    fields = {c: F.col("row").getField(c) for c in names}
    fields["text"] = text
    if "n_chars" in fields:
        kind = docs.schema["n_chars"].dataType
        fields["n_chars"] = F.when(F.col("cut") == 0, fields["n_chars"]).otherwise(F.char_length(first).cast(kind))
    return plan.select(*[fields[c].alias(c) for c in names])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
levels AS (SELECT a.source, (SELECT sum(source_size) FROM s) - coalesce(sum(3 * b.source_size), 0) AS left_over,
                  (SELECT sum(w) FROM s) - coalesce(sum(b.w), 0) AS left_w, any_value(a.source_size) AS ss, any_value(a.w) AS w
           FROM s a LEFT JOIN s b ON (3 * b.source_size / b.w, coalesce(b.source, chr(1114111))) < (3 * a.source_size / a.w, coalesce(a.source, chr(1114111)))
           GROUP BY a.source),
lv AS (SELECT max(left_over / left_w) AS level FROM levels WHERE left_over / left_w * w <= 3 * ss),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce((SELECT level FROM lv), 0) * w) AS target FROM s),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS goal,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * size
        + greatest(0, least(size, CASE WHEN source_size > 0 THEN goal % source_size ELSE 0 END - before)))::BIGINT AS taken
FROM r
"""
