"""Which landed rows count: of a row delivered more than once, the newest delivery's.

A whole file replaces all that earlier deliveries landed for its run, by nothing where it
has no items any more. Rows of a stream add to their run; a row that comes again (the same
run, host and place) takes the place of its earlier copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW = ["scan_run_id", "host", "landing_seq"]


def resolve(landed: DataFrame, landed_run: DataFrame) -> DataFrame:
    """The rows of ``landed`` that count. ``landed_run``: (scan_run_id, whole, load_seq),
    a row per run and delivery. What one delivery has twice counts twice in a file, whose
    hosts may come in several parts, and once in a stream."""
    resets = landed_run.filter("whole").groupBy("scan_run_id").agg(F.max("load_seq").alias("_reset"))
    added = landed_run.filter("NOT whole").select("scan_run_id", "load_seq", F.lit(True).alias("_added")).distinct()
    current = landed.join(resets, "scan_run_id", "left").filter("_reset IS NULL OR load_seq >= _reset").drop("_reset")
    current = current.join(added, ["scan_run_id", "load_seq"], "left")
    copies = Window.partitionBy(*ROW).orderBy(F.desc("load_seq"), "payload")
    current = current.select("*", F.rank().over(Window.partitionBy(*ROW).orderBy(F.desc("load_seq"))).alias("_age"), F.row_number().over(copies).alias("_copy"))
    return current.filter("_age = 1 AND (_added IS NULL OR _copy = 1)").select(*landed.columns)
