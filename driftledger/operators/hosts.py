"""Distinct hosts as exact, mergeable bitmaps.

A load gives every host it meets first a number and keeps, per scan and check, the numbers
it saw as words of 32,768 bits. The distinct hosts of any checks over any scans are then
the union of some words: a few rows per control go through a shuffle, and no host does.

A number is made of the load's, the task's and the row's: loads need not agree on one
counter, and the hosts of one load lie close together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["scanned_at", "scan_run_id", "plugin_id", "scan_month"]
#: Hosts that one task numbers, and the bits of a number for a load's tasks and a task's rows.
PER_TASK = 1 << 20
TASK_BITS, ROW_BITS = 14, 23


def unknown(finding: DataFrame, known: DataFrame) -> DataFrame:
    """The facts' hosts without a number."""
    return finding.filter("host IS NOT NULL").select("host").distinct().join(known.select("host"), "host", "left_anti")


def numbered(hosts: DataFrame, load_seq: int, per_task: int = PER_TASK) -> DataFrame:
    """host, host_no of distinct hosts. Numbers hold once written: a task that is run
    again may deal its own out in another way, but only one attempt's output counts."""
    tasks = -(-hosts.count() // per_task) or 1
    if tasks >= 1 << TASK_BITS:
        raise ValueError(f"{tasks} tasks of new hosts in one load: raise per_task")
    rows = hosts.repartition(tasks, "host").select("host", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"))
    first = F.lit(load_seq << (TASK_BITS + ROW_BITS)) + F.shiftleft(F.spark_partition_id().cast("bigint"), ROW_BITS)
    within = F.assert_true(F.col("row") < 1 << ROW_BITS, F.lit("too many hosts in one task")).isNull()
    return rows.filter(within).select("host", (first + F.col("row") + 1).alias("host_no"))


def reach(finding: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per scan, check and word of numbers: the hosts seen, as bits."""
    seen = finding.select(*CELL, "host").join(numbers.select("host", "host_no"), "host")
    word = F.bitmap_bucket_number("host_no").alias("word")
    return seen.groupBy(*CELL, word).agg(F.bitmap_construct_agg(F.bitmap_bit_position("host_no")).alias("bits"))


def merged(reach: DataFrame) -> DataFrame:
    """One row per cell and word, whatever loads they came in."""
    return reach.groupBy(*CELL, "word").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_hosts(reach: DataFrame, *by: str) -> DataFrame:
    """Exact number of hosts per group of any cells."""
    united = reach.groupBy(*by, "word").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("hosts_affected"))


def control_evidence(reach: DataFrame, rollup: DataFrame, plugin_control: DataFrame) -> DataFrame:
    """Findings, worst severity and distinct hosts per control, without a fact being read.

    One finding counts under every control its check is evidence for.
    """
    bridge = plugin_control.select("plugin_id", "control_id")
    counts = rollup.join(bridge, "plugin_id").groupBy("control_id")
    counts = counts.agg(F.sum("n").alias("findings"), F.max("severity").alias("worst_severity"))
    return counts.join(distinct_hosts(reach.join(bridge, "plugin_id"), "control_id"), "control_id", "left").select(
        "control_id", "findings", "worst_severity", F.coalesce("hosts_affected", F.lit(0).cast("bigint")).alias("hosts_affected")
    )
