"""Counts per scan, severity and check, kept beside the facts.

A load counts its new facts only; counts of one cell from several loads add up. What asks
for totals over history reads these few rows and no fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftledger.functions import policy
from driftledger.operators import reports
from driftledger.operators.scans import in_months, newest_scan

CELL = ["scanned_at", "scan_run_id", "severity", "plugin_id", "scan_month"]


def roll_up(finding: DataFrame) -> DataFrame:
    return finding.groupBy(*CELL).agg(F.count("*").alias("n"))


def merged(rollup: DataFrame) -> DataFrame:
    """One row per cell."""
    return rollup.groupBy(*CELL).agg(F.sum("n").alias("n"))


def total_fact_rows(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))


def by_severity(rollup: DataFrame, scan_run: DataFrame) -> DataFrame:
    """The newest scan's cells only, of its month's partition."""
    newest = newest_scan(scan_run)
    cells = in_months(rollup, [newest]).filter(newest.holds()) if newest else rollup.limit(0)
    return severity_histogram(cells)


def severity_histogram(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("severity").agg(F.sum("n").alias("n")).orderBy(F.desc("severity"))


def by_month(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("scan_month").agg(F.sum("n").alias("n")).orderBy("scan_month")


def trend(rollup: DataFrame) -> DataFrame:
    serious = F.when(policy.is_serious(F.col("severity")), F.col("n")).otherwise(0)
    return reports.changes(rollup.groupBy("scanned_at").agg(F.sum(serious).alias("high_crit")))


def by_check(rollup: DataFrame) -> DataFrame:
    """How often each check has reported, over all scans."""
    return rollup.groupBy("plugin_id").agg(F.sum("n").alias("n"), F.count_distinct("scanned_at").alias("scans")).orderBy("plugin_id")
