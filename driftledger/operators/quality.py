"""Constraints as jobs: each returns the offending values and their row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftledger.functions import policy
from driftledger.operators.facts import FACT_KEY
from driftledger.operators.scans import latest_run, newest_scan


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_fk(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child values without a parent. The child is counted per value before the
    join, so a dominant value arrives as one row."""
    values = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return values.join(parent.select(F.col(parent_key or key).alias(key)), key, "left_anti")


def check_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    outside = F.col(column).isNull() | ~F.col(column).isin(allowed)
    return df.filter(outside).groupBy(column).agg(F.count("*").alias("n"))


def zero_finding_newest_scan(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """The newest scan if it found nothing: syncing to it closes every commitment."""
    newest = newest_scan(scan_run)
    run = latest_run(scan_run.select("scan_run_id", "scanned_at", "source"))
    if newest is None:
        return run
    # Its month alone is opened, and a task stops at its first row.
    return run.join(newest.findings(finding).select("scan_run_id").limit(1), "scan_run_id", "left_anti")


#: Kept per month or register bucket that was written.
KEPT = [
    "scan_run: id unique",
    "scan_run: source and time unique",
    "finding: key unique",
    "register: key unique",
    "raw_finding: run known",
    "newest scan: has findings",
]


def _counted(bad: DataFrame, name: str, scope: str | None = None) -> DataFrame:
    """Offending values of one constraint, counted as a whole or per value of ``scope``."""
    if scope is None:
        return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("constraint"), F.lit("").alias("scope"), "violations")
    return bad.groupBy(F.col(scope).cast("string").alias("scope")).agg(F.sum("_bad").cast("bigint").alias("violations")).select(F.lit(name).alias("constraint"), "scope", "violations")


def _repeated(df: DataFrame, keys: list[str], scope: str) -> DataFrame:
    """Per key 1 if it is there more than once, else 0, so that a clean scope is counted, too."""
    return df.groupBy(scope, *keys).agg((F.count("*") > 1).cast("int").alias("_bad"))


def delivery_report(
    finding: DataFrame, landed: DataFrame, scan_run: DataFrame, register: DataFrame, newest: DataFrame | None
) -> DataFrame:
    """(constraint, scope, violations) of what deliveries wrote.

    ``finding``: all facts at their scan times, since a key has its scan's time. ``landed``:
    the rows they landed. ``register``: the buckets they rewrote, with ``bucket``.
    ``newest``: the counts kept of the newest scan, if there was a delivery. The scan list
    is small and whole.
    """
    found = [
        _counted(check_unique(scan_run, ["scan_run_id"]), KEPT[0]),
        _counted(check_unique(scan_run, ["source", "scanned_at"]), KEPT[1]),
        _counted(_repeated(finding, FACT_KEY, "scan_month"), KEPT[2], "scan_month"),
        _counted(_repeated(register, ["host", "plugin_id"], "bucket"), KEPT[3], "bucket"),
        _counted(_unknown_runs(landed, scan_run), KEPT[4], "scan_month"),
    ]
    if newest is not None:
        empty = newest.agg((F.coalesce(F.sum("n"), F.lit(0)) == 0).cast("bigint").alias("violations"))
        found.append(empty.select(F.lit(KEPT[5]).alias("constraint"), F.lit("").alias("scope"), "violations"))
    return reduce(DataFrame.unionAll, found)


def _unknown_runs(landed: DataFrame, scan_run: DataFrame) -> DataFrame:
    per_run = landed.groupBy("scan_month", "scan_run_id").agg(F.count("*").alias("n"))
    known = scan_run.select("scan_run_id", F.lit(True).alias("_known"))
    return per_run.join(known, "scan_run_id", "left").withColumn("_bad", F.col("_known").isNull().cast("int"))


def kept_report(violation: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per constraint, the newest of each scope, and of the catalogues as they
    are. Zeros are included."""
    newest = violation.groupBy("constraint", "scope").agg(F.max_by("violations", "load_seq").alias("violations"))
    known = newest.groupBy("constraint").agg(F.sum("violations").cast("bigint").alias("violations"))
    names = violation.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, KEPT))).alias("constraint"))
    kept = names.join(known, "constraint", "left").select("constraint", F.coalesce("violations", F.lit(0)).alias("violations"))
    return kept.unionAll(_report(_catalogue_checks(tables)))


def _catalogue_checks(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "plugin: id unique": check_unique(t["plugin"], ["plugin_id"]),
        "control: id unique": check_unique(t["control"], ["control_id"]),
        "plugin_control: pair unique": check_unique(t["plugin_control"], ["plugin_id", "control_id"]),
        "plugin_control: plugin known": check_fk(t["plugin_control"], t["plugin"], "plugin_id"),
        "plugin_control: control known": check_fk(t["plugin_control"], t["control"], "control_id"),
        "control_status: key unique": check_unique(t["control_status"], ["export_id", "control_id"]),
        "control_status: control known": check_fk(t["control_status"], t["control"], "control_id"),
        "control_status: compliance known": check_domain(
            t["control_status"], "compliance", [policy.COMPLIANT, policy.NON_COMPLIANT]
        ),
    }


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The audit: violations per constraint over all stored relations, zeros included."""
    t = tables
    whole = {
        KEPT[0]: check_unique(t["scan_run"], ["scan_run_id"]),
        KEPT[1]: check_unique(t["scan_run"], ["source", "scanned_at"]),
        KEPT[2]: check_unique(t["finding"], FACT_KEY),
        KEPT[3]: check_unique(t["register"], ["host", "plugin_id"]),
        KEPT[4]: check_fk(t["raw_finding"], t["scan_run"], "scan_run_id"),
        KEPT[5]: zero_finding_newest_scan(t["finding"], t["scan_run"]),
    }
    return _report(whole | _catalogue_checks(t))


def _report(checks: dict[str, DataFrame]) -> DataFrame:
    counted = [
        bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("constraint"), "violations")
        for name, bad in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)
