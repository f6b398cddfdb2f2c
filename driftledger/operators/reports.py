"""The standing reports over facts, scans and the register."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftledger.functions import policy
from driftledger.operators.register import KEY
from driftledger.operators.scans import in_months, latest_findings, newest_date, newest_scan, newest_scans

MICROS_PER_DAY = 86_400_000_000


def total_fact_rows(finding: DataFrame) -> DataFrame:
    return finding.agg(F.count("*").alias("n"))


def by_severity(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Newest scan only; without that filter a problem counts once per scan."""
    return severity_histogram(latest_findings(finding, scan_run))


def severity_histogram(finding: DataFrame) -> DataFrame:
    return finding.groupBy("severity").agg(F.count("*").alias("n")).orderBy(F.desc("severity"))


def by_month(finding: DataFrame) -> DataFrame:
    return finding.groupBy("scan_month").agg(F.count("*").alias("n")).orderBy("scan_month")


def trend(finding: DataFrame) -> DataFrame:
    """High and critical count per scan and its change; the first change is NULL."""
    per_scan = finding.groupBy("scanned_at").agg(
        F.count_if(policy.is_serious(F.col("severity"))).alias("high_crit")
    )
    return changes(per_scan)


def changes(per_scan: DataFrame) -> DataFrame:
    """Each scan's ``high_crit`` beside the one before it. One row per scan is left when
    the unpartitioned window runs."""
    before = F.lag("high_crit").over(Window.orderBy("scanned_at"))
    return (
        per_scan.withColumn("prev", before)
        .withColumn("delta", F.col("high_crit") - F.col("prev"))
        .withColumn("change", policy.signed_change(F.col("delta")))
        .orderBy("scanned_at")
    )


def delta(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """New, resolved and still open between the two newest scans.

    A full outer match of two scans is the presence of a key in each, so one
    aggregation over both replaces reading and sorting them apart.
    """
    pair = newest_scans(scan_run, 2)
    absent = F.lit(False)
    now = pair[0].holds() if pair else absent
    before = pair[1].holds() if len(pair) > 1 else absent
    presence = (
        in_months(finding, pair)
        .filter(now | before)
        .groupBy(*KEY)
        .agg(F.max(now).alias("now"), F.max(before).alias("before"))
    )
    status = F.when(~F.col("before"), "new").when(~F.col("now"), "resolved").otherwise("still open")
    return presence.groupBy(status.alias("status")).agg(F.count("*").alias("n")).orderBy("status")


def aging(finding: DataFrame, scan_run: DataFrame, first_seen: DataFrame | None = None) -> DataFrame:
    """Per severity of the newest scan: count and mean days since first sighting.

    With ``first_seen`` (host, plugin_id, first_seen), which a stored register
    keeps, only the newest scan is read. Without it the history is read once,
    reduced per key with map-side combining, and never joined to itself.
    """
    newest = newest_scan(scan_run)
    if newest is None:
        open_now = finding.limit(0).withColumn("first_seen", F.col("scanned_at"))
    elif first_seen is not None:
        latest = newest.findings(finding).select(*KEY, "severity")
        open_now = latest.join(first_seen.select(*KEY, "first_seen"), KEY)
    else:
        open_now = (
            finding.groupBy(*KEY)
            .agg(
                F.min("scanned_at").alias("first_seen"),
                F.max(F.when(newest.holds(), F.col("severity"))).alias("severity"),
            )
            .filter(F.col("severity").isNotNull())
        )
    as_of = F.lit(newest.micros if newest else None)
    age = (as_of - F.unix_micros("first_seen")).cast("decimal(18,0)")
    mean_days = F.sum("_age") / (F.count("*") * F.lit(MICROS_PER_DAY)).cast("decimal(20,0)")
    return (
        open_now.withColumn("_age", age)
        .groupBy("severity")
        .agg(F.count("*").alias("n"), F.round(mean_days, 1).cast("double").alias("avg_days_open"))
        .orderBy(F.desc("severity"))
    )


def _open(register: DataFrame) -> DataFrame:
    return register.filter(F.col("opened_on").isNotNull() & F.col("closed_on").isNull())


def poam_status(register: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Open commitments per severity against their deadline, and hours to clear."""
    return (
        _open(register)
        .groupBy("severity")
        .agg(
            F.count("*").alias("open"),
            F.count_if(F.col("due_on") < newest_date(scan_run)).alias("overdue"),
            F.max(policy.sla_days(F.col("severity"))).alias("sla_days"),
            F.sum("rom_hours").cast("bigint").alias("rom_to_clear"),
        )
        .orderBy(F.desc("severity"))
    )


def by_owner(register: DataFrame, scan_run: DataFrame) -> DataFrame:
    return (
        _open(register)
        .groupBy("owner")
        .agg(
            F.count("*").alias("open"),
            F.count_if(F.col("due_on") < newest_date(scan_run)).alias("overdue"),
        )
        .orderBy(F.desc("overdue"), "owner")
    )


def overdue(register: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Every open commitment past its deadline, with how late it is."""
    as_of = newest_date(scan_run)
    return _open(register).filter(F.col("due_on") < as_of).select(
        "owner",
        "host",
        "plugin_id",
        "plugin_name",
        "severity",
        F.date_format("due_on", "yyyy-MM-dd").alias("due_on"),
        F.datediff(as_of, F.col("due_on")).alias("days_overdue"),
    )


def worst_overdue(register: DataFrame, scan_run: DataFrame, n: int = 10) -> DataFrame:
    """The top of the overdue list; equal rows are ordered by host and check."""
    return (
        overdue(register, scan_run)
        .orderBy(F.desc("severity"), F.desc("days_overdue"), "host", "plugin_id")
        .limit(n)
    )


def overdue_at(register: DataFrame, scan_run: DataFrame, severity: int) -> DataFrame:
    return (
        overdue(register, scan_run)
        .filter(F.col("severity") == severity)
        .orderBy(F.desc("days_overdue"), "host", "plugin_id")
    )


def backlog_total(register: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Hours to clear the whole open backlog."""
    return poam_status(register, scan_run).agg(
        F.coalesce(F.sum("rom_to_clear"), F.lit(0)).cast("bigint").alias("hours")
    )


def register_counts(register: DataFrame) -> DataFrame:
    opened = register.filter(F.col("opened_on").isNotNull())
    return opened.agg(
        F.count("*").alias("total"), F.count_if(F.col("closed_on").isNull()).alias("still_open")
    )


def trace(finding: DataFrame, host, plugin_id) -> DataFrame:
    """One problem over time."""
    return (
        finding.filter((F.col("host") == host) & (F.col("plugin_id") == plugin_id))
        .select("scanned_at", "host", "plugin_id", "plugin_name", "severity")
        .orderBy("scanned_at")
    )
