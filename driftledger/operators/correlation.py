"""Scanner evidence against the control assessment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftledger.functions import policy
from driftledger.operators.scans import earliest_scan, latest_findings
from driftledger.sources.catalogs import ASSESSOR


def coverage(plugin_control: DataFrame) -> DataFrame:
    """How many checks can speak to each control at all."""
    return plugin_control.groupBy("control_id").agg(F.count("*").alias("sources"))


def control_evidence(finding: DataFrame, plugin_control: DataFrame) -> DataFrame:
    """Findings, worst severity and distinct hosts per control.

    One finding counts under every control its check is evidence for. The map is
    joined without a hint: within the broadcast threshold it is sent to the
    facts, beyond it AQE splits the tasks of a check that dominates. The
    distinct count is exact and combines per (control, host) before it shuffles.
    """
    return (
        finding.select("plugin_id", "host", "severity")
        .join(plugin_control.select("plugin_id", "control_id"), "plugin_id")
        .groupBy("control_id")
        .agg(
            F.count("*").alias("findings"),
            F.max("severity").alias("worst_severity"),
            F.count_distinct("host").alias("hosts_affected"),
        )
    )


def latest_export(control_status: DataFrame) -> DataFrame:
    """The newest assessment export whole; equal times go to the lesser id."""
    newest = (
        control_status.select("exported_at", "export_id")
        .orderBy(F.desc("exported_at"), F.asc("export_id"))
        .limit(1)
        .select("export_id")
        .scalar()
    )
    return control_status.filter(F.col("export_id") == newest)


def assess_controls(
    control: DataFrame,
    plugin_control: DataFrame,
    finding: DataFrame,
    scan_run: DataFrame,
    export_id: str,
    assessed_by: str = ASSESSOR,
) -> DataFrame:
    """A point-in-time assessment dated to the first scan.

    A control fails where a check mapped to it reported high or critical then;
    lesser evidence never reaches the record.
    """
    first = earliest_scan(scan_run)
    # Reduced to the distinct failing checks before it meets the map.
    failing = (
        (first.findings(finding) if first else finding.limit(0))
        .filter(policy.is_serious(F.col("severity")))
        .select("plugin_id")
        .distinct()
    )
    failed = plugin_control.join(failing, "plugin_id", "left_semi").select("control_id").distinct()
    return control.join(failed.withColumn("_failed", F.lit(True)), "control_id", "left").select(
        F.lit(export_id).alias("export_id"),
        (first.time if first else F.lit(None).cast("timestamp")).alias("exported_at"),
        "control_id",
        F.when(F.col("_failed"), policy.NON_COMPLIANT).otherwise(policy.COMPLIANT).alias("compliance"),
        F.lit(assessed_by).alias("assessed_by"),
    )


def correlate(
    control_status: DataFrame,
    control: DataFrame,
    plugin_control: DataFrame,
    finding: DataFrame,
    scan_run: DataFrame,
) -> DataFrame:
    """The newest assessment against the newest scan, one verdict per control."""
    evidence = control_evidence(latest_findings(finding, scan_run), plugin_control)
    judged = (
        latest_export(control_status)
        .select("control_id", "compliance")
        .join(control.select("control_id", "title"), "control_id")
        .join(coverage(plugin_control), "control_id", "left")
        .join(evidence, "control_id", "left")
        .select(
            "control_id",
            "title",
            "compliance",
            F.coalesce("findings", F.lit(0)).alias("findings"),
            "worst_severity",
            F.coalesce("hosts_affected", F.lit(0)).alias("hosts_affected"),
            F.coalesce("sources", F.lit(0)).alias("evidence_sources"),
            policy.verdict(F.col("compliance"), F.col("findings"), F.col("sources")).alias("verdict"),
        )
    )
    return judged.orderBy(
        policy.verdict_rank(F.col("verdict")),
        F.desc(F.coalesce("worst_severity", F.lit(0))),
        F.desc("findings"),
        "control_id",
    )


def flag_verdicts(correlated: DataFrame) -> DataFrame:
    return correlated.withColumn("flag", policy.verdict_flag(F.col("verdict"), F.col("title")))


def uncovered(finding: DataFrame, scan_run: DataFrame, plugin_control: DataFrame) -> DataFrame:
    """Newest findings whose check maps to no control, per check and name.

    Counted per check first, so the anti join sees one row per check, not facts.
    """
    return (
        latest_findings(finding, scan_run)
        .groupBy("plugin_id", "plugin_name")
        .agg(F.max("severity").alias("severity"), F.count("*").alias("findings"))
        .join(plugin_control.select("plugin_id"), "plugin_id", "left_anti")
        .orderBy(F.desc("severity"), F.desc("findings"), "plugin_id", "plugin_name")
    )


def control_drilldown(
    finding: DataFrame, scan_run: DataFrame, plugin_control: DataFrame, control_id: str
) -> DataFrame:
    """What the newest scan holds against one control, by check and severity."""
    checks = plugin_control.filter(F.col("control_id") == control_id).select("plugin_id")
    return (
        latest_findings(finding, scan_run)
        .groupBy("plugin_id", "plugin_name", "severity")
        .agg(F.count("*").alias("findings"))
        .join(checks, "plugin_id", "left_semi")
        .groupBy("plugin_name", "severity")
        .agg(F.sum("findings").cast("bigint").alias("findings"))
    )


def evidence_sources(control: DataFrame, control_status: DataFrame, plugin_control: DataFrame) -> DataFrame:
    """Checks per control and claim, zeros kept: zero means nothing can look."""
    return (
        control.select("control_id")
        .join(control_status.select("control_id", "compliance"), "control_id")
        .join(plugin_control, "control_id", "left")
        .groupBy("control_id", "compliance")
        .agg(F.count("plugin_id").alias("evidence_sources"))
        .orderBy("evidence_sources", "control_id")
    )
