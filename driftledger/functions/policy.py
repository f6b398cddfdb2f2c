"""Policy expressed as Column functions: deadlines, effort, labels, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Remediation deadline in days and effort in hours by severity,
# severity names, accountable owners, verdicts and compliance wording.
SLA_DAYS = {4: 15, 3: 30, 2: 90, 1: 180}
SLA_DAYS_OTHER = 365
ROM_HOURS = {4: 16, 3: 8, 2: 4, 1: 2}
ROM_HOURS_OTHER = 1
SEVERITY_LABELS = {4: "critical", 3: "high", 2: "medium", 1: "low"}
SEVERITY_LABEL_OTHER = "info"
OWNERS = ["ISSO-Alpha", "ISSO-Bravo", "ISSO-Charlie", "ISSO-Delta", "ISSO-Echo", "ISSO-Foxtrot"]
COMPLIANT, NON_COMPLIANT = "Compliant", "Non-Compliant"
NOT_ASSESSABLE = "not assessable"
CONTRADICTED = "CONTRADICTED"
CORROBORATED = "corroborated"
UNEVIDENCED = "unevidenced"
VERIFIED_CLEAN = "verified clean"
SERIOUS_SEVERITY = 3


def lookup(code: Column, table: dict, other) -> Column:
    chosen = F.lit(other)
    for key, value in table.items():
        chosen = F.when(code == key, F.lit(value)).otherwise(chosen)
    return chosen


def sla_days(severity: Column) -> Column:
    return lookup(severity, SLA_DAYS, SLA_DAYS_OTHER)


def rom_hours(severity: Column) -> Column:
    return lookup(severity, ROM_HOURS, ROM_HOURS_OTHER).cast("smallint")


def severity_label(severity: Column) -> Column:
    return lookup(severity, SEVERITY_LABELS, SEVERITY_LABEL_OTHER)


def due_on(opened_on: Column, severity: Column) -> Column:
    return F.date_add(opened_on, sla_days(severity))


def is_serious(severity: Column) -> Column:
    """High or critical: what an assessor fails a control for."""
    return severity >= SERIOUS_SEVERITY


def owner_bucket(host: Column) -> Column:
    """0..5, the same for a host on every run and every cluster."""
    leading_bits = F.conv(F.substring(F.md5(host), 1, 8), 16, 10).cast("bigint")
    return F.pmod(leading_bits, F.lit(len(OWNERS))).cast("int")


def default_owner(host: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, OWNERS)), owner_bucket(host) + 1)


def assign_owner(df: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """Add ``owner``: the inventory's (host, owner) where known, else by host hash."""
    if inventory is None:
        return df.withColumn("owner", default_owner(F.col("host")))
    known = inventory.select("host", F.col("owner").alias("_inventory_owner"))
    return (
        df.join(known, "host", "left")
        .withColumn("owner", F.coalesce("_inventory_owner", default_owner(F.col("host"))))
        .drop("_inventory_owner")
    )


def verdict(compliance: Column, findings: Column, sources: Column) -> Column:
    """Claim against evidence. The order matters: a control nothing can look at
    must never be reported as clean."""
    seen = F.coalesce(findings, F.lit(0)) > 0
    return (
        F.when(F.coalesce(sources, F.lit(0)) == 0, NOT_ASSESSABLE)
        .when((compliance == COMPLIANT) & seen, CONTRADICTED)
        .when((compliance == NON_COMPLIANT) & seen, CORROBORATED)
        .when(compliance == NON_COMPLIANT, UNEVIDENCED)
        .otherwise(VERIFIED_CLEAN)
    )


def verdict_rank(verdict_col: Column) -> Column:
    ranks = {CONTRADICTED: 0, NOT_ASSESSABLE: 1, CORROBORATED: 2, UNEVIDENCED: 3}
    return lookup(verdict_col, ranks, 4)


def verdict_flag(verdict_col: Column, title: Column) -> Column:
    """The note printed beside the two verdicts a reader must not overlook."""
    return (
        F.when(verdict_col == CONTRADICTED, F.concat(F.lit("  <-- "), title))
        .when(
            verdict_col == NOT_ASSESSABLE,
            F.concat(F.lit("  ("), title, F.lit(" — no scanner can see this)")),
        )
        .otherwise("")
    )


def signed_change(delta: Column) -> Column:
    """``+3``, ``-2``, ``0``; a dash where there was no earlier scan."""
    text = delta.cast("string")
    return (
        F.when(delta.isNull(), "—").when(delta > 0, F.concat(F.lit("+"), text)).otherwise(text)
    )
