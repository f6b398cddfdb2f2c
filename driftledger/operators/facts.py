"""From landed payloads to typed, deduplicated facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftledger.functions.payload import project_payload
from driftledger.operators.keyed import keep_first

# A fact is identified by when it was seen, where, and by which check; source
# and run id are not part of it.
FACT_KEY = ["scanned_at", "host", "plugin_id"]


def project_facts(raw_finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Typed facts from landed payloads; the scan's time is joined from its run."""
    typed = project_payload(raw_finding.select("landing_seq", "scan_run_id", "payload"))
    return typed.join(scan_run.select("scan_run_id", "scanned_at"), "scan_run_id")


def dedup_facts(facts: DataFrame) -> DataFrame:
    """First landed row per fact key, ties broken by worst severity, then cve."""
    carried = [c for c in ("cve", "plugin_name", "severity", "scan_run_id") if c in facts.columns]
    first = keep_first(
        facts.select(*FACT_KEY, "landing_seq", *carried),
        FACT_KEY,
        [F.col("landing_seq"), -F.col("severity").cast("int")],
    )
    return first.drop("landing_seq")


def new_facts(facts: DataFrame, stored: DataFrame) -> DataFrame:
    """Deduplicated facts that are not stored yet; none on a replay."""
    return dedup_facts(facts).join(stored.select(*FACT_KEY), FACT_KEY, "left_anti")
