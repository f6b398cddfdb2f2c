"""The given tables read as scan history.

Two relations stand in for scan exports. Both run over their whole table.

A, from ``events``: a day is a scan, a user a host, an event type a check, and
an event a landed sighting, so the landing holds duplicates to drop.

B, from ``lineitem``: a ship month is a scan, a supplier in a year a host (assets
are re-issued yearly, which keeps the newest commitments on both sides of their
deadlines) and a part's residue a check. Check 3 is superseded by check 23 from
April 1995 on, so that evidence seen at assessment time is gone today.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.functions import policy
from driftledger.functions.identity import DEFAULT_SOURCE, run_id, scan_month
from driftledger.functions.payload import to_payload
from driftledger.operators.facts import dedup_facts
from driftledger.operators.scans import Scan, listed
from driftledger.schemas import CONTROL, FINDING, PLUGIN_CONTROL
from driftledger.session import local_frame

# Check id and severity of each event type.
EVENT_CHECKS = {"error": (104, 4), "purchase": (103, 3), "click": (102, 2), "view": (101, 1), "signup": (100, 0)}
# Relation B's controls and evidence map; check 99 never occurs.
CONTROLS_B = [("C1", "Cipher strength", "C"), ("C2", "Inventory", "C"), ("C3", "Boundary", "C"), ("C4", "Training", "C"), ("C5", "Patching", "C")]
EVIDENCE_B = [(4, "C1"), (9, "C1"), (1, "C2"), (2, "C2"), (99, "C3"), (3, "C5")]
EVIDENCE_A = [(104, "C1"), (103, "C1"), (103, "C2"), (101, "C2"), (99, "C3"), (102, "C5"), (100, "C5")]
EXPORT_ID_B = "7f9d2c10-0000-4000-8000-000000000001"
SUPERSEDED_CHECK, SUPERSEDING_CHECK, SUPERSEDED_FROM = 3, 23, "1995-04-01"
CHECKS_B = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sightings_a(events: DataFrame) -> DataFrame:
    """Every event as a sighting, duplicates included."""
    check = F.col("event_type")
    code = policy.lookup(check, {k: v[0] for k, v in EVENT_CHECKS.items()}, -1)
    severity = policy.lookup(check, {k: v[1] for k, v in EVENT_CHECKS.items()}, 0)
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").alias("landing_seq"),
        F.to_date("ts").cast("timestamp").alias("scanned_at"),
        F.col("user_id").cast("string").alias("host"),
        code.cast("int").alias("plugin_id"),
        check.alias("plugin_name"),
        severity.cast("smallint").alias("severity"),
        F.when(check == "error", F.concat(F.lit("CVE-2024-"), F.lpad(k, 4, "0"))).alias("cve"),
    )


def with_run(sightings: DataFrame) -> DataFrame:
    return sightings.withColumn("scan_run_id", run_id(F.lit(DEFAULT_SOURCE), F.col("scanned_at")))


def finding_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = with_run(dedup_facts(sightings_a(table(spark, sf_dir, "events"))))
    return facts.withColumn("scan_month", scan_month(F.col("scanned_at"))).select(*FINDING.names)


def scan_run_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    return runs_on(days)


def raw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing form: run id and JSON payload."""
    landed = with_run(sightings_a(table(spark, sf_dir, "events")))
    return landed.select("landing_seq", "scan_run_id", to_payload().alias("payload"))


def finding_b(spark: SparkSession, sf_dir: str, only: list[Scan] | None = None) -> DataFrame:
    """Facts of every month, or of the months of the scans in ``only``. Those reach the
    raw date as bounds, since a filter on the month made from it prunes nothing."""
    items = table(spark, sf_dir, "lineitem")
    if only is not None:
        shipped = F.col("l_shipdate")
        within = [(shipped >= F.to_date(s.time)) & (shipped < F.add_months(F.to_date(s.time), 1)) for s in only]
        items = items.filter(reduce(Column.__or__, within, F.lit(False)))
    d = F.trunc("l_shipdate", "MM")
    residue = (F.col("l_partkey") % CHECKS_B).cast("int")
    check = F.when(
        (residue == SUPERSEDED_CHECK) & (d >= F.lit(SUPERSEDED_FROM).cast("date")), SUPERSEDING_CHECK
    ).otherwise(residue)
    keys = items.select(
        d.alias("d"), F.col("l_suppkey").alias("supplier"), check.alias("plugin_id")
    )
    scanned_at = F.col("d").cast("timestamp")
    return keys.distinct().select(
        scanned_at.alias("scanned_at"),
        F.col("d").cast("string").alias("scan_run_id"),
        F.concat("supplier", F.lit("-"), F.year("d")).alias("host"),
        "plugin_id",
        F.concat(F.lit("check "), "plugin_id", F.lit(" rev "), F.col("supplier") % 2).alias("plugin_name"),
        (F.col("plugin_id") % 5).cast("smallint").alias("severity"),
        F.lit(None).cast("string").alias("cve"),
        scan_month(scanned_at).alias("scan_month"),
    ).select(*FINDING.names)


def scan_run_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", "MM").alias("d")).distinct()
    at = F.col("d").cast("timestamp")
    return listed(
        months.select(F.col("d").cast("string").alias("scan_run_id"), at.alias("scanned_at"), F.lit(DEFAULT_SOURCE).alias("source"))
    )


def runs_on(dates: DataFrame) -> DataFrame:
    """A scan per date ``d``."""
    at = F.col("d").cast("timestamp")
    source = F.lit(DEFAULT_SOURCE)
    return listed(dates.select(run_id(source, at).alias("scan_run_id"), at.alias("scanned_at"), source.alias("source")))


def controls_b(spark: SparkSession) -> DataFrame:
    return local_frame(spark, CONTROLS_B, CONTROL)


def evidence_b(spark: SparkSession) -> DataFrame:
    return local_frame(spark, EVIDENCE_B, PLUGIN_CONTROL)
