"""Choosing scans: newest, earliest, their order, and the facts they hold.

A chosen scan is looked up in the scan list first and reaches the fact table as
literals: its month prunes partitions and its time prunes row groups before a
fact row is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftledger.functions.identity import run_id, scan_month
from driftledger.schemas import SCAN_RUN
from driftledger.session import local_frame

SCANS = StructType([SCAN_RUN[name] for name in ("scan_run_id", "scanned_at", "source")])


@dataclass(frozen=True)
class Scan:
    scan_run_id: str
    micros: int

    @property
    def time(self) -> Column:
        return F.timestamp_micros(F.lit(self.micros))

    def holds(self) -> Column:
        """Whether a fact belongs to this scan."""
        return (F.col("scanned_at") == self.time) & (F.col("scan_run_id") == self.scan_run_id)

    def findings(self, finding: DataFrame) -> DataFrame:
        return in_months(finding, [self]).filter(self.holds())


def in_months(finding: DataFrame, scans: list[Scan]) -> DataFrame:
    """Only the partitions the scans are stored in, where facts are stored by month."""
    if "scan_month" not in finding.columns:
        return finding
    return finding.filter(F.col("scan_month").isin([scan_month(s.time) for s in scans]))


def newest_scans(scan_run: DataFrame, n: int) -> list[Scan]:
    """The ``n`` newest scans of all sources; equal times go to the lesser id."""
    return _lookup(scan_run.orderBy(F.desc("scanned_at"), F.asc("scan_run_id")).limit(n))


def earliest_scan(scan_run: DataFrame) -> Scan | None:
    return next(iter(_lookup(earliest_run(scan_run))), None)


def newest_scan(scan_run: DataFrame) -> Scan | None:
    return next(iter(newest_scans(scan_run, 1)), None)


def _lookup(chosen: DataFrame) -> list[Scan]:
    return [Scan(*row) for row in chosen.select("scan_run_id", F.unix_micros("scanned_at")).collect()]


def latest_run(scan_run: DataFrame) -> DataFrame:
    return scan_run.orderBy(F.desc("scanned_at"), F.asc("scan_run_id")).limit(1)


def earliest_run(scan_run: DataFrame) -> DataFrame:
    return scan_run.orderBy(F.asc("scanned_at"), F.asc("scan_run_id")).limit(1)


def newest_date(scan_run: DataFrame) -> Column:
    """The "as of" date: lateness is measured from the last time anyone looked."""
    newest = newest_scan(scan_run)
    return F.to_date(newest.time) if newest else F.lit(None).cast("date")


def latest_findings(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    newest = newest_scan(scan_run)
    return newest.findings(finding) if newest else finding.limit(0)


def scan_chain(scan_run: DataFrame) -> DataFrame:
    """Scans the register is reconciled against, each with its neighbours' times.

    One row per scan time (the lesser id where two sources share an instant).
    The windows run over the scan list, never over facts.
    """
    in_order = Window.orderBy("scanned_at", "scan_run_id")
    runs = (
        scan_run.select("scan_run_id", "scanned_at")
        .distinct()
        .withColumn("_same", F.lag("scanned_at").over(in_order) == F.col("scanned_at"))
        .filter(~F.coalesce("_same", F.lit(False)))
    )
    return runs.select(
        "scan_run_id",
        "scanned_at",
        F.row_number().over(in_order).alias("scan_rank"),
        F.lag("scanned_at").over(in_order).alias("prev_at"),
        F.lead("scanned_at").over(in_order).alias("next_at"),
    )


def named(sightings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scans of (source, scanned_at, ...) rows, and the rows with their ``scan_run_id``.

    An id is made once a scan and sent to its rows. The scans pass through the driver, one
    short row each; finding them reads no other column.
    """
    source, at = F.col("source"), F.col("scanned_at")
    times = sightings.select(source, at).distinct().select(run_id(source, at), F.unix_micros(at), source)
    runs = local_frame(sightings.sparkSession, [tuple(r) for r in times.collect()], SCANS)
    ids = F.broadcast(runs.select("scan_run_id", at.alias("_at"), source.alias("_source")))
    rows = sightings.join(ids, at.eqNullSafe(F.col("_at")) & source.eqNullSafe(F.col("_source")))
    return runs, rows.drop("_at", "_source")


def source_chains(scan_run: DataFrame) -> DataFrame:
    """Per run its source and the time of that source's next scan, which misses what the
    run reported and it does not. Runs over the scan list."""
    following = Window.partitionBy("source").orderBy("scanned_at")
    return scan_run.select("scan_run_id", "source", F.lead("scanned_at").over(following).alias("missed_at"))


def listed(scan_run: DataFrame, most: int = 200_000) -> DataFrame:
    """The scan list as a relation of known size, if it has at most ``most`` scans.

    A list derived from a large table looks large to the planner, which would
    then shuffle facts to meet it. Counting it first proves it may be broadcast;
    a longer list is returned as it came and joined by shuffling.
    """
    rows = (
        scan_run.select("scan_run_id", F.unix_micros("scanned_at").alias("at"), "source").limit(most + 1).collect()
    )
    if len(rows) > most:
        return scan_run
    return local_frame(scan_run.sparkSession, [tuple(r) for r in rows], SCANS)
