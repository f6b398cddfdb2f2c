"""The commitment register: open on first sighting, close when a scan no longer
sees the problem, reopen when it comes back.

Three forms of one fold over scans:

* :func:`sync` reconciles against the newest scan only, one full outer join.
* :func:`rebuild` gives the register after syncing every scan, oldest first,
  from the fact table in one aggregation.
* :func:`advance` carries a stored register over any number of newly arrived
  scans, reading only their facts.

A step of the fold is an instant: scans that several sources made at one time are one
step, in whatever order they were loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from driftledger.functions import policy
from driftledger.operators import presence
from driftledger.operators.scans import latest_findings, newest_date, scan_chain, source_chains
from driftledger.schemas import REGISTER

KEY = ["host", "plugin_id"]

STEPS = StructType(
    [
        StructField("scan_run_id", StringType()),
        StructField("scanned_at", TimestampType()),
        StructField("step", IntegerType()),
    ]
)


def first_seen(finding: DataFrame) -> DataFrame:
    """When each problem was first observed, over all history."""
    return finding.groupBy(*KEY).agg(F.min("scanned_at").alias("first_seen"))


def commitments(register: DataFrame) -> DataFrame:
    """The register proper: rows that were opened."""
    return register.filter(F.col("opened_on").isNotNull())


def _commit(opened: DataFrame, inventory: DataFrame | None) -> DataFrame:
    """Add what is promised at open time and never recalculated."""
    return policy.assign_owner(opened, inventory).select(
        "*",
        policy.due_on(F.col("opened_on"), F.col("severity")).alias("due_on"),
        policy.rom_hours(F.col("severity")).alias("rom_hours"),
    )


def sync(
    register: DataFrame,
    finding: DataFrame,
    scan_run: DataFrame,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Reconcile against the newest scan; adds ``transition`` to the register.

    ``transition`` is opened, reopened, closed or NULL. Drop it to get the next
    register; :func:`count_transitions` sums it up.
    """
    latest = latest_findings(finding, scan_run).select(*KEY, "plugin_name", "severity")
    known = commitments(register)
    fresh = latest.join(known.select(*KEY), KEY, "left_anti")
    # History is reduced to the keys about to open before it is aggregated.
    since = first_seen(finding.select(*KEY, "scanned_at").join(fresh.select(*KEY), KEY, "left_semi"))
    opening = _commit(
        fresh.join(since, KEY).withColumn("opened_on", F.to_date("first_seen")), inventory
    ).select(*[F.lit(None).cast("date").alias("closed_on") if c == "closed_on" else c for c in REGISTER.names])

    seen = latest.select(*KEY, F.lit(True).alias("_seen"))
    was_open = F.col("closed_on").isNull()
    is_seen = F.col("_seen").isNotNull()
    carried = (
        known.join(seen, KEY, "left")
        .withColumn(
            "transition",
            F.when(was_open & ~is_seen, "closed").when(~was_open & is_seen, "reopened"),
        )
        .withColumn(
            "closed_on",
            F.when(is_seen, F.lit(None)).otherwise(F.coalesce("closed_on", newest_date(scan_run))),
        )
        .drop("_seen")
    )
    return carried.unionByName(opening.withColumn("transition", F.lit("opened")))


def count_transitions(synced: DataFrame) -> DataFrame:
    """One row (opened, reopened, closed) for one :func:`sync`."""
    return synced.agg(
        *[F.count_if(F.col("transition") == t).alias(t) for t in ("opened", "reopened", "closed")]
    )


def rebuild(finding: DataFrame, scan_run: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """The register after a sync per scan, oldest first, in one aggregation.

    A commitment takes name and severity from its first sighting and is closed
    by the scan after its last one, so two extremes per key say it all.
    """
    chain = scan_chain(scan_run).select("scanned_at", F.col("scanned_at").alias("_at"), "next_at")
    at = F.col("_at")  # NULL for a scan no sync was ever run against
    per_key = (
        finding.select("scanned_at", *KEY, "plugin_name", "severity")
        .join(chain, "scanned_at", "left")
        .groupBy(*KEY)
        .agg(
            F.min("scanned_at").alias("first_seen"),
            F.min_by(F.struct("plugin_name", "severity"), at).alias("_first"),
            F.max_by("next_at", at).alias("_closed_at"),
            F.max(at).alias("_last_at"),
        )
    )
    opened = per_key.filter(F.col("_last_at").isNotNull()).select(
        *KEY,
        "first_seen",
        "_first.plugin_name",
        "_first.severity",
        F.to_date("first_seen").alias("opened_on"),
        F.to_date("_closed_at").alias("closed_on"),
    )
    return _commit(opened, inventory).select(*REGISTER.names)


def transitions(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Per scan, how many commitments a sync then would open, reopen and close.

    Each sighting is compared with the same problem's neighbouring sightings;
    the window holds one problem's history, at most one row per scan.
    """
    chain = scan_chain(scan_run).select("scanned_at", "prev_at", "next_at")
    history = Window.partitionBy(*KEY).orderBy("scanned_at")
    moves = (
        finding.select("scanned_at", *KEY)
        .join(chain, "scanned_at")
        .select(
            "scanned_at",
            "prev_at",
            "next_at",
            F.lag("scanned_at").over(history).alias("_before"),
            F.lead("scanned_at").over(history).alias("_after"),
        )
    )
    first = F.col("_before").isNull()
    back = F.col("_before") != F.col("prev_at")
    # A closure happens at the following scan, so it is counted there.
    gone = F.col("next_at").isNotNull() & (F.col("_after").isNull() | (F.col("_after") != F.col("next_at")))
    per_sighting = moves.groupBy("scanned_at", "next_at").agg(
        F.count_if(first).alias("opened"),
        F.count_if(~first & back).alias("reopened"),
        F.count_if(gone).alias("_gone"),
    )
    happened = per_sighting.select("scanned_at", "opened", "reopened", F.lit(0).cast("bigint").alias("closed"))
    left = per_sighting.filter("_gone > 0").select(
        F.col("next_at").alias("scanned_at"), F.lit(0).alias("opened"), F.lit(0).alias("reopened"), F.col("_gone").alias("closed")
    )
    quiet = scan_chain(scan_run).select(
        "scanned_at", F.lit(0).alias("opened"), F.lit(0).alias("reopened"), F.lit(0).alias("closed")
    )
    return _sum_moves(happened.unionByName(left).unionByName(quiet))


def rebuild_by_source(finding: DataFrame, scan_run: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """The register if each source's scans are a chain of their own.

    A problem is open as long as the newest scan of some source reports it: a scan says
    nothing about what only other sources look at. A commitment so closes with the last of
    the sources that ever reported it to miss it.
    """
    per_source = (
        finding.select("scan_run_id", "scanned_at", *KEY, "plugin_name", "severity")
        .join(source_chains(scan_run), "scan_run_id")
        .groupBy(*KEY, "source")
        .agg(
            F.min("scanned_at").alias("_since"),
            F.min_by(F.struct("plugin_name", "severity"), F.struct("scanned_at", "scan_run_id")).alias("_seen"),
            F.min(F.struct("scanned_at", "scan_run_id")).alias("_order"),
            F.max_by("missed_at", "scanned_at").alias("_missed_at"),
        )
    )
    per_key = per_source.groupBy(*KEY).agg(
        F.min("_since").alias("first_seen"),
        F.min_by("_seen", "_order").alias("_first"),
        F.when(F.count("_missed_at") == F.count("*"), F.max("_missed_at")).alias("_closed_at"),
    )
    opened = per_key.select(
        *KEY,
        "first_seen",
        "_first.plugin_name",
        "_first.severity",
        F.to_date("first_seen").alias("opened_on"),
        F.to_date("_closed_at").alias("closed_on"),
    )
    return _commit(opened, inventory).select(*REGISTER.names)


def transitions_by_source(finding: DataFrame, scan_run: DataFrame) -> DataFrame:
    """Per scan time, what opened, reopened and closed in the register by source.

    A sighting holds a problem open until its source's next scan. The holds of one problem,
    in time order, run together where one begins no later than the others end.
    """
    holds = finding.select("scan_run_id", "scanned_at", *KEY).join(source_chains(scan_run), "scan_run_id")
    never = F.lit("9999-12-31").cast("timestamp")
    holds = holds.select(*KEY, "scanned_at", F.coalesce("missed_at", never).alias("until"))
    history = Window.partitionBy(*KEY).orderBy("scanned_at", "until")
    before, after = F.max("until").over(history.rowsBetween(Window.unboundedPreceding, -1)), F.lead("scanned_at").over(history)
    until = F.max("until").over(history.rowsBetween(Window.unboundedPreceding, 0))
    holds = holds.select("scanned_at", before.alias("_before"), until.alias("_until"), after.alias("_after"))
    began = holds.groupBy("scanned_at").agg(
        F.count_if(F.col("_before").isNull()).alias("opened"),
        F.count_if(F.col("_before") < F.col("scanned_at")).alias("reopened"),
        F.lit(0).cast("bigint").alias("closed"),
    )
    ended = holds.filter((F.col("_until") < never) & (F.col("_after").isNull() | (F.col("_after") > F.col("_until"))))
    none = [F.lit(0).cast("bigint").alias(c) for c in ("opened", "reopened")]
    closed = ended.groupBy(F.col("_until").alias("scanned_at")).agg(F.count("*").alias("closed")).select("scanned_at", *none, "closed")
    quiet = scan_run.select("scanned_at", *none, F.lit(0).cast("bigint").alias("closed"))
    return _sum_moves(began.unionByName(closed).unionByName(quiet))


def _sum_moves(moves: DataFrame) -> DataFrame:
    return moves.groupBy("scanned_at").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("opened", "reopened", "closed")]
    )


def advance(
    register: DataFrame,
    arrived: DataFrame,
    steps: DataFrame,
    inventory: DataFrame | None = None,
    n_steps: int | None = None,
) -> DataFrame:
    """Carry a stored register over newly arrived scans.

    ``arrived``: their facts, late scans included. ``steps``: the scan times to
    reconcile against in order, as (scan_run_id, scanned_at, step): step 0 is the
    scan the register was last synced to, if any, and 1..n are newer ones. Facts
    of any other scan only move ``first_seen``, never open or close anything.
    ``n_steps``, where the caller knows it, saves a shuffle for short deliveries.

    Returns the new register plus ``moves``, masks of the scans at which a problem
    opened, reopened and closed (see ``presence``), and ``changed``: false for a row
    that is as it was.
    """
    one_word = n_steps is not None and n_steps < presence.WORD
    batch = presence.seen_words(
        arrived.select("scanned_at", *KEY, "plugin_name", "severity").join(steps.select("scanned_at", "step"), "scanned_at", "left"),
        KEY,
        one_word,
        _since=(F.min, "scanned_at"),
        _first=(F.min_by, F.struct("plugin_name", "severity"), F.col("step")),
        _opened_at=(F.min, "step"),
        _last=(F.max, "step"),
    )
    stored = register.select(*KEY, F.struct(*[c for c in REGISTER.names if c not in KEY]).alias("_old"))
    was_known = F.coalesce(F.col("_old.opened_on").isNotNull(), F.lit(False))
    was_open = was_known & F.col("_old.closed_on").isNull()
    sighted = F.col("_last").isNotNull()
    dates = steps.select(F.col("step").alias("_close_step"), F.to_date("scanned_at").alias("_close_date"))
    merged = (
        stored.join(batch, KEY, "full")
        .select(
            "*",
            was_open.alias("_was_open"),
            (~was_known & sighted).alias("_opens"),
            F.least("_old.first_seen", "_since").alias("_from"),
            # An open commitment counts as seen by the scan it was last synced to.
            (F.coalesce("_last", F.when(was_open, 0)) + 1).alias("_close_step"),
        )
        .join(dates, "_close_step", "left")
    )
    opened_on = F.to_date("_from")
    severity = F.col("_first.severity")
    promise = {
        "plugin_name": F.col("_first.plugin_name"),
        "severity": severity,
        "owner": F.col("owner"),
        "opened_on": opened_on,
        "due_on": policy.due_on(opened_on, severity),
        "rom_hours": policy.rom_hours(severity),
    }
    kept = {
        name: F.when(F.col("_opens"), value).otherwise(F.col(f"_old.{name}")).alias(name)
        for name, value in promise.items()
    }
    kept["first_seen"] = F.col("_from").alias("first_seen")
    closed_on = F.when(F.col("_close_step").isNotNull(), F.col("_close_date")).otherwise(F.col("_old.closed_on"))
    kept["closed_on"] = closed_on.alias("closed_on")
    words = presence.carried(F.col("words"), F.col("_was_open"))
    same = F.col("_old").isNotNull() & ~F.col("_opens") & closed_on.eqNullSafe(F.col("_old.closed_on")) & F.col("_from").eqNullSafe(F.col("_old.first_seen"))
    return policy.assign_owner(merged.withColumn("words", words), inventory).select(
        *[kept.get(name, F.col(name)) for name in REGISTER.names],
        presence.moves(F.col("words"), F.col("_was_open"), F.col("_opens"), F.col("_opened_at")).alias("moves"),
        (~same).alias("changed"),
    )


def count_moves(advanced: DataFrame, steps: DataFrame) -> DataFrame:
    """Per scan of ``steps``, how many commitments opened, reopened and closed."""
    return presence.count_moves(advanced, steps)
