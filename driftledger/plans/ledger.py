"""The stored relations and the load job that keeps them consistent.

Tables are Parquet folders under one root on shared storage. Every row carries the number
of the load that wrote it, and counts once a manifest says so (``plans/manifest``). A load
writes in this order, nothing of which a reader sees:

1. the load's number, so that no other load ever takes it;
2. landing rows, beside those that earlier deliveries landed for the same runs;
3. facts that are not stored yet, in their month;
4. the new facts' counts per scan, severity and check, numbers for hosts never seen
   before, and the hosts' bitmaps per scan and check;
5. the delivery's runs;
6. a note that the load is complete and waits for a reconciliation;
7. new versions of the register buckets in which something changed;
8. the manifest, which publishes all of it at once.

Steps 1 to 6 are :meth:`Ledger.store`, the others :meth:`Ledger.reconcile`. Any number of
deliveries may be stored before one reconciliation, in any order of their scans. A load that
died is simply run again: what it left behind has a number that never counts.

There is one writer at a time. Readers hold a :class:`Snapshot`, one manifest's state, for
as long as :meth:`Ledger.vacuum` keeps it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from driftledger import schemas, storage
from driftledger.functions.identity import DEFAULT_SOURCE, scan_month
from driftledger.functions.payload import to_payload
from driftledger.operators import correlation, facts, hosts, keyed, landing, quality, register, reports, rollup
from driftledger.operators.scans import SCANS, Scan
from driftledger.plans import manifest, register_store
from driftledger.plans.manifest import Manifest
from driftledger.session import local_frame, pin_utc, scratch_dir, setting
from driftledger.sources import catalogs, scan_export

SEQ = StructField("load_seq", LongType())
MONTH = StructField("scan_month", StringType())
#: Readers' columns; a stored row also has its load's number.
TABLES = {
    "scan_run": schemas.SCAN_RUN,
    "raw_finding": StructType([*schemas.RAW_FINDING.fields, StructField("host", StringType()), MONTH]),
    "landed_run": StructType([StructField("scan_run_id", StringType()), StructField("whole", BooleanType())]),
    "finding": schemas.FINDING,
    "rollup": StructType([*[schemas.FINDING[c] for c in rollup.CELL], StructField("n", LongType())]),
    "host": StructType([StructField("host", StringType()), StructField("host_no", LongType())]),
    "reach": StructType([*[schemas.FINDING[c] for c in hosts.CELL], StructField("word", LongType()), StructField("bits", BinaryType())]),
    "violation": StructType([StructField("constraint", StringType()), StructField("scope", StringType()), StructField("violations", LongType())]),
    "plugin_revision": schemas.PLUGIN,
    "control": schemas.CONTROL,
    "plugin_control": schemas.PLUGIN_CONTROL,
    "control_status": schemas.CONTROL_STATUS,
}
#: Stored by month and load; the others are small.
BY_MONTH = ("raw_finding", "finding", "rollup", "reach")
#: Row groups of their files: small, so that a few files of one month are read by many tasks.
ROW_GROUP = 8 << 20
#: What a task of a load writes, as shuffled: less than Spark's own 64 MB, so that one month of a load is not left to one or two tasks.
TASK_BYTES = "16m"
FACT_ORDER = ("scanned_at", "host", "plugin_id")
#: Parts of the register that are rewritten apart: as many as make one a task's work.
BUCKETS = 16


def _months(micros: list[int]) -> list[str]:
    return sorted({f"{datetime.fromtimestamp(t // 1_000_000, timezone.utc):%Y_%m}" for t in micros})


@dataclass(frozen=True)
class LoadResult:
    """``landed``: new fact rows. ``moves``: one row per scan reconciled, with
    scanned_at, opened, reopened, closed."""

    landed: int = 0
    moves: list[Row] = field(default_factory=list)


class Snapshot:
    """The ledger as one manifest has it; lazy, and the same however often it is read."""

    def __init__(self, ledger: Ledger, published: Manifest):
        self.ledger, self.spark, self.manifest = ledger, ledger.spark, published

    def table(self, name: str) -> DataFrame:
        if name == "register_log":
            return self._register_log()
        rows = self.ledger.stored(name).filter(self.manifest.visible(name, name in BY_MONTH))
        if name == "raw_finding":
            runs = self.ledger.stored("landed_run").filter(self.manifest.visible("landed_run"))
            rows = landing.resolve(rows, runs)
        if name == "plugin_revision":
            return rows.withColumnRenamed("load_seq", "revision")
        return rows.drop("load_seq")

    def _register_log(self) -> DataFrame:
        past = manifest.log(self.spark, self.ledger.path("manifest")).filter(F.col("version") <= self.manifest.version)
        moved = past.select("version", F.timestamp_micros("synced_at").alias("synced_at"), F.inline("moves"))
        return moved.select("version", "synced_at", F.timestamp_micros("at").alias("scanned_at"), "opened", "reopened", "closed")

    def register_state(self) -> DataFrame:
        """The register with first sightings of problems never opened."""
        return register_store.read(self.spark, self.ledger.path("register"), self.manifest.buckets)

    def register(self) -> DataFrame:
        """The commitments as of the last published reconciliation."""
        return register.commitments(self.register_state())

    def register_by_source(self) -> DataFrame:
        """The commitments if each source's scans are a chain of their own, from history."""
        return register.rebuild_by_source(self.table("finding"), self.table("scan_run"), self.ledger.inventory)

    def plugin(self) -> DataFrame:
        """The catalogue: the newest revision of each check."""
        return keyed.keep_last(self.table("plugin_revision"), ["plugin_id"], [F.col("revision")]).drop("revision")

    def reports(self) -> dict[str, DataFrame]:
        """The ten standing reports by name; each is lazy."""
        finding, runs, poam = self.table("finding"), self.table("scan_run"), self.register()
        bridge, counts = self.table("plugin_control"), self.table("rollup")
        return {
            "total_fact_rows": rollup.total_fact_rows(counts),
            "by_severity": rollup.by_severity(counts, runs),
            "trend": rollup.trend(counts),
            "delta": reports.delta(finding, runs),
            "aging": reports.aging(finding, runs, first_seen=self.register_state()),
            "poam_status": reports.poam_status(poam, runs),
            "by_owner": reports.by_owner(poam, runs),
            "worst_overdue": reports.worst_overdue(poam, runs),
            "correlate": correlation.correlate(self.table("control_status"), self.table("control"), bridge, finding, runs),
            "uncovered": correlation.uncovered(finding, runs, bridge),
        }

    def control_evidence(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Findings, worst severity and distinct hosts per control over the scans from
        ``since`` to ``until`` (both included; None: no bound), from what loads kept."""
        at, month, within = F.col("scanned_at"), F.col("scan_month"), F.lit(True)
        if since is not None:
            within &= (at >= F.lit(since)) & (month >= scan_month(F.lit(since)))
        if until is not None:
            within &= (at <= F.lit(until)) & (month <= scan_month(F.lit(until)))
        return hosts.control_evidence(self.table("reach").filter(within), self.table("rollup").filter(within), self.table("plugin_control"))

    def quality(self) -> DataFrame:
        """Violations per constraint: those that :meth:`Ledger.check` keeps, those of the months
        and buckets written since, and the catalogues'."""
        kept = self.ledger.stored("violation").filter(self.manifest.visible("violation"))
        fresh = self.unchecked().withColumn("load_seq", F.lit(self.manifest.watermark + 1).cast("bigint"))
        small = {name: self.table(name) for name in ("control", "plugin_control", "control_status")}
        return quality.kept_report(kept.unionByName(fresh), {**small, "plugin": self.plugin()})

    def unchecked(self) -> DataFrame:
        """(constraint, scope, violations) of what loads wrote since the last check."""
        m, ledger = self.manifest, self.ledger
        load_seq, version = m.checked
        new = F.col("load_seq") > load_seq
        runs = self.table("scan_run")
        named = ledger.stored("landed_run").filter(m.visible("landed_run") & new).select("scan_run_id").distinct()
        times = [r.at for r in runs.join(named, "scan_run_id").select(F.unix_micros("scanned_at").alias("at")).distinct().collect()]
        low, high = (F.timestamp_micros(F.lit(t)) for t in (min(times, default=0), max(times, default=0)))
        then = ledger.in_months("finding", _months(times)).filter(m.visible("finding", True))
        newest = F.timestamp_micros(F.lit(m.synced_at))
        counts = ledger.in_months("rollup", _months([m.synced_at] if times else [])).filter(m.visible("rollup", True))
        buckets = register_store.read(self.spark, ledger.path("register"), {b: v for b, v in m.buckets.items() if v > version})
        return quality.delivery_report(
            then.filter(F.col("scanned_at").between(low, high)),
            ledger.in_months("raw_finding", _months(times)).filter(m.visible("raw_finding", True) & new),
            runs,
            buckets.withColumn("bucket", register_store.bucket_of(ledger.buckets)),
            counts.filter(F.col("scanned_at") == newest) if times else None,
        )

    def audit(self) -> DataFrame:
        """The same from all that is stored, whoever wrote it."""
        names = ("scan_run", "finding", "raw_finding", "control", "plugin_control", "control_status")
        tables = {name: self.table(name) for name in names}
        return quality.quality_report({**tables, "register": self.register_state(), "plugin": self.plugin()})


class Ledger:
    def __init__(self, spark: SparkSession, root: str, inventory: DataFrame | None = None, buckets: int = BUCKETS):
        """``buckets`` holds for a new ledger; one that exists keeps its own number."""
        self.spark = pin_utc(spark)
        self.root = root.rstrip("/")
        self.inventory = inventory
        kept = [int(name.split("=")[1]) for name in storage.folders(spark, self.path("buckets"))]
        self.buckets = kept[0] if kept else buckets
        if not kept:
            storage.make(spark, self.path(f"buckets/n={buckets}"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ---- reading ------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """The state published last."""
        return Snapshot(self, self._manifest())

    def table(self, name: str) -> DataFrame:
        return self.snapshot().table(name)

    def register(self) -> DataFrame:
        return self.snapshot().register()

    def register_state(self) -> DataFrame:
        return self.snapshot().register_state()

    def plugin(self) -> DataFrame:
        return self.snapshot().plugin()

    def control_evidence(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        return self.snapshot().control_evidence(since, until)

    def reports(self) -> dict[str, DataFrame]:
        return self.snapshot().reports()

    def quality(self) -> DataFrame:
        return self.snapshot().quality()

    def audit(self) -> DataFrame:
        return self.snapshot().audit()

    def stored(self, name: str) -> DataFrame:
        """A table as it is stored, with what no reader sees."""
        return storage.read_table(self.spark, StructType([*TABLES[name].fields, SEQ]), self.path(name))

    def _manifest(self) -> Manifest:
        return next(iter(manifest.newest(self.spark, self.path("manifest"))), Manifest())

    # ---- loads and what they publish ----------------------------------------

    def _loads(self) -> tuple[set[int], set[int]]:
        """All loads that ever began, and those that are complete."""
        noted = storage.names(self.spark, self.path("load"))
        return {int(n) for n in noted if n.isdigit()}, {int(n.split(".")[0]) for n in noted if n.endswith(".complete")}

    def _begin(self) -> int:
        """A number of its own for a load; the mark stays whatever becomes of it."""
        load_seq = max(self._loads()[0], default=0) + 1
        storage.make(self.spark, self.path("load"))
        storage.write_text(self.spark, self.path(f"load/{load_seq}"), "")
        return load_seq

    def _complete(self, load_seq: int) -> None:
        storage.write_text(self.spark, self.path(f"load/{load_seq}.complete"), "")

    def _publish(self, before: Manifest, begun: set[int], included: set[int], **changes) -> Manifest:
        after = before.next(begun, included, **changes)
        manifest.publish(self.spark, self.path("manifest"), after)
        return after

    def _append(self, name: str, rows: DataFrame, load_seq: int, order: tuple[str, ...] = ()) -> None:
        """Rows of one load; ``order`` sorts a month's rows, for the statistics of their files."""
        rows = rows.select(*TABLES[name].names).withColumn("load_seq", F.lit(load_seq).cast("bigint"))
        if order:
            rows = rows.sortWithinPartitions("scan_month", "load_seq", *order)
        writer = rows.write.mode("append").option("parquet.block.size", ROW_GROUP)
        with setting(rows.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES):
            (writer.partitionBy("scan_month", "load_seq") if name in BY_MONTH else writer).parquet(self.path(name))

    def _for_writer(self, name: str, published: Manifest, waiting: set[int]) -> DataFrame:
        """What is published and what waits to be, but nothing of a load that died."""
        counts = published.visible(name, name in BY_MONTH)
        return self.stored(name).filter(counts | F.col("load_seq").isin(sorted(waiting)) if waiting else counts)

    # ---- loading scans ------------------------------------------------------

    def load_exports(
        self, path: str | list[str], fallback: datetime | None = None, source: str = DEFAULT_SOURCE
    ) -> LoadResult:
        """Load export files: store them, then reconcile the register."""
        return LoadResult(self.store_exports(path, fallback, source), self.reconcile())

    def store_exports(self, path: str | list[str], fallback: datetime | None = None, source: str = DEFAULT_SOURCE) -> int:
        """Land export files and return how many facts are new. Their XML is parsed
        once, into a staged table. A file is a whole scan: what an earlier delivery
        landed for its run is replaced, by nothing if it has no items now."""
        hosts = scan_export.started_hosts(scan_export.export_hosts(self.spark, path))
        staged_at = scratch_dir(self.spark, "delivery")
        hosts.drop("HostProperties").write.parquet(staged_at)
        staged = self.spark.read.parquet(staged_at)
        files = scan_export.export_files(self.spark, path)
        scans = scan_export.scan_times(files, staged, fallback, source).select("file", *SCANS.names)
        # One short row per file of the delivery passes through the driver.
        rows = scans.withColumn("scanned_at", F.unix_micros("scanned_at")).collect()
        named = StructType([StructField("file", StringType()), *SCANS.fields])
        files_to_runs = local_frame(self.spark, [tuple(r) for r in rows], named).select("file", "scan_run_id")
        findings = scan_export.flatten_items(staged).join(files_to_runs, "file")
        landed = self._store(sorted({tuple(r)[1:] for r in rows}), findings, whole=True)
        storage.delete(self.spark, staged_at)
        return landed

    def load(self, runs: DataFrame, findings: DataFrame) -> LoadResult:
        """Land, type, deduplicate and reconcile a delivery of any number of scans.

        ``runs``: (scan_run_id, scanned_at, source). ``findings``: (scan_run_id,
        landing_seq, host, plugin_id, plugin_name, severity, cve).
        """
        return LoadResult(self.store(runs, findings), self.reconcile())

    def store(self, runs: DataFrame, findings: DataFrame, whole: bool = True) -> int:
        """Land and store a delivery, and leave the register for :meth:`reconcile`.

        A ``whole`` delivery replaces all that was landed for its runs before; another
        one adds to it, and replaces the rows that it has again.
        """
        listed = runs.select("scan_run_id", F.unix_micros("scanned_at"), "source").distinct()
        return self._store(sorted(tuple(r) for r in listed.collect()), findings, whole)

    def _store(self, rows: list[tuple[str, int, str]], findings: DataFrame, whole: bool) -> int:
        if not rows:
            return 0
        published, (_, complete) = self._manifest(), self._loads()
        waiting = {n for n in complete if not published.has(n)}
        runs, times = local_frame(self.spark, rows, SCANS), [micros for _, micros, _ in rows]
        load_seq = self._begin()
        self._land(findings, runs, whole, load_seq)
        landed = self._store_facts(runs, times, published, waiting, load_seq)
        if landed:
            self._roll_up(_months(times), published, waiting, load_seq)
        known = self._for_writer("scan_run", published, waiting)
        fresh = keyed.insert_if_absent(runs, known, ["scan_run_id"]).withColumn("ingested_at", F.current_timestamp())
        self._append("scan_run", fresh.hint("rebalance"), load_seq)
        self._complete(load_seq)
        return landed

    def _land(self, findings: DataFrame, runs: DataFrame, whole: bool, load_seq: int) -> None:
        months = runs.select("scan_run_id", scan_month(F.col("scanned_at")).alias("scan_month"))
        rows = findings.select("scan_run_id", "landing_seq", "host", to_payload().alias("payload")).join(months, "scan_run_id")
        rows = rows.withColumn("ingested_at", F.current_timestamp())
        self._append("raw_finding", rows.hint("rebalance", "scan_month"), load_seq)
        self._append("landed_run", runs.withColumn("whole", F.lit(whole)).hint("rebalance"), load_seq)

    def in_months(self, name: str, months: list[str]) -> DataFrame:
        """Stored rows of some months. Only these are opened, so the files of the rest of
        history are not even listed."""
        schema = StructType([*TABLES[name].fields, SEQ])
        places = [place for month in months if storage.exists(self.spark, place := self.path(f"{name}/scan_month={month}"))]
        if not places:
            return local_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*places)

    def _store_facts(self, runs: DataFrame, times: list[int], published: Manifest, waiting: set[int], load_seq: int) -> int:
        months = _months(times)
        landed = self.in_months("raw_finding", months).filter(F.col("load_seq") == load_seq)
        arriving = facts.project_facts(landed, runs)
        counts = published.visible("finding", True)
        known = self.in_months("finding", months).filter(counts | F.col("load_seq").isin(sorted(waiting)) if waiting else counts)
        low, high = (F.timestamp_micros(F.lit(t)) for t in (min(times), max(times)))
        known = known.filter(F.col("scanned_at").between(low, high))
        counted = Observation("landed")
        fresh = facts.new_facts(arriving, known).withColumn("scan_month", scan_month(F.col("scanned_at")))
        # A backfill would scatter every month over every task's output. The
        # rebalance is by size, so one month's bulk is still split.
        fresh = fresh.hint("rebalance", "scan_month").observe(counted, F.count(F.lit(1)).alias("n"))
        self._append("finding", fresh, load_seq, FACT_ORDER)
        return counted.get["n"]

    def _roll_up(self, months: list[str], published: Manifest, waiting: set[int], load_seq: int) -> None:
        new = self.in_months("finding", months).filter(F.col("load_seq") == load_seq)
        self._append("rollup", rollup.roll_up(new).hint("rebalance"), load_seq)
        unknown = hosts.unknown(new, self._for_writer("host", published, waiting))
        self._append("host", hosts.numbered(unknown, load_seq), load_seq)
        numbers = self._for_writer("host", published, waiting | {load_seq})
        self._append("reach", hosts.reach(new, numbers).hint("rebalance", "scan_month"), load_seq)

    def reconcile(self) -> list[Row]:
        """Bring the register up to every stored delivery, in scan-time order, and publish."""
        published, (begun, complete) = self._manifest(), self._loads()
        waiting = {n for n in complete if not published.has(n)}
        if not waiting:
            return []
        runs = self._due(published, waiting)
        months = _months([r.at for r in runs if r.delivered])
        arrived = self.in_months("finding", months).filter(F.col("load_seq").isin(sorted(waiting)))
        steps, chain = self._steps(runs, published.synced_at)
        buckets, moves = self._advance(published, arrived, steps, chain)
        moved = tuple((r.at, r.opened, r.reopened, r.closed) for r in moves)
        newest = chain[-1] if chain else published.synced_at
        self._publish(published, begun, waiting, synced_at=newest, buckets=published.buckets | buckets, moves=moved)
        return moves

    def _due(self, published: Manifest, waiting: set[int]) -> list[Row]:
        """Runs that were delivered, or that the register has not gone past: one short row each."""
        named = self.stored("landed_run").filter(F.col("load_seq").isin(sorted(waiting)))
        named = named.select("scan_run_id", F.lit(True).alias("_named")).distinct()
        runs = self._for_writer("scan_run", published, waiting).join(named, "scan_run_id", "left")
        runs = runs.select("scan_run_id", F.unix_micros("scanned_at").alias("at"), F.coalesce("_named", F.lit(False)).alias("delivered"))
        later = F.lit(True) if published.synced_at is None else F.col("at") >= published.synced_at
        return runs.filter(F.col("delivered") | later).collect()

    def _steps(self, runs: list[Row], synced_at: int | None) -> tuple[DataFrame, list[int]]:
        """The scan times to go through: step 0 is where the register stands, if anywhere."""
        least: dict[int, str] = {}
        for r in runs:
            if synced_at is None or r.at >= synced_at:
                least[r.at] = min(r.scan_run_id, least.get(r.at, r.scan_run_id))
        chain, first = sorted(least), 1 if synced_at is None else 0
        return local_frame(self.spark, [(least[at], at, i) for i, at in enumerate(chain, first)], register.STEPS), chain

    def _advance(self, published: Manifest, arrived: DataFrame, steps: DataFrame, chain: list[int]) -> tuple[dict[int, int], list[Row]]:
        """Write the buckets in which something changes; what became of them, and the moves."""
        folder, bucket = self.path("register"), register_store.bucket_of(self.buckets)
        current = published.buckets
        if published.synced_at is not None and not any(at > published.synced_at for at in chain):
            # Nothing can close: only the keys that arrived may change.
            asked = {r.bucket for r in arrived.select(bucket.alias("bucket")).distinct().collect()}
            current = {b: v for b, v in current.items() if b in asked}
        stored = register_store.read(self.spark, folder, current)
        advanced = register.advance(stored, arrived, steps, self.inventory, n_steps=len(chain) + 1)
        staged_at = scratch_dir(self.spark, "register-changes")
        advanced.filter("changed").withColumn("bucket", bucket).write.parquet(staged_at)
        changed = self.spark.read.parquet(staged_at)
        touched = sorted(r.bucket for r in changed.select("bucket").distinct().collect())  # one row per bucket at most
        version = published.version + 1
        if touched:
            old = register_store.read(self.spark, folder, {b: v for b, v in published.buckets.items() if b in touched})
            register_store.write(register_store.rewritten(old, changed), folder, version, self.buckets)
        moves = register.count_moves(changed, steps).withColumn("at", F.unix_micros("scanned_at")).orderBy("step").collect()
        storage.delete(self.spark, staged_at)
        return {b: version for b in touched}, [r for r in moves if r.step > 0 or r.opened or r.reopened or r.closed]

    # ---- the second source --------------------------------------------------

    def _publish_rows(self, name: str, rows: DataFrame) -> None:
        """Append to a small table and publish it; deliveries that wait go on waiting."""
        published, load_seq = self._manifest(), self._begin()
        self._append(name, rows.hint("rebalance"), load_seq)
        self._publish(published, self._loads()[0], {load_seq})

    def seed_catalogs(self) -> int:
        """Install the built-in catalogues; returns how many checks are known."""
        self.upsert_plugins(catalogs.plugin_catalog(self.spark))
        self.insert("control", catalogs.control_catalog(self.spark), ["control_id"])
        self.insert("plugin_control", catalogs.evidence_map(self.spark), ["plugin_id", "control_id"])
        return self.plugin().count()

    def upsert_plugins(self, incoming: DataFrame) -> None:
        """Later wording and rating win. Unchanged rows add no revision."""
        self._publish_rows("plugin_revision", incoming.select(*schemas.PLUGIN.names).exceptAll(self.plugin()))

    def insert(self, name: str, incoming: DataFrame, keys: list[str]) -> None:
        """Rows of a catalogue or map whose keys it does not have yet."""
        self._publish_rows(name, keyed.insert_if_absent(incoming, self.table(name), keys))

    def record_assessment(self, export_id: str) -> int:
        """Assess as of the first scan. An export is frozen: recording it again
        adds nothing, and what is returned is how many statuses it contains."""
        now = self.snapshot()
        assessed = correlation.assess_controls(
            now.table("control"), now.table("plugin_control"), now.table("finding"), now.table("scan_run"), export_id
        )
        self.insert("control_status", assessed, ["export_id", "control_id"])
        return self.table("control_status").filter(F.col("export_id") == export_id).count()

    # ---- keeping house ------------------------------------------------------

    def check(self) -> DataFrame:
        """Check what loads wrote since the last check, and keep what was found per month and
        bucket, so that the next one opens only what was written after it."""
        now, load_seq = self.snapshot(), self._begin()
        self._append("violation", now.unchecked().coalesce(1), load_seq)
        done = (now.manifest.watermark, now.manifest.version)
        self._publish(now.manifest, self._loads()[0], {load_seq}, checked=done)
        return self.quality()

    def compact(self, name: str, months: list[str] | None = None) -> list[str]:
        """Rewrite months of ``finding``, ``rollup``, ``reach`` or ``raw_finding`` as one load each.

        Landing rows that a newer delivery replaced are left out, counts of one cell are
        added up or united; no report changes. What waits is reconciled first. Returns the months.
        """
        self.reconcile()
        now = self.snapshot()
        months = months or [n.split("=")[1] for n in storage.folders(self.spark, self.path(name))]
        if not months:
            return []
        published, load_seq = now.manifest, self._begin()
        rows = now.table(name).filter(F.col("scan_month").isin(months))
        rows = {"rollup": rollup.merged, "reach": hosts.merged}.get(name, lambda kept: kept)(rows)
        order = {"finding": FACT_ORDER, "raw_finding": ("scan_run_id", "host", "landing_seq")}.get(name, ("scanned_at",))
        self._append(name, rows.hint("rebalance", "scan_month"), load_seq, order)
        floors = published.floors | {f"{name}/{month}": load_seq for month in months}
        self._publish(published, self._loads()[0], {load_seq}, floors=floors)
        return months

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders that none of the last ``keep`` manifests reads: register
        buckets that were rewritten, months that were compacted, loads that died. Returns
        how many. Snapshots older than these manifests can no longer be read."""
        kept = manifest.newest(self.spark, self.path("manifest"), keep)
        if not kept:
            return 0
        named = {pair for m in kept for pair in m.buckets.items()}
        gone = register_store.forget(self.spark, self.path("register"), named, kept[0].version)
        _, complete = self._loads()
        dead = {n for n in kept[0].hidden if n not in complete}
        for name in BY_MONTH:
            for month in storage.folders(self.spark, self.path(name)):
                floor = min(m.floors.get(f"{name}/{month.split('=')[1]}", 0) for m in kept)
                for load in storage.folders(self.spark, self.path(f"{name}/{month}")):
                    n = int(load.split("=")[1])
                    if n in dead or n < floor:
                        storage.delete(self.spark, self.path(f"{name}/{month}/{load}"))
                        gone += 1
        return gone
