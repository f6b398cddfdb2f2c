"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from driftledger import storage
from driftledger.functions import policy
from driftledger.functions.identity import DEFAULT_SOURCE
from driftledger.functions.payload import project_payload, to_payload
from driftledger.operators import correlation, facts, keyed, quality, register, reports, scans
from driftledger.plans import relations as rel
from driftledger.schemas import EXPORT_HOST, PLUGIN_CONTROL
from driftledger.plans.ledger import Ledger
from driftledger.session import local_frame, pin_utc, scratch_dir
from driftledger.sources import scan_export
from driftledger.streaming.reconcile import watch_sightings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _dated(df: DataFrame, column: str = "scanned_at", name: str = "d") -> DataFrame:
    """Scan times of both relations are midnights; reports show them as dates."""
    return df.withColumn(name, F.to_date(column)).drop(column)


# ---- sources and landing ----------------------------------------------------


def _export_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the XML of one scanned host, parsed back with the reader's
    schema. A day and event type is a file; views are nameless hosts, clicks
    carry only the text time, signups none, and purchases a broken check id."""
    e = rel.table(spark, sf_dir, "events")
    e = e.hint("repartition", spark.sparkContext.defaultParallelism)  # parsing is the work, and a small table is one split
    kind = F.col("event_type")
    code = policy.lookup(kind, {k: v[0] for k, v in rel.EVENT_CHECKS.items()}, -1)
    k = F.get_json_object("props", "$.k").cast("int")
    name = F.when(kind == "view", F.lit(' name=" "')).otherwise(F.concat(F.lit(' name="'), "user_id", F.lit('"')))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    epoch = F.concat(F.lit('<tag name="HOST_START_TIMESTAMP">'), seconds, F.lit("</tag>"))
    text = F.concat(F.lit('<tag name="HOST_START">'), F.date_format("ts", "MMM d HH:mm:ss yyyy"), F.lit("</tag>"))
    tag = F.when(kind == "click", text).when(kind != "signup", epoch).otherwise("")
    bad = (kind == "purchase") & (k % 2 == 0)
    shown_code = F.when(bad, F.concat(code, F.lit(".5"))).otherwise(F.concat(F.lit(" "), code))
    cve = F.when(k > 50, F.concat(F.lit("<cve>CVE-A-"), k, F.lit("</cve><cve>CVE-B-"), k, F.lit("</cve>"))).otherwise("")
    xml = F.concat(
        F.lit("<ReportHost"), name, F.lit("><HostProperties>"), tag, F.lit("</HostProperties>"),
        F.lit('<ReportItem port="1" pluginID="'), shown_code, F.lit('" severity="'), k % 5, F.lit('"'),
        F.when(k % 3 == 0, F.concat(F.lit(' pluginName="'), kind, F.lit('"'))).otherwise(""), F.lit(">"), cve,
        F.lit("</ReportItem></ReportHost>"),
    )
    host = F.from_xml(xml, F.lit(EXPORT_HOST.simpleString()), {"rowTag": "ReportHost", "mode": "FAILFAST"})
    file = F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), kind)
    # Generated, so that each text is parsed once however often its parts are used.
    return e.select(file.alias("file"), F.inline(F.array(host)))


@_query
def export_flatten(spark, sf_dir):
    hosts = scan_export.started_hosts(_export_hosts(spark, sf_dir))
    return scan_export.flatten_items(hosts).groupBy(
        "file", "host", "landing_seq", "plugin_id", "plugin_name", "severity", "cve"
    ).agg(F.count("*").alias("n"))


@_query
def scan_time_min(spark, sf_dir):
    hosts = _export_hosts(spark, sf_dir)
    fallback = datetime(2000, 1, 1, tzinfo=timezone.utc)
    times = scan_export.scan_times(
        hosts.select("file").distinct(), scan_export.started_hosts(hosts), fallback, DEFAULT_SOURCE
    )
    return times.select("file", F.date_format("scanned_at", "yyyy-MM-dd HH:mm:ss").alias("scanned_at"))


@_query
def tolerant_cast(spark, sf_dir):
    li = rel.table(spark, sf_dir, "lineitem")
    key, line, flag = F.col("l_partkey").cast("string"), F.col("l_linenumber"), F.col("l_returnflag")
    plugin_id = (
        F.when(line == 1, key)
        .when(line == 2, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(line == 3, F.concat(F.lit("+"), key))
        .when(line == 4, F.concat(key, F.lit(".5")))
        .when(line == 5, F.lit("BROKEN"))
        .when(line == 6, F.concat(F.lit("-"), key))
    )
    severity = F.when(flag == "A", (line % 5).cast("string")).when(flag == "N", F.lit(" 3 ")).otherwise("70000")
    name = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("part "), key))
    hosts = li.select(
        F.lit("lineitem").alias("file"),
        F.when(F.col("l_tax") > 0.01, F.col("l_suppkey").cast("string")).otherwise(" ").alias("_name"),
        F.array().cast(EXPORT_HOST["HostProperties"].dataType).alias("HostProperties"),
        F.array(
            F.struct(
                plugin_id.alias("_pluginID"), severity.alias("_severity"), name.alias("_pluginName"),
                F.array().cast("array<string>").alias("cve"),
            )
        ).alias("ReportItem"),
    )
    kept = scan_export.flatten_items(scan_export.started_hosts(hosts))
    return kept.groupBy("host", "severity").agg(
        F.count("*").alias("n"),
        F.sum("plugin_id").cast("bigint").alias("plugin_ids"),
        F.count_if(F.col("plugin_name") == "").alias("unnamed"),
        F.count("cve").alias("cves"),
    )


@_query
def canonical_sort(spark, sf_dir):
    finding = _dated(rel.finding_a(spark, sf_dir).select("scanned_at", "host", "plugin_id", "severity"))
    return scan_export.canonical_order(finding)


@_query
def run_id(spark, sf_dir):
    return _dated(rel.scan_run_a(spark, sf_dir)).select("d", "source", "scan_run_id")


@_query
def json_roundtrip(spark, sf_dir):
    landed = rel.sightings_a(rel.table(spark, sf_dir, "events")).select(
        "landing_seq", to_payload("host", "plugin_id", "plugin_name", "severity", "cve").alias("payload")
    )
    has_null_cve = F.get_json_object("payload", "$.cve").isNull() & F.col("payload").contains('"cve":null')
    typed = project_payload(landed.withColumn("null_cve_kept", has_null_cve))
    return typed.select("landing_seq", "host", "plugin_id", "plugin_name", "severity", "cve", "null_cve_kept")


@_query
def json_project(spark, sf_dir):
    projected = facts.project_facts(rel.raw_a(spark, sf_dir), rel.scan_run_a(spark, sf_dir))
    return projected.groupBy(F.to_date("scanned_at").alias("d"), "plugin_id", "plugin_name", "severity").agg(
        F.count("*").alias("n"), F.count("cve").alias("cves"), F.count_distinct("host").alias("hosts"), F.max("cve").alias("max_cve")
    )


@_query
def dedup_fact(spark, sf_dir):
    return _dated(rel.finding_a(spark, sf_dir).select("scanned_at", "host", "plugin_id", "plugin_name", "severity", "cve"))


@_query
def replay_landed(spark, sf_dir):
    """Load everything, then deliver the newest scan again: what lands each time."""
    arriving = rel.with_run(rel.sightings_a(rel.table(spark, sf_dir, "events")))
    stored = rel.finding_a(spark, sf_dir)
    nothing = stored.limit(0)
    again = scans.latest_findings(arriving, rel.scan_run_a(spark, sf_dir))
    before = reports.total_fact_rows(stored).select(F.lit("before").alias("step"), "n")
    first = facts.new_facts(arriving, nothing).agg(F.count("*").alias("n")).select(F.lit("landed").alias("step"), "n")
    replay = facts.new_facts(again, stored).agg(F.count("*").alias("n")).select(F.lit("re-landed").alias("step"), "n")
    return before.unionAll(first).unionAll(replay)


@_query
def insert_if_absent(spark, sf_dir):
    """Order months are registered scans; ship months arrive, and the new ones stay."""
    months = rel.table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").alias("d")).distinct()
    shipped = rel.scan_run_b(spark, sf_dir).select(F.to_date("scanned_at").alias("d"))
    new = keyed.insert_if_absent(rel.runs_on(shipped), rel.runs_on(months), ["scan_run_id"])
    return _dated(new).select("d", "source", "scan_run_id")


@_query
def catalog_upsert(spark, sf_dir):
    """The part catalogue revised by what was shipped: half the ids are new."""
    stored = rel.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("plugin_id"), F.col("p_name").alias("name"), (F.col("p_size") % 5).cast("smallint").alias("severity")
    )
    shipped = rel.table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") * 2).alias("plugin_id")).agg(
        F.concat(F.lit("shipped "), F.count("*")).alias("name"),
        (F.max("l_linenumber") % 5).cast("smallint").alias("severity"),
    )
    return keyed.upsert(stored, shipped, ["plugin_id"])


@_query
def export_append(spark, sf_dir):
    """Assess, then assess again under the same export id: the export is frozen,
    so nothing is added and its row count is what it contains."""
    stored = _assessment_b(spark, *_ends_b(spark, sf_dir))
    again = stored.withColumn("compliance", F.lit(policy.COMPLIANT))
    added = keyed.insert_if_absent(again, stored, ["export_id", "control_id"])
    return stored.unionByName(added).groupBy("export_id").agg(
        F.count("*").alias("contained"), F.count_if(F.col("compliance") == policy.NON_COMPLIANT).alias("failed")
    )


@_query
def check_unique(spark, sf_dir):
    raw = rel.sightings_a(rel.table(spark, sf_dir, "events"))
    return _dated(quality.check_unique(raw, facts.FACT_KEY))


@_query
def check_fk(spark, sf_dir):
    """Checks reported by scans that the evidence map does not know."""
    return quality.check_fk(rel.finding_b(spark, sf_dir), rel.evidence_b(spark).select("plugin_id").distinct(), "plugin_id")


@_query
def check_domain(spark, sf_dir):
    return quality.check_domain(rel.table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"])


# ---- facts and scans --------------------------------------------------------


def _a(spark, sf_dir):
    return rel.finding_a(spark, sf_dir), rel.scan_run_a(spark, sf_dir)


def _b(spark, sf_dir):
    return rel.finding_b(spark, sf_dir), rel.scan_run_b(spark, sf_dir)


@_query
def total_fact_rows(spark, sf_dir):
    return reports.total_fact_rows(rel.finding_a(spark, sf_dir))


@_query
def by_severity(spark, sf_dir):
    return reports.by_severity(*_a(spark, sf_dir))


@_query
def severity_all_scans(spark, sf_dir):
    return reports.severity_histogram(rel.finding_a(spark, sf_dir))


@_query
def severity_label(spark, sf_dir):
    labelled = rel.finding_a(spark, sf_dir).select(policy.severity_label(F.col("severity")).alias("label"))
    return labelled.groupBy("label").agg(F.count("*").alias("n"))


@_query
def by_month(spark, sf_dir):
    return reports.by_month(rel.finding_b(spark, sf_dir))


@_query
def high_crit(spark, sf_dir):
    per_scan = rel.finding_a(spark, sf_dir).groupBy("scanned_at").agg(
        F.count_if(policy.is_serious(F.col("severity"))).alias("high_crit"), F.count("*").alias("n")
    )
    return _dated(per_scan)


@_query
def trend(spark, sf_dir):
    return _dated(reports.trend(rel.finding_a(spark, sf_dir)))


@_query
def delta(spark, sf_dir):
    return reports.delta(*_a(spark, sf_dir))


@_query
def aging(spark, sf_dir):
    return reports.aging(*_a(spark, sf_dir))


@_query
def aging_from_register(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.aging(finding, runs, first_seen=register.rebuild(finding, runs))


@_query
def latest_run(spark, sf_dir):
    runs = rel.scan_run_b(spark, sf_dir)
    newest = scans.latest_run(runs).withColumn("which", F.lit("newest"))
    return _dated(newest.unionByName(scans.earliest_run(runs).withColumn("which", F.lit("earliest"))))


@_query
def first_seen(spark, sf_dir):
    seen = register.first_seen(rel.finding_a(spark, sf_dir))
    return seen.select("host", "plugin_id", F.to_date("first_seen").alias("opened_on"))


@_query
def trace_key(spark, sf_dir):
    """The critical check on the host that sorts first among those reporting it."""
    finding = rel.finding_a(spark, sf_dir)
    critical = rel.EVENT_CHECKS["error"][0]
    events = rel.table(spark, sf_dir, "events")
    host = events.filter("event_type = 'error'").agg(F.min(F.col("user_id").cast("string")).alias("v")).scalar()
    return _dated(reports.trace(finding, host, critical))


# ---- the register -----------------------------------------------------------


@_query
def register_current(spark, sf_dir):
    return register.rebuild(*_a(spark, sf_dir)).drop("first_seen")


@_query
def register_transitions(spark, sf_dir):
    return _dated(register.transitions(*_a(spark, sf_dir)))


@_query
def register_counts(spark, sf_dir):
    return reports.register_counts(register.rebuild(*_a(spark, sf_dir)))


def _two_sources(spark, sf_dir):
    """Relation A with scans of even days made by one source and of odd days by another."""
    finding, runs = _a(spark, sf_dir)
    source = F.when(F.dayofmonth("scanned_at") % 2 == 0, "even").otherwise("odd")
    return finding, runs.withColumn("source", source)


@_query
def register_by_source(spark, sf_dir):
    return register.rebuild_by_source(*_two_sources(spark, sf_dir)).drop("first_seen")


@_query
def transitions_by_source(spark, sf_dir):
    return _dated(register.transitions_by_source(*_two_sources(spark, sf_dir)))


@_query
def sla_due(spark, sf_dir):
    register_b = register.rebuild(*_b(spark, sf_dir))
    return register_b.select("host", "plugin_id", "severity", "opened_on", "due_on", "rom_hours")


@_query
def owner_bucket(spark, sf_dir):
    """Owners from an inventory that lists half the hosts, the rest by hash."""
    hosts = rel.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("host")).distinct()
    customer = rel.table(spark, sf_dir, "customer")
    inventory = customer.filter(F.col("c_acctbal") > 5000).select(
        F.col("c_custkey").cast("string").alias("host"), F.col("c_mktsegment").alias("owner")
    )
    owned = policy.assign_owner(hosts, inventory)
    return owned.select("host", policy.owner_bucket(F.col("host")).alias("bucket"), "owner")


@_query
def poam_status(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.poam_status(register.rebuild(finding, runs), runs)


@_query
def by_owner(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.by_owner(register.rebuild(finding, runs), runs)


@_query
def worst_overdue(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.worst_overdue(register.rebuild(finding, runs), runs)


@_query
def overdue_critical(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.overdue_at(register.rebuild(finding, runs), runs, severity=4)


@_query
def backlog_total(spark, sf_dir):
    finding, runs = _b(spark, sf_dir)
    return reports.backlog_total(register.rebuild(finding, runs), runs)


# ---- assessment and correlation ---------------------------------------------


def _ends_b(spark, sf_dir):
    """Relation B for what looks at its newest and earliest scans only."""
    runs = rel.scan_run_b(spark, sf_dir)
    ends = [s for s in (scans.newest_scan(runs), scans.earliest_scan(runs)) if s]
    return rel.finding_b(spark, sf_dir, ends), runs


def _assessment_b(spark, finding, runs):
    return correlation.assess_controls(rel.controls_b(spark), rel.evidence_b(spark), finding, runs, rel.EXPORT_ID_B)


def _statuses_b(spark, finding, runs):
    """Two exports: the assessment, and an older one that passed everything."""
    current = _assessment_b(spark, finding, runs)
    older = current.withColumn("export_id", F.lit("00000000-0000-4000-8000-000000000000")).withColumn(
        "exported_at", F.col("exported_at") - F.expr("INTERVAL 30 DAYS")
    ).withColumn("compliance", F.lit(policy.COMPLIANT))
    return current.unionByName(older)


@_query
def assess_controls(spark, sf_dir):
    return _dated(_assessment_b(spark, *_ends_b(spark, sf_dir)), "exported_at", "exported_on")


@_query
def latest_export(spark, sf_dir):
    return _dated(correlation.latest_export(_statuses_b(spark, *_ends_b(spark, sf_dir))), "exported_at", "exported_on")


@_query
def coverage(spark, sf_dir):
    """Which suppliers' parts are evidence for which order priority."""
    li = rel.table(spark, sf_dir, "lineitem")
    orders = rel.table(spark, sf_dir, "orders")
    bridge = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderpriority").alias("control_id"), F.col("l_suppkey").alias("plugin_id")
    ).distinct()
    return correlation.coverage(bridge)


@_query
def control_evidence(spark, sf_dir):
    finding, runs = _ends_b(spark, sf_dir)
    return correlation.control_evidence(scans.latest_findings(finding, runs), rel.evidence_b(spark))


def _correlated(spark, sf_dir):
    finding, runs = _ends_b(spark, sf_dir)
    return correlation.correlate(_statuses_b(spark, finding, runs), rel.controls_b(spark), rel.evidence_b(spark), finding, runs)


@_query
def correlate(spark, sf_dir):
    return _correlated(spark, sf_dir)


@_query
def verdict_flag(spark, sf_dir):
    return correlation.flag_verdicts(_correlated(spark, sf_dir)).select("control_id", "verdict", "flag")


@_query
def uncovered(spark, sf_dir):
    finding, runs = _ends_b(spark, sf_dir)
    return correlation.uncovered(finding, runs, rel.evidence_b(spark))


@_query
def control_drilldown(spark, sf_dir):
    finding, runs = _ends_b(spark, sf_dir)
    return correlation.control_drilldown(finding, runs, rel.evidence_b(spark), "C2")


@_query
def evidence_sources(spark, sf_dir):
    assessed = _assessment_b(spark, *_ends_b(spark, sf_dir))
    return correlation.evidence_sources(rel.controls_b(spark), assessed, rel.evidence_b(spark))


# ---- the load job -----------------------------------------------------------


def _delivery(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    return scans.named(rel.sightings_a(events).withColumn("source", F.lit(DEFAULT_SOURCE)))


def _before(day: str):
    return F.to_date("ts") < F.lit(day).cast("date")


def _export_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The events as export files, one a day, each event a host element with one item."""
    day = F.date_format("ts", "yyyy-MM-dd")
    seen = rel.sightings_a(rel.table(spark, sf_dir, "events")).withColumnRenamed("scanned_at", "ts")
    cve = F.when(F.col("cve").isNotNull(), F.concat(F.lit("<cve>"), "cve", F.lit("</cve>"))).otherwise("")
    host = F.concat(
        F.lit('<ReportHost name="'), "host", F.lit('"><HostProperties><tag name="HOST_START_TIMESTAMP">'), F.unix_seconds("ts"),
        F.lit('</tag></HostProperties><ReportItem pluginID="'), "plugin_id", F.lit('" severity="'), "severity",
        F.lit('" pluginName="'), "plugin_name", F.lit('">'), cve, F.lit("</ReportItem></ReportHost>"),
    )
    days = seen.select(day.alias("day")).distinct()
    start, end = '<?xml version="1.0"?><Data><Report name="day">', "</Report></Data>"
    lines = seen.select(day.alias("day"), F.lit(1).alias("part"), host.alias("value"))
    for part, text in ((0, start), (2, end)):
        lines = lines.unionByName(days.select("day", F.lit(part).alias("part"), F.lit(text).alias("value")))
    folder = scratch_dir(spark, "exports")
    # A file is written by one task, as one scanner would; the days are dealt out.
    lines.repartition("day").sortWithinPartitions("day", "part").select("value", "day").write.partitionBy("day").text(folder)
    return [path for name in storage.folders(spark, folder) for path, _ in storage.files(spark, f"{folder}/{name}")]


@_query
def load_exports_register(spark, sf_dir):
    """Files through the whole load job: what landed, what is stored, and the register."""
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    ledger.load_exports(_export_files(spark, sf_dir))
    landed, stored = (ledger.table(t).agg(F.count("*").alias("n")).scalar() for t in ("raw_finding", "finding"))
    return ledger.register().drop("first_seen").withColumns({"rows_landed": landed, "facts_stored": stored})


@_query
def load_trend(spark, sf_dir):
    """Two overlapping deliveries; the trend of the counts that the loads kept."""
    ledger, events = Ledger(spark, scratch_dir(spark, "ledger")), rel.table(spark, sf_dir, "events")
    for lot in (events.filter(_before("2024-01-16")), events.filter(~_before("2024-01-11"))):
        ledger.load(*_delivery(lot))
    return _dated(ledger.reports()["trend"])


@_query
def load_cells(spark, sf_dir):
    """The counts themselves after a late delivery, one month compacted."""
    ledger, events = Ledger(spark, scratch_dir(spark, "ledger")), rel.table(spark, sf_dir, "events")
    for lot in (events.filter(~_before("2024-01-11")), events.filter(_before("2024-01-13"))):
        ledger.load(*_delivery(lot))
    ledger.compact("rollup")
    return _dated(ledger.table("rollup")).select("d", "severity", "plugin_id", "n")


@_query
def load_evidence(spark, sf_dir):
    """Hosts per control as the loads' bitmaps have them: of all scans, and of some days, after
    a late delivery that overlaps the first."""
    ledger, events = Ledger(spark, scratch_dir(spark, "ledger")), rel.table(spark, sf_dir, "events")
    ledger.insert("plugin_control", local_frame(spark, rel.EVIDENCE_A, PLUGIN_CONTROL), ["plugin_id", "control_id"])
    for lot in (events.filter(~_before("2024-01-11")), events.filter(_before("2024-01-13"))):
        ledger.load(*_delivery(lot))
    ledger.compact("reach")
    some = ledger.control_evidence(datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 12, tzinfo=timezone.utc))
    return ledger.control_evidence().withColumn("scans", F.lit("all")).unionByName(some.withColumn("scans", F.lit("some")))


@_query
def load_published(spark, sf_dir):
    """What readers see while a delivery is stored but not reconciled, and after it is."""
    ledger, events = Ledger(spark, scratch_dir(spark, "ledger")), rel.table(spark, sf_dir, "events")
    first, rest = events.filter(_before("2024-01-16")), events.filter(~_before("2024-01-16"))
    ledger.load(*_delivery(first))
    ledger.store(*_delivery(rest))
    waiting = ledger.snapshot()
    ledger.reconcile()

    def seen(step, at):
        facts = at.reports()["total_fact_rows"].scalar()
        runs = at.table("scan_run").agg(F.count("*").alias("n")).scalar()
        serious = at.table("finding").agg(F.count_if(F.col("severity") >= 3).alias("n")).scalar()
        return reports.register_counts(at.register()).withColumns({"step": F.lit(step), "facts": facts, "scans": runs, "serious": serious})

    return seen("stored", waiting).unionByName(seen("published", ledger.snapshot()))


# ---- streaming --------------------------------------------------------------


def _stream(spark: SparkSession, deliveries: list[DataFrame]):
    """Write each delivery of events to a feed folder and drain the stream after
    it, as a scheduled job would; returns the ledger and what each load did."""
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    feed, checkpoint = scratch_dir(spark, "feed"), scratch_dir(spark, "offsets")
    results = []
    for delivery in deliveries:
        delivery.write.mode("append").parquet(feed)
        arriving = rel.sightings_a(spark.readStream.schema(delivery.schema).parquet(feed))
        sightings = arriving.withColumn("source", F.lit(DEFAULT_SOURCE))
        watch_sightings(ledger, sightings, checkpoint, results.append).awaitTermination()
    return ledger, results


@_query
def stream_register(spark, sf_dir):
    """Scans delivered in three lots, oldest first."""
    events = rel.table(spark, sf_dir, "events")
    lot = F.when(F.col("ts") < "2024-01-11", 1).when(F.col("ts") < "2024-01-21", 2).otherwise(3)
    ledger, _ = _stream(spark, [events.filter(lot == i) for i in (1, 2, 3)])
    return ledger.register().drop("first_seen")


@_query
def stream_split(spark, sf_dir):
    """Scans cut over micro-batches, every third row delivered twice: counts of what landed,
    what is stored and what the register holds."""
    events = rel.table(spark, sf_dir, "events")
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    feed, checkpoint = scratch_dir(spark, "feed"), scratch_dir(spark, "offsets")
    for lot in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1"), events.filter("event_id % 3 = 0")):
        lot.write.mode("append").parquet(feed)
    files = sum(path.endswith(".parquet") for path, _ in storage.files(spark, feed))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, files // 2)).parquet(feed)
    watch_sightings(ledger, rel.sightings_a(stream).withColumn("source", F.lit(DEFAULT_SOURCE)), checkpoint).awaitTermination()
    landed, stored = (ledger.table(t).agg(F.count("*").alias("n")).scalar() for t in ("raw_finding", "finding"))
    return reports.register_counts(ledger.register()).withColumns({"rows_landed": landed, "facts_stored": stored})


@_query
def stream_late(spark, sf_dir):
    """One mid-month scan arrives after all others: its facts are kept, the
    register does not move."""
    events = rel.table(spark, sf_dir, "events")
    late = F.to_date("ts") == F.lit("2024-01-15").cast("date")
    ledger, _ = _stream(spark, [events.filter(~late), events.filter(late)])
    stored = ledger.table("finding").agg(F.count("*").alias("n")).scalar()
    return ledger.register().select("host", "plugin_id", "opened_on", "closed_on", stored.alias("facts_stored"))


@_query
def stream_replay(spark, sf_dir):
    """Everything delivered twice: the second time nothing lands or moves."""
    events = rel.table(spark, sf_dir, "events")
    _, results = _stream(spark, [events, events])
    rows = [(i, r.landed, sum(m.opened + m.reopened + m.closed for m in r.moves)) for i, r in enumerate(results, 1)]
    schema = StructType([StructField(c, LongType()) for c in ("delivery", "landed", "moved")])
    return local_frame(spark, rows, schema)
