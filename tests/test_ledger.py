import os
import re
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_scan_export import host, item, write

from driftledger.operators import correlation, hosts
from driftledger.plans.ledger import Ledger
from driftledger.streaming.reconcile import watch_exports, watch_sightings

WEEKLY = os.environ.get("WEEKLY_SCANS_DIR")  # six weekly exports of one estate
DAY = 86400
T0 = int(datetime(2026, 1, 5, 9, tzinfo=timezone.utc).timestamp())


def scan(folder, name, day, *findings):
    """An export file of (host, plugin, severity) taken ``day`` days after T0."""
    hosts = [host("clock", "", T0 + day * DAY)]
    hosts += [host(h, item(p, s, f"check {p}")) for h, p, s in findings]
    return write(folder / f"{name}.nessus", *hosts)


def state(ledger):
    return {
        (r.host, r.plugin_id): (str(r.opened_on), str(r.closed_on) if r.closed_on else None)
        for r in ledger.register().collect()
    }


def moves(result):
    return [(m.opened, m.reopened, m.closed) for m in result.moves]


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"))


@pytest.fixture
def inbox(tmp_path):
    (tmp_path / "inbox").mkdir()
    return tmp_path / "inbox"


def test_load_close_reopen_and_replay(ledger, inbox):
    first = ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4), ("h1", 2, 2), ("h1", 1, 4)))
    assert (first.landed, moves(first)) == (2, [(2, 0, 0)])
    second = ledger.load_exports(scan(inbox, "b", 7, ("h1", 2, 2)))
    assert (second.landed, moves(second)) == (1, [(0, 0, 1)])
    third = ledger.load_exports(scan(inbox, "c", 14, ("h1", 1, 4), ("h1", 2, 2)))
    assert (third.landed, moves(third)) == (2, [(0, 1, 0)])
    assert state(ledger) == {("h1", 1): ("2026-01-05", None), ("h1", 2): ("2026-01-05", None)}
    replay = ledger.load_exports(str(inbox))
    assert (replay.landed, moves(replay)) == (0, [])
    assert ledger.table("finding").count() == 5 and ledger.table("scan_run").count() == 3
    assert ledger.table("raw_finding").count() == 6


def test_changed_file_replaces_landing_and_adds_facts(ledger, inbox):
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4), ("h1", 2, 2)))
    changed = ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 3), ("h2", 9, 1)))
    assert (changed.landed, moves(changed)) == (1, [(1, 0, 0)])
    facts = {(r.host, r.plugin_id, r.severity) for r in ledger.table("finding").collect()}
    assert facts == {("h1", 1, 4), ("h1", 2, 2), ("h2", 9, 1)}
    assert ledger.table("raw_finding").count() == 2
    assert len(state(ledger)) == 3


def test_late_scan_moves_no_commitment(ledger, inbox):
    ledger.load_exports(scan(inbox, "a", 7, ("h1", 1, 4)))
    ledger.load_exports(scan(inbox, "b", 14, ("h1", 2, 2)))
    before = state(ledger)
    late = ledger.load_exports(scan(inbox, "old", 0, ("h1", 1, 4), ("h1", 2, 2), ("h3", 3, 3)))
    assert (late.landed, moves(late)) == (3, [])
    assert state(ledger) == before
    aging = {r.severity: r.avg_days_open for r in ledger.reports()["aging"].collect()}
    assert aging == {2: 14.0}
    # A problem first sighted in the late scan dates from it once it is opened.
    ledger.load_exports(scan(inbox, "c", 21, ("h3", 3, 3)))
    assert state(ledger)["h3", 3] == ("2026-01-05", None)


def test_host_without_findings_and_empty_scan(ledger, inbox):
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4)))
    empty = ledger.load_exports(scan(inbox, "b", 7))
    assert (empty.landed, moves(empty)) == (0, [(0, 0, 1)])
    flagged = {r.constraint: r.violations for r in ledger.quality().collect() if r.violations}
    assert flagged == {"newest scan: has findings": 1}


def test_several_scans_in_one_delivery(ledger, inbox):
    for i, found in enumerate([[("h", 1, 4)], [("h", 2, 1)], [("h", 1, 4), ("h", 2, 1)], []]):
        scan(inbox, f"s{9 - i}", 7 * i, *found)  # names run against scan order
    result = ledger.load_exports(str(inbox))
    assert (result.landed, moves(result)) == (4, [(1, 0, 0), (1, 0, 1), (0, 1, 0), (0, 0, 2)])
    assert ledger.table("register_log").count() == 4


STEPS = ["_begin", "_land", "_store_facts", "_roll_up", "_append", "_complete", "_advance", "_publish"]


def everything(ledger):
    """All ten reports and the register, first sightings included."""
    shown = {name: sorted(map(repr, df.collect())) for name, df in ledger.reports().items()}
    shown["evidence"] = sorted(map(repr, ledger.control_evidence().collect()))
    return shown | {"register": sorted(map(repr, ledger.register_state().collect()))}


def test_load_that_died_at_any_step_is_run_again(ledger, inbox, monkeypatch):
    """A death after each step in turn, then the load itself: nothing shows but what is published."""
    ledger.seed_catalogs()
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4)))
    ledger.record_assessment("e")
    path = scan(inbox, "b", 7, ("h1", 2, 2))
    before = everything(ledger)
    for step in STEPS:
        original = getattr(Ledger, step)

        def die_after(self, *args, original=original, **kwargs):
            original(self, *args, **kwargs)
            raise RuntimeError("executor lost")

        with monkeypatch.context() as patch:
            patch.setattr(Ledger, step, die_after)
            with pytest.raises(RuntimeError):
                ledger.load_exports(path)
        assert (everything(ledger) == before) == (step != "_publish"), step
    assert ledger.load_exports(path).landed == 0
    assert state(ledger) == {("h1", 1): ("2026-01-05", "2026-01-12"), ("h1", 2): ("2026-01-12", None)}
    assert ledger.table("finding").count() == 2 and ledger.table("scan_run").count() == 2
    assert ledger.reports()["total_fact_rows"].first().n == 2
    assert [r.high_crit for r in ledger.reports()["trend"].collect()] == [1, 0]
    assert ledger.quality().filter("violations > 0").select("constraint").collect() == []
    assert ledger.vacuum(keep=1) > 0
    assert ledger.table("finding").count() == 2 and len(state(ledger)) == 2


def test_hosts_per_control_are_exact_over_any_scans(spark, ledger, inbox, tmp_path):
    """Bitmaps of several loads, one of them late, one repeated, against a count of the facts."""
    bridge = spark.createDataFrame([(p, f"C{p % 3}") for p in range(1, 6)] + [(1, "C9"), (2, "C9"), (77, "C7")], "plugin_id int, control_id string")
    ledger.insert("plugin_control", bridge, ["plugin_id", "control_id"])
    found = {d: [(f"h{(7 * d + k) % 23}", 1 + (d * k) % 6, k % 5) for k in range(15)] for d in (30, 2, 40, 9)}
    for day, items in found.items():
        path = scan(inbox, f"s{day}", day, *items)
        ledger.load_exports(path)
    ledger.load_exports(path)
    assert ledger.table("host").count() == ledger.table("host").select("host_no").distinct().count() == 23
    at = lambda day: datetime.fromtimestamp(T0 + day * DAY, timezone.utc)
    for since, until in ((None, None), (9, None), (None, 30), (9, 30), (50, None)):
        facts = ledger.table("finding")
        facts = facts.filter(F.col("scanned_at") >= F.lit(at(since))) if since else facts
        facts = facts.filter(F.col("scanned_at") <= F.lit(at(until))) if until else facts
        got = ledger.control_evidence(at(since) if since else None, at(until) if until else None)
        assert sorted(got.collect()) == sorted(correlation.control_evidence(facts, bridge).collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "/finding" not in plan and not re.search(r"hashpartitioning\(host", plan)


def test_numbers_of_hosts_differ_over_tasks_and_loads(spark):
    names = spark.range(1000).selectExpr("CAST(id AS string) AS host")
    numbers = [r.host_no for load in (1, 2) for r in hosts.numbered(names, load, per_task=90).collect()]
    assert len(set(numbers)) == 2000 and min(numbers) > 0
    assert len({(n - 1) // 32768 for n in numbers}) == 2 * 12


def test_stored_loads_are_seen_by_no_report(ledger, inbox):
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4)))
    before = everything(ledger)
    held = ledger.snapshot()
    ledger.store_exports(scan(inbox, "b", 7, ("h1", 2, 2), ("h2", 1, 1)))
    assert everything(ledger) == before
    ledger.upsert_plugins(ledger.spark.createDataFrame([(1, "One", 2)], "plugin_id int, name string, severity smallint"))
    assert everything(ledger) == before and ledger.plugin().count() == 1  # published past the load that waits
    ledger.reconcile()
    assert ledger.reports()["total_fact_rows"].first().n == 3
    # A reader that resolved its manifest before goes on seeing that state.
    assert {name: sorted(map(repr, df.collect())) for name, df in held.reports().items()} == {k: v for k, v in before.items() if k not in ("register", "evidence")}


def versions(ledger):
    return dict(ledger.snapshot().manifest.buckets)


def test_late_scan_of_one_key_rewrites_one_bucket(spark, tmp_path, inbox):
    ledger = Ledger(spark, str(tmp_path / "bucketed"), buckets=16)
    ledger.load_exports(scan(inbox, "a", 7, *[(f"h{i}", 1, 4) for i in range(40)]))
    first = versions(ledger)
    assert len(first) > 8 and Ledger(spark, str(tmp_path / "bucketed"), buckets=3).buckets == 16
    ledger.load_exports(scan(inbox, "late", 0, ("h5", 1, 4)))
    second = versions(ledger)
    assert sum(first[b] != second[b] for b in first) == 1 and set(first) == set(second)
    ledger.load_exports(scan(inbox, "b", 14, *[(f"h{i}", 1, 4) for i in range(40) if i != 9]))
    assert sum(second[b] != v for b, v in versions(ledger).items()) == 1  # one closing
    assert state(ledger)["h9", 1] == ("2026-01-12", "2026-01-19")
    assert ledger.vacuum(keep=1) >= 2
    assert len(state(ledger)) == 40


@pytest.mark.parametrize("seed", [2, 5])
def test_buckets_equal_rebuild(spark, tmp_path, seed):
    """Random histories in random deliveries: the stored register is the rebuilt one."""
    import random

    from histories import as_dict, frames, random_history

    from driftledger.operators import register

    history = random_history(seed, scans=9, hosts=6)
    ledger, rng, start = Ledger(spark, str(tmp_path / f"r{seed}"), buckets=5), random.Random(seed), 0
    while start < len(history):
        size = rng.randint(1, 4)
        finding, runs = frames(spark, history[start : start + size])
        ledger.load(runs, finding.selectExpr("scan_run_id", "0L AS landing_seq", "host", "plugin_id", "plugin_name", "severity", "cve"))
        start += size
    whole = register.rebuild(*frames(spark, history))
    assert as_dict(ledger.register()) == as_dict(whole)
    assert sorted(map(repr, ledger.register().collect())) == sorted(map(repr, whole.collect()))


def test_two_sources_at_one_time_equal_rebuild(spark, tmp_path):
    """Whichever of two sources' scans of one instant is loaded first."""
    from histories import as_dict, frames, random_history

    from driftledger.operators import register

    a, b = random_history(31, scans=3), random_history(32, scans=3)
    parts = [frames(spark, a, "a"), frames(spark, b, "b")]
    facts = parts[0][0].unionByName(parts[1][0]).dropDuplicates(["scanned_at", "host", "plugin_id"])
    built = {k: v[2:] for k, v in as_dict(register.rebuild(facts, parts[0][1].unionByName(parts[1][1]))).items()}
    for order in ((0, 1), (1, 0)):
        ledger = Ledger(spark, str(tmp_path / f"o{order[0]}"))
        for i in range(3):
            for source in order:
                finding, runs = frames(spark, [(a, b)[source][i]], "ab"[source])
                ledger.load(runs, finding.selectExpr("scan_run_id", "0L AS landing_seq", "host", "plugin_id", "plugin_name", "severity", "cve"))
        assert {k: v[2:] for k, v in as_dict(ledger.register()).items()} == built


def test_rows_delivered_again_land_once(spark, ledger, tmp_path):
    columns = "source string, scanned_at timestamp, landing_seq long, host string, plugin_id int, plugin_name string, severity smallint, cve string"
    at = datetime.fromtimestamp(T0, timezone.utc)
    rows = spark.createDataFrame([("s", at, i, f"h{i}", 1, "c", 4, None) for i in range(5)], columns)
    feed = str(tmp_path / "feed")
    for _ in range(3):
        rows.coalesce(1).write.mode("append").parquet(feed)
        watch_sightings(ledger, spark.readStream.schema(columns).parquet(feed), str(tmp_path / "offsets")).awaitTermination()
    assert ledger.stored("raw_finding").count() == 15
    assert ledger.table("raw_finding").count() == 5 and ledger.table("finding").count() == 5
    before = everything(ledger)
    assert ledger.compact("raw_finding") == ["2026_01"]
    ledger.vacuum(keep=1)
    assert ledger.stored("raw_finding").count() == ledger.table("raw_finding").count() == 5
    watch_sightings(ledger, spark.readStream.schema(columns).parquet(feed), str(tmp_path / "again")).awaitTermination()
    assert ledger.table("raw_finding").count() == 5 and everything(ledger) == before


def test_compaction_changes_no_report(ledger, inbox):
    for i, found in enumerate([[("h", 1, 4)], [("h", 2, 1)], [("h", 1, 4), ("h", 2, 1), ("g", 3, 0)], []]):
        ledger.load_exports(scan(inbox, f"s{i}", 10 * i, *found))
    ledger.load_exports(scan(inbox, "s0", 0, ("g", 9, 2)))  # adds a fact to a stored scan
    before, held = everything(ledger), ledger.snapshot()
    for name in ("finding", "rollup", "reach", "raw_finding"):
        ledger.compact(name)
        assert everything(ledger) == before
    assert held.table("finding").count() == 6
    assert ledger.vacuum(keep=1) > 0 and everything(ledger) == before
    assert ledger.stored("rollup").count() == 6 and ledger.stored("finding").count() == 6
    again = ledger.load_exports(scan(inbox, "s0", 0, ("g", 9, 2), ("k", 1, 1)))
    assert again.landed == 1 and ledger.table("raw_finding").filter("host = 'k'").count() == 1


def test_constraints_are_checked_where_rows_were_written(ledger, inbox, capsys):
    ledger.load_exports([scan(inbox, "a", 0, ("h1", 1, 4)), scan(inbox, "b", 40, ("h2", 2, 2))])

    def found(report):
        return {r.constraint: r.violations for r in report.filter("violations > 0").collect()}

    names = {r.constraint for r in ledger.audit().collect()}
    assert found(ledger.check()) == {} and len(names) == 14
    assert names == {r.constraint for r in ledger.quality().collect()}
    # A copy of a stored fact, as some other writer might leave it.
    january = ledger.stored("finding").filter("scan_month = '2026_01'").coalesce(1)
    january.write.mode("append").partitionBy("scan_month", "load_seq").parquet(ledger.path("finding"))
    broken = {"finding: key unique": 1}
    assert found(ledger.audit()) == broken and found(ledger.quality()) == {}
    ledger.load_exports(scan(inbox, "c", 47, ("h2", 2, 2)))
    assert found(ledger.quality()) == {}
    capsys.readouterr()
    ledger.quality().explain("formatted")
    places = re.findall(r"Location: .*", capsys.readouterr().out)
    touched = [p for p in places if "/finding/" in p or "/raw_finding/" in p]
    assert len(touched) == 2 and all("scan_month=2026_02" in p and "2026_01" not in p for p in touched)
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4), ("h9", 3, 1)))
    assert found(ledger.quality()) == broken == found(ledger.check())
    ledger.quality().explain("formatted")
    text = capsys.readouterr().out
    assert "/violation" in text and "/finding" not in text and found(ledger.quality()) == broken


def test_catalogue_revisions(ledger, spark):
    assert ledger.seed_catalogs() == 20 and ledger.seed_catalogs() == 20
    assert ledger.table("plugin_revision").count() == 20
    ledger.upsert_plugins(spark.createDataFrame([(10107, "Renamed", 1), (1, "New", 2)], "plugin_id int, name string, severity smallint"))
    names = {r.plugin_id: (r.name, r.severity) for r in ledger.plugin().collect()}
    assert len(names) == 21 and names[10107] == ("Renamed", 1)
    assert ledger.table("control").count() == 10 and ledger.table("plugin_control").count() == 25


def test_stream_of_files(ledger, inbox, tmp_path):
    results = []

    def drain():
        watch_exports(ledger, str(inbox), str(tmp_path / "offsets"), report=results.append).awaitTermination()

    scan(inbox, "a", 0, ("h1", 1, 4))
    scan(inbox, "b", 7, ("h1", 2, 2))
    drain()
    scan(inbox, "again", 7, ("h1", 2, 2))
    scan(inbox, "c", 14)
    drain()
    drain()
    assert [(r.landed, moves(r)) for r in results] == [(2, [(1, 0, 0), (1, 0, 1)]), (0, [(0, 0, 1)])]


def test_batch_size_never_shows_in_the_register(spark, tmp_path):
    inbox = tmp_path / "backlog"
    inbox.mkdir()
    for i, (day, found) in enumerate([(14, [("h", 1, 4)]), (7, []), (0, [("h", 1, 4), ("h", 2, 2)])]):
        os.utime(scan(inbox, f"s{i}", day, *found), (T0 + i, T0 + i))  # the newest scan is written first
    got = []
    for size in (1, 2, 1000):
        ledger = Ledger(spark, str(tmp_path / f"ledger{size}"))
        results = []
        watch_exports(ledger, str(inbox), str(tmp_path / f"at{size}"), max_files=size, report=results.append).awaitTermination()
        log = ledger.table("register_log").select("scanned_at", "opened", "reopened", "closed").orderBy("scanned_at")
        got.append((state(ledger), [tuple(r) for r in log.collect()], [(r.landed, moves(r)) for r in results]))
    assert got[0] == got[1] == got[2]
    assert got[0][2] == [(3, [(2, 0, 0), (0, 0, 2), (0, 1, 0)])]


def test_stored_scan_is_reconciled_by_the_next_drain(ledger, inbox, tmp_path):
    ledger.store_exports(scan(inbox, "a", 0, ("h1", 1, 4)))
    assert state(ledger) == {} and ledger.table("scan_run").count() == 0
    ledger.load_exports(scan(inbox, "b", 7))
    assert state(ledger) == {("h1", 1): ("2026-01-05", "2026-01-12")}


def test_emptied_run_leaves_no_landing_rows(ledger, inbox):
    ledger.load_exports(scan(inbox, "a", 0, ("h1", 1, 4)))
    ledger.load_exports(scan(inbox, "a", 0))
    assert ledger.table("raw_finding").count() == 0 and ledger.table("finding").count() == 1


def test_scan_cut_over_micro_batches(spark, ledger, tmp_path):
    feed, columns = str(tmp_path / "feed"), "source string, scanned_at timestamp, landing_seq long, host string, plugin_id int, plugin_name string, severity smallint, cve string"
    at = [datetime.fromtimestamp(T0 + day * DAY, timezone.utc) for day in (0, 7)]
    for lot in ([(at[0], 1), (at[1], 1)], [(at[1], 2), (at[0], 2)]):
        rows = [("s", t, check, "h", check, "c", 4, None) for t, check in lot]
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(feed)
    results = []
    watch_sightings(ledger, stream, str(tmp_path / "offsets"), results.append).awaitTermination()
    assert [(r.landed, moves(r)) for r in results] == [(4, [(2, 0, 0), (0, 0, 0)])]
    assert ledger.table("raw_finding").count() == 4 and ledger.table("finding").count() == 4


@pytest.mark.skipif(not WEEKLY, reason="WEEKLY_SCANS_DIR not set")
def test_six_weekly_exports(ledger):
    result = ledger.load_exports(WEEKLY)
    assert result.landed == 1730
    assert moves(result) == [(309, 0, 0), (29, 0, 44), (31, 7, 38), (25, 3, 50), (33, 10, 30), (23, 8, 40)]
    replay = ledger.load_exports(str(max(Path(WEEKLY).glob("*.nessus"))))
    assert replay.landed == 0
    months = ledger.table("finding").groupBy("scan_month").count().collect()
    assert {r[0]: r[1] for r in months} == {"2026_07": 1454, "2026_08": 276}

    assert ledger.seed_catalogs() == 20
    export_id = "7f9d2c10-0000-4000-8000-000000000001"
    assert ledger.record_assessment(export_id) == ledger.record_assessment(export_id) == 10
    got = {name: [tuple(r) for r in df.collect()] for name, df in ledger.reports().items()}
    assert got["total_fact_rows"] == [(1730,)]
    assert got["by_severity"] == [(4, 13), (3, 42), (2, 93), (1, 68), (0, 60)]
    assert [r[1:4] for r in got["trend"]] == [
        (88, None, None), (71, 88, -17), (64, 71, -7), (54, 64, -10), (56, 54, 2), (55, 56, -1),
    ]
    assert got["delta"] == [("new", 31), ("resolved", 40), ("still open", 245)]
    assert got["aging"] == [(4, 13, 22.6), (3, 42, 22.2), (2, 93, 25.8), (1, 68, 29.6), (0, 60, 28.1)]
    assert got["poam_status"] == [
        (4, 13, 7, 15, 208), (3, 42, 21, 30, 336), (2, 93, 0, 90, 372), (1, 68, 0, 180, 136), (0, 60, 0, 365, 60),
    ]
    assert [(r[4], r[6]) for r in got["worst_overdue"]] == [(4, 20)] * 7 + [(3, 5)] * 3
    assert {(r[0], r[2], r[3], r[4], r[5], r[6], r[7]) for r in got["correlate"]} == {
        ("CM-6", "Compliant", 30, 1, 26, 2, "CONTRADICTED"),
        *[(c, "Compliant", 0, None, 0, 0, "not assessable") for c in ("AC-2", "AU-6", "IA-5", "SI-4")],
        ("SC-8", "Non-Compliant", 72, 4, 36, 6, "corroborated"),
        ("SC-17", "Non-Compliant", 84, 3, 39, 6, "corroborated"),
        ("CM-7", "Non-Compliant", 35, 4, 28, 3, "corroborated"),
        ("SC-13", "Non-Compliant", 65, 3, 37, 5, "corroborated"),
        ("SI-2", "Non-Compliant", 24, 4, 20, 3, "corroborated"),
    }
    assert got["uncovered"] == [(11219, "Nessus SYN scanner", 0, 23), (19506, "Nessus Scan Information", 0, 20)]
    poam = ledger.register()
    assert poam.count() == 450 and poam.filter("closed_on IS NULL").count() == 276
    rows = poam.filter("plugin_id = 97833").withColumn("o", F.col("opened_on").cast("string")).collect()
    by_host = {r.host: (r.o, str(r.due_on), str(r.closed_on)) for r in rows}
    assert by_host["host-005.mil"] == ("2026-07-03", "2026-07-18", "None")
    assert by_host["host-003.mil"] == ("2026-07-03", "2026-07-18", "2026-07-31")
    assert by_host["host-001.mil"] == ("2026-07-03", "2026-07-18", "2026-07-10")
    assert ledger.quality().filter("violations > 0").count() == 0


