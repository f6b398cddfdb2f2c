"""The shape of the plans, which is what decides how they scale."""

import contextlib
import io
import re

import pyarrow.parquet as pq
import pytest
from histories import frames, random_history
from pyspark.sql import functions as F

from driftledger.functions.identity import run_id
from driftledger.operators import facts, register, scans
from driftledger.plans import ledger as ledger_module
from driftledger.plans import relations as rel
from driftledger.plans.ledger import Ledger
from driftledger.plans.registry import QUERIES
from driftledger.schemas import FINDING
from driftledger.session import local_frame

LAZY = sorted(name for name in QUERIES if not name.startswith(("stream_", "load_")))


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir), "simple")
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert operator not in text


def test_dedup_combines_copies_before_the_shuffle(spark, sf_dir):
    text = plan(facts.dedup_facts(rel.sightings_a(rel.table(spark, sf_dir, "events"))), "simple")
    assert text.count("Exchange hashpartitioning") == 1
    above, below = text.split("Exchange hashpartitioning")
    assert "min(struct" in above and "partial_min(struct" in below


def test_new_facts_are_deduplicated_once(spark, sf_dir):
    arriving = rel.with_run(rel.sightings_a(rel.table(spark, sf_dir, "events")))
    text = plan(facts.new_facts(arriving, local_frame(spark, [], FINDING)), "simple")
    assert text.count("partial_min(struct") == 1


def test_files_of_a_month_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """A load's file has several row groups, which is how far a reader can split it."""
    monkeypatch.setattr(ledger_module, "ROW_GROUP", 1 << 16, raising=False)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.range(0, 40_000, 1, 1).selectExpr("'s' AS source", "timestamp'2026-01-05' AS scanned_at", "id AS landing_seq", "md5(string(id)) AS host", "1 AS plugin_id", "'c' AS plugin_name", "4S AS severity", "CAST(NULL AS string) AS cve")
    keyed = rows.withColumn("scan_run_id", run_id(F.col("source"), F.col("scanned_at")))
    ledger.load(keyed, keyed)
    for name in ("raw_finding", "finding"):
        groups = [pq.ParquetFile(f).metadata.num_row_groups for f in (tmp_path / "ledger" / name).rglob("*.parquet")]
        assert len(groups) == 1 and groups[0] > 3


def test_one_month_of_a_load_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_module, "TASK_BYTES", "256k", raising=False)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, ledger = spark.conf.get(key), Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.range(0, 40_000, 1, 8).selectExpr("'s' AS source", "timestamp'2026-01-05' AS scanned_at", "id AS landing_seq", "md5(string(id)) AS host", "1 AS plugin_id", "'c' AS plugin_name", "4S AS severity", "CAST(NULL AS string) AS cve")
    keyed = rows.withColumn("scan_run_id", run_id(F.col("source"), F.col("scanned_at")))
    assert ledger.load(keyed, keyed).landed == 40_000 and spark.conf.get(key) == before
    assert len([*(tmp_path / "ledger" / "raw_finding").rglob("*.parquet")]) > 1


def test_scans_are_named_from_two_columns(spark):
    """Ids are made once a scan; a row whose source is null keeps its place, copies stay."""
    rows = [("s", 5, 1), ("s", 5, 1), ("s", 6, 2), (None, 5, 3)]
    sightings = spark.createDataFrame(rows, "source string, day int, landing_seq long").withColumn("scanned_at", F.timestamp_seconds(F.col("day") * 86400))
    runs, found = scans.named(sightings)
    made = run_id(F.col("source"), F.col("scanned_at"))
    assert runs.count() == 3 and found.filter(F.col("scan_run_id") == made).count() == 4
    text = plan(found, "simple")
    assert "BroadcastHashJoin" in text and "md5" not in text


def test_rebuild_shuffles_facts_once(spark, sf_dir):
    finding = rel.finding_a(spark, sf_dir)
    text = plan(register.rebuild(finding, rel.scan_run_a(spark, sf_dir)), "simple")
    # One shuffle removes duplicates, one gathers each problem; the scan list is sent to the facts.
    by_key = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert sum("host" in keys for keys in by_key) == 2
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    ledger = Ledger(spark, str(tmp_path_factory.mktemp("plans") / "ledger"))
    history = random_history(3, scans=8)
    finding, runs = frames(spark, history)
    numbered = finding.selectExpr("scan_run_id", "0L AS landing_seq", "host", "plugin_id", "plugin_name", "severity", "cve")
    ledger.load(runs, numbered)
    ledger.seed_catalogs()
    return ledger, history


def test_newest_scan_reads_one_month_and_few_columns(stored):
    ledger, history = stored
    text = plan(ledger.reports()["by_severity"])
    newest = history[-1][0]
    assert "(scan_month#" in text and f"{newest:%Y_%m}" in re.search(r"PartitionFilters: .*", text)[0]
    pushed = re.search(r"PushedFilters: .*", text)[0]
    assert "EqualTo(scanned_at" in pushed and "EqualTo(scan_run_id" in pushed
    schema = re.search(r"ReadSchema: .*", text)[0]
    assert "severity" in schema and "cve" not in schema and "plugin_name" not in schema


def test_delta_reads_two_scans_with_one_shuffle_per_key(stored):
    ledger, _ = stored
    text = plan(ledger.reports()["delta"])
    assert text.count("Scan parquet") == 2  # named once in the tree and once in the details
    assert "Join" not in text


def test_aging_from_state_does_not_read_history(stored):
    ledger, _ = stored
    text = plan(ledger.reports()["aging"])
    scans = re.findall(r"Location: .*", text)
    assert len(scans) == 2 and sum("/register/version=" in s for s in scans) == 1
    assert re.search(r"PartitionFilters: .*scan_month", text)


def test_uncovered_counts_before_a_large_map_is_joined(spark, stored):
    ledger, _ = stored
    small = plan(ledger.reports()["uncovered"], "simple")
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(ledger.reports()["uncovered"], "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert large.index("LeftAnti") < large.index("partial_count(1)")


def test_owner_counts_survive_a_hot_host(spark):
    """A third of all facts on one host: still one row per problem and scan."""
    history = [(t, {**f, **{("hot", c): ("x", 2) for c in range(20)}}) for t, f in random_history(9, scans=4)]
    finding, runs = frames(spark, history)
    assert register.rebuild(finding, runs).filter("host = 'hot'").count() == 20


@pytest.mark.parametrize("name", ["uncovered", "control_evidence", "correlate", "verdict_flag", "control_drilldown", "assess_controls", "latest_export", "evidence_sources", "export_append"])
def test_month_bounds_reach_the_scan(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    scans = [line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert scans and all("GreaterThanOrEqual(l_shipdate" in line for line in scans)
