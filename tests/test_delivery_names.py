import os

import pytest
from pyspark.sql import functions as F

from driftledger.operators.keyed import insert_if_absent
from driftledger.plans.ledger import Ledger
from driftledger.sources.scan_export import export_files, export_hosts
from driftledger.streaming.reconcile import watch_exports

HOST = '<R><ReportHost name="box"><HostProperties><tag name="HOST_START_TIMESTAMP">1767600000</tag></HostProperties><ReportItem pluginID="1" severity="2" pluginName="x"/></ReportHost></R>'


@pytest.mark.parametrize("name", ["week 1.nessus", "50% off.nessus", "scan [1].nessus", "plain.nessus"])
def test_announced_names_are_read(spark, tmp_path, name):
    (tmp_path / name).write_text(HOST)
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select("path").collect()
    assert export_hosts(spark, [r.path for r in listed]).count() == 1


@pytest.mark.parametrize("name", ["scanfile", "scan [1].nessus", "a{b}c.nessus", "star*.nessus", "q?.nessus", "back\\slash.nessus", "dir.with.dots"])
def test_named_files_are_literal(spark, tmp_path, name):
    """By name, and in a list beside a file of a folder that is not asked for."""
    (tmp_path / name).write_text(HOST)
    (tmp_path / "scan 1.nessus").write_text(HOST)
    for path in (str(tmp_path / name), [str(tmp_path / name)]):
        assert export_hosts(spark, path).count() == export_files(spark, path).count() == 1
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "in.nessus").write_text(HOST)
    (tmp_path / "inbox" / "other.xml").write_text(HOST)
    both = [str(tmp_path / "inbox"), str(tmp_path / name)]
    files = {r.file.rsplit("/", 1)[-1] for r in export_files(spark, both).collect()}
    assert len(files) == 2 and "other.xml" not in files and "scan%201.nessus" not in files
    assert export_hosts(spark, both).count() == 2


@pytest.mark.parametrize("name", ["_a.nessus", ".a.nessus"])
def test_names_that_readers_skip_fail(spark, tmp_path, name):
    (tmp_path / name).write_text(HOST)
    for path in (str(tmp_path / name), str(tmp_path)):
        with pytest.raises(ValueError, match="rename"):
            export_hosts(spark, path)


def test_a_bracketed_name_loads_and_streams(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "scan [1].nessus").write_text(HOST)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.load_exports(str(inbox / "scan [1].nessus")).landed == 1
    os.rename(inbox / "scan [1].nessus", inbox / "renamed {2}.nessus")
    watch_exports(ledger, str(inbox), str(tmp_path / "offsets")).awaitTermination()  # a copy under another name lands nothing
    assert ledger.table("finding").count() == ledger.table("raw_finding").count() == ledger.table("scan_run").count() == 1


def test_a_missing_member_of_a_list_fails(spark, tmp_path):
    (tmp_path / "a.nessus").write_text("<R></R>")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        export_hosts(spark, [str(tmp_path / "a.nessus"), str(tmp_path / "b.nessus")]).count()


def test_insert_keeps_one_of_a_key(spark):
    incoming = spark.createDataFrame([("C1", 2), ("C1", 1), ("C2", 1)], "k string, v int")
    got = insert_if_absent(incoming, incoming.filter(F.col("k") == "C2"), ["k"]).collect()
    assert [tuple(r) for r in got] == [("C1", 1)]
