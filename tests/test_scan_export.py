"""The export reader on small files of our own and on the published samples."""

import os
from datetime import datetime, timezone
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driftledger.sources.scan_export import canonical_order, export_hosts, read_scan_exports

FAILURES = (PySparkException, Py4JJavaError)
FALLBACK = datetime(2000, 1, 1, tzinfo=timezone.utc)
WEEKLY = os.environ.get("WEEKLY_SCANS_DIR")  # six weekly exports of one estate


def host(name, items="", time=None, text_time=None):
    attribute = "" if name is None else f' name="{name}"'
    tags = "" if time is None else f'<tag name="HOST_START_TIMESTAMP">{time}</tag>'
    tags += "" if text_time is None else f'<tag name="HOST_START">{text_time}</tag>'
    return f"<ReportHost{attribute}><HostProperties><tag name=\"host-ip\">10.0.0.1</tag>{tags}</HostProperties>{items}</ReportHost>"


def item(plugin=1, severity=2, name="check", inner="", **extra):
    attributes = {"pluginID": plugin, "severity": severity, "pluginName": name, **extra}
    text = " ".join(f'{k}="{v}"' for k, v in attributes.items() if v is not None)
    return f"<ReportItem {text}>{inner}<risk_factor>x</risk_factor></ReportItem>"


def write(path, *hosts):
    path.write_text(
        '<?xml version="1.0" encoding="utf-8"?><NessusClientData_v2><Policy/><Report name="t">'
        + "".join(hosts)
        + "</Report></NessusClientData_v2>",
        encoding="utf-8-sig",
    )
    return str(path)


def read(spark, path, fallback=FALLBACK):
    exports = read_scan_exports(spark, path, fallback)
    scans = exports.scans.withColumn("scanned_at", F.unix_seconds("scanned_at")).collect()
    findings = [
        (r.host, r.plugin_id, r.plugin_name, r.severity, r.cve)
        for r in canonical_order(exports.findings).collect()
    ]
    return {Path(s.file).name: s.scanned_at for s in scans}, findings


def test_keeps_only_well_formed_items(spark, tmp_path):
    path = write(
        tmp_path / "a.nessus",
        host(
            "printer",
            item(5120, 3, "Open share", "<cve>CVE-A</cve><cve>CVE-B</cve>")
            + item(611, 1, "Banner")
            + item("n/a", 2, "bad id")
            + item(7, 70000, "bad severity")
            + item("12.5", 1, "fractional id")
            + item(None, 1, "no id")
            + item(" +8 ", " 1 ", None)
            + item(9, 0, "empty cve", "<cve/>"),
            time=1700000123,
        ),
        host(None, item(31, 1, "nameless host")),
        host("  ", item(31, 1, "blank host")),
    )
    times, findings = read(spark, path)
    assert times == {"a.nessus": 1700000123}
    assert findings == [
        ("printer", 8, "", 1, None),
        ("printer", 9, "empty cve", 0, ""),
        ("printer", 611, "Banner", 1, None),
        ("printer", 5120, "Open share", 3, "CVE-A"),
    ]


def test_scan_time_is_the_earliest_named_host(spark, tmp_path):
    write(tmp_path / "min.nessus", host("b", item(), 2000), host("a", "", 1500), host(None, item(), 100))
    write(tmp_path / "text.nessus", host("a", item(), text_time="2026-07-03 09:00:00"), host("b", item(), "soon"))
    write(tmp_path / "both.nessus", host("a", item(), 3000, text_time="1999-01-01 00:00:00"))
    write(tmp_path / "none.nessus", host("a", item()))
    write(tmp_path / "nohosts.nessus")
    (tmp_path / "sub").mkdir()
    write(tmp_path / "sub" / "below.nessus", host("hidden", item()))
    (tmp_path / "notes.txt").write_text("not an export")
    times, findings = read(spark, str(tmp_path))
    assert times == {
        "min.nessus": 1500,
        "text.nessus": int(datetime(2026, 7, 3, 9, tzinfo=timezone.utc).timestamp()),
        "both.nessus": 3000,
        "none.nessus": int(FALLBACK.timestamp()),
        "nohosts.nessus": int(FALLBACK.timestamp()),
    }
    assert "hidden" not in {f[0] for f in findings}


def test_no_time_without_fallback_fails(spark, tmp_path):
    path = write(tmp_path / "none.nessus", host("a", item()))
    with pytest.raises(FAILURES, match="no scan time"):
        read(spark, path, fallback=None)


def test_truncated_file_fails_the_load(spark, tmp_path):
    good = write(tmp_path / "good.nessus", host("a", item(), 1))
    (tmp_path / "cut.nessus").write_text(Path(good).read_text()[:-60])
    with pytest.raises(FAILURES):
        read(spark, str(tmp_path))


def test_named_file_and_folder_with_a_dot(spark, tmp_path):
    other = write(tmp_path / "export.xml", host("a", item(), 5))
    assert read(spark, other)[0] == {"export.xml": 5}
    folder = tmp_path / "v1.2"
    folder.mkdir()
    write(folder / "in.nessus", host("b", item(), 6))
    (folder / "notes.txt").write_text("<ReportHost name='x'")
    assert read(spark, str(folder))[0] == {"in.nessus": 6}
    assert read(spark, [str(folder / "in.nessus"), other])[0] == {"in.nessus": 6, "export.xml": 5}


def test_missing_path_reads_empty(spark, tmp_path):
    assert read(spark, str(tmp_path / "nowhere")) == ({}, [])
    assert read(spark, str(tmp_path / "nowhere.nessus")) == ({}, [])
    assert read(spark, str(tmp_path)) == ({}, [])


@pytest.mark.skipif(not WEEKLY, reason="WEEKLY_SCANS_DIR not set")
def test_six_weekly_exports(spark):
    files = sorted(Path(WEEKLY).glob("*.nessus"))
    times, findings = read(spark, WEEKLY)
    assert len(times) == 6 and len(findings) == 1730
    one, first = read(spark, str(files[0]))
    assert len(first) == 309 and len({f[0] for f in first}) == 40
    assert one == {files[0].name: int(datetime(2026, 7, 3, 9, tzinfo=timezone.utc).timestamp())}
    assert first == sorted(first, key=lambda f: (f[0], f[1]))
    _, second = read(spark, str(files[1]))
    assert len(second) == 294


def large(folder, hosts, name="large.nessus"):
    """An export whose hosts differ in every part the reader looks at."""
    parts = ['<?xml version="1.0"?>\n<!-- made <here> -->\n<Data><Policy><p>x</p></Policy><Report name="r">']
    for i in range(hosts):
        if i % 7 == 3:
            parts.append(f'<ReportHost name="empty {i}" note="a > b"/>')
        parts.append(host(f"h{i} &amp; co" if i % 5 else "", "".join(item(k, k % 5, f"check {k}", f"<cve>CVE-{k}</cve>") for k in range(i % 4)), 1767600000 + i if i % 3 else None))
        if i % 11 == 5:
            parts.append('</Report>\n<Report name="s">\n')
    path = folder / name
    path.write_text("\n".join(parts) + "</Report></Data>\n")
    return path


def test_a_large_file_is_read_in_several_tasks(spark, tmp_path):
    path = large(tmp_path, 900)
    whole = export_hosts(spark, str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        split = export_hosts(spark, str(path))
        assert split.rdd.getNumPartitions() > 4
        assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole.count() == 900 + len(range(3, 900, 7))
    both = export_hosts(spark, [str(path), str(write(tmp_path / "small.nessus", host("box")))], split_bytes=10_000)
    assert both.count() == whole.count() + 1


@pytest.mark.parametrize("cut", [1, 8, 20, 300, 1000, 1800])
def test_a_large_truncated_file_fails(spark, tmp_path, cut):
    path = large(tmp_path, 40)
    text = path.read_text()
    path.write_text(text[:-cut] if cut > 1 else text[: text.rindex("</ReportHost>") + len("</ReportHost>")])
    with pytest.raises(Exception, match="malformed|MALFORMED"):
        export_hosts(spark, str(path), split_bytes=100).count()


def test_a_large_file_without_hosts(spark, tmp_path):
    (tmp_path / "none.nessus").write_text("<Data><Policy/>" + " " * 500 + "</Data>")
    assert export_hosts(spark, str(tmp_path), split_bytes=100).count() == 0
    (tmp_path / "none.nessus").write_text("<Data><Policy/>" + " " * 500)
    with pytest.raises(Exception, match="malformed"):
        export_hosts(spark, str(tmp_path), split_bytes=100).count()
