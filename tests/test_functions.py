import hashlib
import uuid
from datetime import datetime, timezone

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driftledger.functions import export_fields, identity, payload, policy


FAILURES = (PySparkException, Py4JJavaError)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_policy_by_severity(spark):
    rows = spark.range(-1, 7).select(
        "id", policy.sla_days(F.col("id")), policy.rom_hours(F.col("id")), policy.severity_label(F.col("id"))
    ).collect()
    assert [tuple(r) for r in rows] == [
        (-1, 365, 1, "info"), (0, 365, 1, "info"), (1, 180, 2, "low"), (2, 90, 4, "medium"),
        (3, 30, 8, "high"), (4, 15, 16, "critical"), (5, 365, 1, "info"), (6, 365, 1, "info"),
    ]


def test_verdict_order(spark):
    cases = [
        ("Compliant", None, None, "not assessable"),
        ("Non-Compliant", None, 0, "not assessable"),
        ("Compliant", 3, 2, "CONTRADICTED"),
        ("Non-Compliant", 3, 2, "corroborated"),
        ("Non-Compliant", None, 2, "unevidenced"),
        ("Non-Compliant", 0, 2, "unevidenced"),
        ("Compliant", None, 2, "verified clean"),
    ]
    df = spark.createDataFrame(cases, "c string, f long, s long, want string")
    got = df.select("want", policy.verdict(F.col("c"), F.col("f"), F.col("s")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_verdict_flag_and_signed_change(spark):
    flag = policy.verdict_flag
    row = one(
        spark,
        flag(F.lit("CONTRADICTED"), F.lit("T")),
        flag(F.lit("not assessable"), F.lit("T")),
        flag(F.lit("corroborated"), F.lit("T")),
        policy.signed_change(F.lit(3)),
        policy.signed_change(F.lit(-2)),
        policy.signed_change(F.lit(0)),
        policy.signed_change(F.lit(None).cast("int")),
    )
    assert tuple(row) == ("  <-- T", "  (T — no scanner can see this)", "", "+3", "-2", "0", "—")


def test_owner_is_stable_and_prefers_inventory(spark):
    hosts = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "host string")
    inventory = spark.createDataFrame([("h2", "Someone")], "host string, owner string")
    owned = {r.host: r.owner for r in policy.assign_owner(hosts, inventory).collect()}
    expected = {h: policy.OWNERS[int(hashlib.md5(h.encode()).hexdigest()[:8], 16) % 6] for h in ("h1", "h3")}
    assert owned == {**expected, "h2": "Someone"}


def test_run_id_is_the_guid_of_the_digest(spark):
    at = datetime(2026, 7, 3, 9, tzinfo=timezone.utc)
    got = one(spark, identity.run_id(F.lit("acas-nessus"), F.lit(at)))[0]
    digest = hashlib.md5(b"acas-nessus|2026-07-03T09:00:00.0000000+00:00").digest()
    assert got == str(uuid.UUID(bytes_le=digest)) == "3ddeec23-cc64-3bab-1450-7a284499bacf"
    micro = one(spark, identity.run_id(F.lit("s"), F.lit(at.replace(microsecond=120))))[0]
    digest = hashlib.md5(b"s|2026-07-03T09:00:00.0001200+00:00").digest()
    assert micro == str(uuid.UUID(bytes_le=digest))


@pytest.mark.parametrize(
    "text",
    [
        "2026-07-03 09:00:00", "2026-07-03T09:00:00Z", "2026-07-03T11:00:00+02:00", "Fri Jul  3 09:00:00 2026",
        "Jul 3 09:00:00 2026", "3 Jul 2026 09:00:00", "7/3/2026 09:00:00", "7/3/2026 9:00:00 AM", "Fri, 3 Jul 2026 09:00:00",
    ],
)
def test_loose_timestamp(spark, text):
    got = one(spark, F.unix_seconds(export_fields.loose_timestamp(F.lit(text))))[0]
    assert got == datetime(2026, 7, 3, 9, tzinfo=timezone.utc).timestamp()


@pytest.mark.parametrize("text", ["", "soon", None, "2026-13-45 09:00:00"])
def test_unreadable_time_is_null(spark, text):
    assert one(spark, export_fields.loose_timestamp(F.lit(text).cast("string")))[0] is None


def project(spark, text):
    landed = spark.createDataFrame([(1, text)], "landing_seq long, payload string")
    return payload.project_payload(landed).collect()


def test_payload_projects_numbers_and_quoted_numbers(spark):
    text = '{"host":"h","plugin_id":"12","plugin_name":"n","severity":3,"cve":null,"port":443}'
    assert [tuple(r) for r in project(spark, text)] == [(1, "h", 12, "n", 3, None)]


@pytest.mark.parametrize(
    "text",
    [
        '{"host":"h","plugin_id":"twelve","plugin_name":"n","severity":3}',
        '{"host":"h","plugin_id":12,"plugin_name":"n","severity":70000}',
        '{"plugin_id":12,"plugin_name":"n","severity":3}',
        '{"host":"h","plugin_id":null,"plugin_name":"n","severity":3}',
        '{"host":"h", broken',
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_payload_fails_loudly(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(FAILURES):
            project(spark, text)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
