"""Scan export files (XML) as DataFrames."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger import storage
from driftledger.functions.export_fields import first_of, has_text, host_start
from driftledger.functions.identity import DEFAULT_SOURCE, run_id
from driftledger.schemas import EXPORT_HOST

# File name pattern and the element read as one row.
FILE_PATTERN = "*.nessus"
HOST_ELEMENT = "ReportHost"


@dataclass(frozen=True)
class ScanExports:
    """``scans``: one row per file (file, scan_run_id, scanned_at, source).
    ``findings``: one row per well-formed item (file, landing_seq, host,
    plugin_id, plugin_name, severity, cve)."""

    scans: DataFrame
    findings: DataFrame


def read_scan_exports(
    spark: SparkSession,
    path: str | list[str],
    fallback: datetime | None,
    source: str = DEFAULT_SOURCE,
) -> ScanExports:
    """Read one export file, several, or a directory's files (not its subfolders).

    ``fallback`` is the scan time of a file that carries none; it has to be
    given, since a clock reading would make every replay look like a new scan.
    With ``None`` such a file fails the load. A path that does not exist reads
    as no scans; a truncated file fails the whole load.
    """
    hosts = started_hosts(export_hosts(spark, path))
    return ScanExports(
        scans=scan_times(export_files(spark, path), hosts, fallback, source),
        findings=flatten_items(hosts),
    )


def listing(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """(path, length) of the export files that ``path`` names.

    A file is taken as given, whatever its name; of a folder the files called
    ``*.nessus``. Names are literal: brackets, stars and blanks are part of them. One
    missing place holds no scans, a missing member of a list is a lost delivery and fails,
    and so does a name that Spark's readers would skip.
    """
    found: list[tuple[str, int]] = []
    for place in filter(None, [path] if isinstance(path, str) else path):
        inside = storage.files(spark, place)
        if inside is None:
            if isinstance(path, str):
                return []
            raise FileNotFoundError(f"[PATH_NOT_FOUND] no export at {place}")
        if storage.is_folder(spark, place):
            inside = [(p, n) for p, n in inside if p.endswith(FILE_PATTERN.lstrip("*"))]
        found += inside
    hidden = [p for p, _ in found if p.rsplit("/", 1)[-1][0] in "_."]
    if hidden:
        raise ValueError(f"names that begin with _ or . are skipped by Spark's readers; rename {hidden[0]}")
    return sorted(set(found))


def literal(path: str) -> str:
    """A path whose brackets, stars and the like are part of its name."""
    return re.sub(r"([\\[\]{}*?])", r"\\\1", path)


def export_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files themselves, so that one without hosts still counts as a scan.
    Only the path column is read, never the content."""
    names = [literal(p) for p, _ in listing(spark, path)]
    if not names:
        return spark.range(0).select(F.lit("").alias("file"))
    return spark.read.format("binaryFile").load(names).select(F.col("_metadata.file_path").alias("file"))


def export_hosts(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """One row per host element: (file, _name, HostProperties, ReportItem).

    A file of more than ``split_bytes`` (by default what one read task takes) is cut at
    its host elements and read by as many tasks as it has splits.
    """
    if split_bytes is None:
        split_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = listing(spark, path)
    small, large = ([literal(p) for p, n in files if (n > split_bytes) == big] for big in (False, True))
    parts = []
    if small:
        reader = spark.read.format("xml").schema(EXPORT_HOST).option("rowTag", HOST_ELEMENT).option("mode", "FAILFAST")
        parts.append(reader.load(small).withColumn("file", F.col("_metadata.file_path")))
    if large:
        parts.append(split_hosts(spark, large))
    if not parts:
        return spark.createDataFrame([], EXPORT_HOST).withColumn("file", F.lit(""))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# How a host element begins, one without content, and the start of a document up to its root's name.
HOST_START = f"<{HOST_ELEMENT}(?=[\\s>])"
EMPTY_HOST = f"<{HOST_ELEMENT}(?:\\s+[\\w:.-]+\\s*=\\s*(?:\"[^\"]*\"|'[^']*'))*\\s*/>"
ROOT = "^\uFEFF?\\s*(?:<\\?[\\s\\S]*?\\?>\\s*|<!--[\\s\\S]*?-->\\s*|<!DOCTYPE[^>]*>\\s*)*<([A-Za-z_][\\w:.-]*)"
LAST_TAG = "</([A-Za-z_][\\w:.-]*)\\s*>\\s*(?:<!--[\\s\\S]*?-->\\s*)*$"


def split_hosts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Host elements of large files: the text between two closing tags is one record, so a
    file is read by several tasks and each host parsed for itself.

    A file whose last record is not the end of its root element was cut short and fails the
    load, as malformed hosts do. So does one with a host's tags inside a CDATA section
    or a comment, rather than being read wrong.
    """
    text = spark.read.format("text").option("lineSep", f"</{HOST_ELEMENT}>").load(names)
    block = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    chunks = text.select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", EMPTY_HOST, "").alias("rest"), "value", block.alias("place"))
    chunks = chunks.withColumn("at", F.regexp_instr("rest", F.lit(HOST_START)))
    ends = chunks.groupBy("file").agg(
        F.min_by(F.regexp_extract("value", ROOT, 1), "place").alias("root"),
        F.max_by(F.struct(F.col("at").alias("at"), F.regexp_extract("value", LAST_TAG, 1).alias("tag")), "place").alias("last"),
    )
    whole = (F.col("last.at") == 0) & (F.col("root") != "") & (F.col("root") == F.col("last.tag"))
    cut_short = F.raise_error(F.concat(F.lit("malformed export, its end is missing: "), "file")).cast("boolean")
    checked = ends.select("file", F.when(whole, F.lit(True)).otherwise(cut_short).alias("whole"))
    broken = checked.filter("NOT whole").count()  # raises on the first file without its end
    assert not broken
    opened = F.when(F.col("at") > 0, F.array(F.concat(F.expr("substring(rest, at)"), F.lit(f"</{HOST_ELEMENT}>")))).otherwise(F.array().cast("array<string>"))
    every = F.concat(F.regexp_extract_all("value", F.lit(EMPTY_HOST), F.lit(0)), opened)
    hosts = chunks.select("file", F.explode(every).alias("xml"))
    parsed = F.from_xml("xml", F.lit(EXPORT_HOST.simpleString()), {"rowTag": HOST_ELEMENT, "mode": "FAILFAST"})
    return hosts.select("file", F.inline(F.array(parsed))).select(*EXPORT_HOST.names, "file")


def started_hosts(hosts: DataFrame) -> DataFrame:
    """Named hosts with their start time; a nameless one is unusable, and its
    start time does not count."""
    return hosts.filter(has_text(F.col("_name"))).withColumn("started", host_start(F.col("HostProperties")))


def scan_times(
    files: DataFrame, hosts: DataFrame, fallback: datetime | None, source: str
) -> DataFrame:
    """A file's scan time is its earliest host's start, else ``fallback``."""
    started = hosts.groupBy("file").agg(F.min("started").alias("_started"))
    if fallback is None:
        default = F.raise_error(F.concat(F.lit("no scan time in "), "file")).cast("timestamp")
    else:
        default = F.lit(fallback).cast("timestamp")
    return (
        files.join(started, "file", "left")
        .select("file", F.coalesce("_started", default).alias("scanned_at"), F.lit(source).alias("source"))
        .withColumn("scan_run_id", run_id(F.col("source"), F.col("scanned_at")))
    )


def flatten_items(hosts: DataFrame) -> DataFrame:
    """One row per well-formed item; one whose ids are not numbers is dropped."""
    return (
        hosts.select("file", F.col("_name").alias("host"), F.posexplode("ReportItem").alias("landing_seq", "_item"))
        .select(
            "file",
            F.col("landing_seq").cast("bigint"),
            "host",
            F.col("_item._pluginID").try_cast("int").alias("plugin_id"),
            F.coalesce("_item._pluginName", F.lit("")).alias("plugin_name"),
            F.col("_item._severity").try_cast("smallint").alias("severity"),
            first_of(F.col("_item.cve")).alias("cve"),
        )
        .filter(F.col("plugin_id").isNotNull() & F.col("severity").isNotNull())
    )


def canonical_order(findings: DataFrame) -> DataFrame:
    """Stable output order: host by code point, then check."""
    return findings.orderBy("host", "plugin_id")
