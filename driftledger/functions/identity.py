"""Deterministic identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The recorded source of scanner exports, the text form of a scan
# time (seven fractional digits, explicit offset), the month label, and a
# digest's bytes with the order in which a GUID shows them.
DEFAULT_SOURCE = "acas-nessus"
SCAN_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0+00:00'"
MONTH_FORMAT = "yyyy_MM"
DIGEST_BYTES = r"^(..)(..)(..)(..)(..)(..)(..)(..)(....)(.{12})$"
GUID_LAYOUT = "$4$3$2$1-$6$5-$8$7-$9-$10"


def run_id(source: Column, scanned_at: Column) -> Column:
    """The id a scan gets on every delivery: a digest of its source and time."""
    digest = F.md5(F.concat_ws("|", source, F.date_format(scanned_at, SCAN_TIME_FORMAT)))
    return F.regexp_replace(digest, DIGEST_BYTES, GUID_LAYOUT)


def scan_month(scanned_at: Column) -> Column:
    return F.date_format(scanned_at, MONTH_FORMAT)
