"""Declared schemas of the stored relations."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _H, _D, _T = (
    StringType(),
    IntegerType(),
    LongType(),
    ShortType(),
    DateType(),
    TimestampType(),
)

SCAN_RUN = _schema(scan_run_id=_S, scanned_at=_T, source=_S, ingested_at=_T)

RAW_FINDING = _schema(landing_seq=_L, ingested_at=_T, payload=_S, scan_run_id=_S)

FINDING = _schema(
    scanned_at=_T,
    scan_run_id=_S,
    host=_S,
    plugin_id=_I,
    plugin_name=_S,
    severity=_H,
    cve=_S,
    scan_month=_S,
)

# The commitment register. ``opened_on`` stays NULL for a problem that has only
# been sighted in a scan that was already superseded when it arrived.
REGISTER = _schema(
    host=_S,
    plugin_id=_I,
    first_seen=_T,
    plugin_name=_S,
    severity=_H,
    owner=_S,
    opened_on=_D,
    due_on=_D,
    rom_hours=_H,
    closed_on=_D,
)

# What a reconciliation did to a row: masks of the scans of its delivery, 64 to a word.
REGISTER_MOVES = StructType(
    [*REGISTER.fields, StructField("moves", ArrayType(_schema(transition=_S, word=_I, bits=_L)))]
)

REGISTER_LOG = _schema(
    version=_L, synced_at=_T, scanned_at=_T, opened=_L, reopened=_L, closed=_L
)

PLUGIN = _schema(plugin_id=_I, name=_S, severity=_H)
CONTROL = _schema(control_id=_S, title=_S, family=_S)
PLUGIN_CONTROL = _schema(plugin_id=_I, control_id=_S)
CONTROL_STATUS = _schema(
    export_id=_S, exported_at=_T, control_id=_S, compliance=_S, assessed_by=_S
)

# One scanned host as it appears in an export. Attributes are read as text so
# that malformed rows reach the filter instead of failing or turning NULL.
EXPORT_ITEM = _schema(
    _pluginID=_S, _severity=_S, _pluginName=_S, cve=ArrayType(_S)
)
EXPORT_HOST = StructType(
    [
        StructField("_name", _S),
        StructField(
            "HostProperties",
            ArrayType(_schema(tag=ArrayType(_schema(_name=_S, _VALUE=_S)))),
        ),
        StructField("ReportItem", ArrayType(EXPORT_ITEM)),
    ]
)
