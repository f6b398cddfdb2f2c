"""The landing payload: one JSON object per sighting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftledger.schemas import FINDING

# Payload keys, a contract between landing and projection.
PAYLOAD_KEYS = ["host", "plugin_id", "plugin_name", "severity", "cve"]
OPTIONAL_KEYS = {"cve"}


def to_payload(*columns: str | Column) -> Column:
    """Serialise the sighting; an absent cve is written as JSON null."""
    return F.to_json(F.struct(*(columns or PAYLOAD_KEYS)), {"ignoreNullFields": "false"})


def project_payload(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace ``payload`` by typed columns, failing loudly on bad content.

    The object is parsed once into text members (a member may arrive as a number
    or as quoted text) and each is then cast. A member that is missing or does
    not cast fails the job even where ANSI mode is off.
    """
    text_members = ", ".join(f"{key} string" for key in PAYLOAD_KEYS)
    parsed = F.from_json(payload, text_members, {"mode": "FAILFAST"})
    kept = [c for c in landed.columns if c != payload]
    typed = [
        _typed(F.col(f"_parsed.{key}"), key).alias(key) for key in PAYLOAD_KEYS
    ]
    return landed.withColumn("_parsed", parsed).select(*kept, *typed)


def _typed(member: Column, key: str) -> Column:
    value = member.cast(FINDING[key].dataType)
    if key in OPTIONAL_KEYS:
        return value
    complaint = F.raise_error(F.lit(f"payload member {key} is missing or malformed"))
    return F.coalesce(value, complaint.cast(FINDING[key].dataType))
