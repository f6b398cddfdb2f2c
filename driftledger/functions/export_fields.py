"""Reading single fields of a scan export leniently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The property tags that carry a host's start time, and the text
# layouts accepted for the human-readable one (a leading weekday is ignored).
EPOCH_TAG = "HOST_START_TIMESTAMP"
TEXT_TAG = "HOST_START"
TEXT_TIME_FORMATS = [
    "MMM d HH:mm:ss yyyy",
    "d MMM yyyy HH:mm:ss",
    "M/d/yyyy HH:mm:ss",
    "M/d/yyyy h:mm:ss a",
    "MMM d, yyyy HH:mm:ss",
]


def has_text(value: Column) -> Column:
    """Neither NULL nor only white space."""
    return F.coalesce(value.rlike(r"(?U)\S"), F.lit(False))


def first_of(values: Column) -> Column:
    return F.get(values, 0)


def tag_value(properties: Column, tag_name: str) -> Column:
    """Value of the first property tag of that name."""
    tags = F.flatten(F.transform(properties, lambda p: F.coalesce(p["tag"], F.array())))
    return first_of(F.filter(tags, lambda t: t["_name"] == tag_name))["_VALUE"]


def loose_timestamp(text: Column) -> Column:
    tidy = F.trim(F.regexp_replace(F.regexp_replace(text, r"^\s*[A-Za-z]{3,9},?\s+(?=[A-Za-z0-9])", ""), r"\s+", " "))
    unprefixed = F.trim(F.regexp_replace(text, r"\s+", " "))
    attempts = [text.try_cast("timestamp")]
    for candidate in (unprefixed, tidy):
        attempts += [F.try_to_timestamp(candidate, F.lit(fmt)) for fmt in TEXT_TIME_FORMATS]
    return F.coalesce(*attempts)


def host_start(properties: Column) -> Column:
    """When a host's scan began: the epoch tag, else the text tag read as UTC."""
    epoch = tag_value(properties, EPOCH_TAG).try_cast("bigint")
    return F.coalesce(F.timestamp_seconds(epoch), loose_timestamp(tag_value(properties, TEXT_TAG)))
