"""What is published: one file that every reader resolves first.

Every stored row carries the number of the load that wrote it. A manifest names the loads
that count (all up to ``watermark`` but the ``hidden`` ones, which died or still wait for a
reconciliation), the version of each register bucket, and where a compaction has replaced a
month's earlier loads. Writing the next manifest, a small file that is renamed into its
place, is the one step that publishes anything: before it readers see all of the old state,
after it all of the new.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger import storage

#: What Spark reads of the published manifests: the moves per scan, over time.
LOG = "version long, synced_at long, moves array<struct<at:long,opened:long,reopened:long,closed:long>>"
MOVED = ("at", "opened", "reopened", "closed")


@dataclass(frozen=True)
class Manifest:
    """``synced_at``: the scan time (microseconds) the register stands at. ``buckets``:
    bucket -> version that holds it. ``floors``: "table/month" -> the compaction that
    replaced what earlier loads wrote there. ``moves``: what the reconciliation that
    published this did, per scan. ``checked``: the load and the version up to which
    constraint violations are kept."""

    version: int = 0
    watermark: int = 0
    hidden: tuple[int, ...] = ()
    synced_at: int | None = None
    buckets: dict[int, int] = field(default_factory=dict)
    floors: dict[str, int] = field(default_factory=dict)
    moves: tuple[tuple[int, int, int, int], ...] = ()
    checked: tuple[int, int] = (0, 0)

    def has(self, load_seq: int) -> bool:
        return load_seq <= self.watermark and load_seq not in self.hidden

    def visible(self, table: str, months: bool = False) -> Column:
        """Whether a stored row of ``table`` counts; over partition columns, so it prunes."""
        seq = F.col("load_seq")
        shown = seq <= self.watermark
        if self.hidden:
            shown &= ~seq.isin(list(self.hidden))
        floors = {place.split("/")[1]: n for place, n in self.floors.items() if place.startswith(f"{table}/")}
        if months and floors:
            known = F.create_map(*[F.lit(x) for pair in sorted(floors.items()) for x in pair])
            shown &= seq >= F.coalesce(F.try_element_at(known, F.col("scan_month")), F.lit(0))
        return shown

    def next(self, begun: Iterable[int], included: Iterable[int], **changes) -> Manifest:
        """The manifest after this one, with the ``included`` loads published as well."""
        begun, included = set(begun), set(included)
        return replace(
            self,
            version=self.version + 1,
            watermark=max({self.watermark} | begun | included),
            hidden=tuple(sorted((set(self.hidden) | {n for n in begun if n > self.watermark}) - included)),
            **{"moves": (), **changes},
        )


def log(spark: SparkSession, folder: str) -> DataFrame:
    """The published manifests as rows of ``LOG``."""
    if not storage.names(spark, folder):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).option("pathGlobFilter", "*.json").json(folder)


def newest(spark: SparkSession, folder: str, n: int = 1) -> list[Manifest]:
    """The ``n`` last published manifests, newest first. Names sort by version."""
    published = sorted(name for name in storage.names(spark, folder) if name.endswith(".json"))
    return [_parse(storage.read_text(spark, f"{folder}/{name}")) for name in published[: -n - 1 : -1]]


def _parse(text: str) -> Manifest:
    m = json.loads(text)
    return Manifest(
        m["version"],
        m["watermark"],
        tuple(m["hidden"]),
        m["synced_at"],
        {int(bucket): version for bucket, version in m["buckets"].items()},
        m["floors"],
        tuple(tuple(move[k] for k in MOVED) for move in m["moves"]),
        tuple(m["checked"]),
    )


def publish(spark: SparkSession, folder: str, m: Manifest) -> None:
    row = asdict(m) | {"moves": [dict(zip(MOVED, move)) for move in m.moves]}
    storage.make(spark, folder)
    storage.write_text(spark, f"{folder}/{m.version:012d}.json", json.dumps(row))
