"""Scans that keep arriving: the load job as a Structured Streaming sink.

Micro-batches only land rows and facts. Once everything available has landed, the
register is reconciled one time over all of it, in scan-time order, so how the feed was
cut into batches never shows in the register. The fact key makes a re-delivered batch a
no-op. There is no watermark: a late scan still belongs in the facts, and the register
is only ever reconciled against newer scans, so stale data cannot reopen or close.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftledger.functions.identity import DEFAULT_SOURCE
from driftledger.operators import scans
from driftledger.plans.ledger import Ledger, LoadResult
from driftledger.sources.scan_export import FILE_PATTERN

Report = Callable[[LoadResult], None]

FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


class Drain:
    """A stream that lands what is available, then one reconciliation.

    The reconciliation runs in :meth:`awaitTermination`. If the driver is lost before
    it, the next drain over the same ledger makes up for it.
    """

    def __init__(self, query: StreamingQuery, ledger: Ledger, landed: list[int], report: Report | None):
        self.query, self._ledger, self._landed, self._report = query, ledger, landed, report

    def awaitTermination(self) -> None:
        self.query.awaitTermination()
        moves = self._ledger.reconcile()
        if self._report and (self._landed or moves):
            self._report(LoadResult(sum(self._landed), moves))


def watch_exports(
    ledger: Ledger,
    folder: str,
    checkpoint: str,
    fallback: datetime | None = None,
    source: str = DEFAULT_SOURCE,
    max_files: int = 1000,
    report: Report | None = None,
) -> Drain:
    """Load the export files that appeared in ``folder`` since the last run.

    The stream carries file names only; their content is read by the batch
    reader, which also sees files without any host. ``max_files`` bounds one
    micro-batch and with it the list that passes through the driver; the result
    is the same for every value.
    """
    names = (
        ledger.spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", FILE_PATTERN)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select(F.col("path").alias("file"))  # the name as it is, not as a URI
    )

    def store(batch: DataFrame, _batch_id: int) -> int:
        return ledger.store_exports([r.file for r in batch.collect()], fallback, source)

    return _drain(ledger, names, store, checkpoint, report)


def watch_sightings(ledger: Ledger, sightings: DataFrame, checkpoint: str, report: Report | None = None) -> Drain:
    """Load a stream of rows (source, scanned_at, landing_seq, host, plugin_id,
    plugin_name, severity, cve); rows of one source and time are one scan, however
    many micro-batches they arrive in, and a row that comes again replaces itself."""

    def store(batch: DataFrame, _batch_id: int) -> int:
        # The runs are listed first, from two columns, then the rows land: not kept in between.
        return ledger.store(*scans.named(batch), whole=False)

    return _drain(ledger, sightings, store, checkpoint, report)


def _drain(ledger: Ledger, stream: DataFrame, store: Callable[[DataFrame, int], int], checkpoint: str, report: Report | None) -> Drain:
    landed: list[int] = []
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: landed.append(store(batch, batch_id)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return Drain(query, ledger, landed, report)
