"""Token counts through a digest cache.

Counts are stored under (content digest, tokenizer digest). A run joins its texts'
digests to the store, encodes one text of each digest that is missing, appends what it
found, and gives every row its count from the store.

The only normalisation that is sure to leave a tokenizer's count alone is null to empty;
nothing else is normalised here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, in_pieces, salt_of, spread_join, through_arrow
from driftledger.session import scratch_dir

STORE = "digest string, tokenizer string, n_tokens long"
LIMIT = 4096


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


_COUNTERS: dict[str, Callable[[Sequence[str]], list[int]]] = {}


def counter(path: str) -> Callable[[Sequence[str]], list[int]]:
    """Counts of texts as the vocabulary's own library gives them; loaded once a process."""
    if path not in _COUNTERS:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda texts: [len(model.encode(t, num_threads=1)) for t in texts]
        else:
            from tokenizers import Tokenizer

            fast = Tokenizer.from_file(path)
            fast.no_truncation()
            fast.no_padding()
            _COUNTERS[path] = lambda texts: [len(fast.encode(t, add_special_tokens=False)) for t in texts]
    return _COUNTERS[path]


def encode(misses: DataFrame, path: str, version: str) -> DataFrame:
    """Rows of the store for (digest, whole)."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batch, "whole"):
            found = counter(path)(piece["whole"].to_pylist())
            yield pa.record_batch([piece["digest"], pa.array([version] * len(found), pa.string()), pa.array(found, pa.int64())], names=["digest", "tokenizer", "n_tokens"])

    return through_arrow(misses.select("digest", "whole"), count, STORE)


def token_counts(docs: DataFrame, path: str, store: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, digest.

    ``path`` is a vocabulary every executor has (.json or .model), ``store`` the folder
    of the cache in shared storage: read if it exists, appended to by this call (one
    writer at a time; a digest stored twice by crashed runs counts once). Null texts are
    empty texts, with 0 bytes and the library's count for an empty text. Repeated ids and
    rows each get their row; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    whole = F.coalesce(column(docs, "text"), F.lit(""))
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), whole.alias("whole"))
    rows = rows.select("doc_id", F.sha2(F.col("whole").cast("binary"), 256).alias("digest"), F.octet_length("whole").cast("long").alias("n_bytes"), "whole")
    spark.createDataFrame([], STORE).write.mode("append").parquet(store)
    known = spark.read.schema(STORE).parquet(store).filter(F.col("tokenizer") == version)
    # One text per missing digest, reduced inside the tasks first; digests stand for texts.
    misses = rows.select("digest", "whole").join(known.select("digest"), "digest", "left_anti")
    misses = misses.groupBy("digest").agg(F.first("whole").alias("whole"))
    encode(misses, path, version).write.mode("append").parquet(store)
    counts = spark.read.schema(STORE).parquet(store).filter(F.col("tokenizer") == version)
    counts = counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    out = spread_join(rows.select("doc_id", "digest", "n_bytes", salt_of(F.col("doc_id")).alias("salt")), counts, "digest", "salt")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(documents(spark, sf_dir), path, scratch_dir(spark, "token-store")).drop("digest")
