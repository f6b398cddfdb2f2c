"""Language identification by nearest centroid.

Texts are unit TF-IDF vectors of hashed character n-grams. Document frequencies cover all
rows that may be learned from; each language's vectors are clustered into several
centroids by spherical k-means on a bounded sample per language. A text takes the language
of the centroid with the largest cosine and is marked rejected where even that one is far.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, held_out, in_pieces, salt_of, staged, through_arrow

WIDTH = 4096
#: Rows per language that centroids are fitted on, centroids per language, rounds of k-means.
FIT_ROWS, CENTROIDS, ROUNDS = 400, 3, 10
#: Smallest cosine of a text that is not marked rejected.
REJECT = 0.15
UNKNOWN = "und"
NO_LETTER = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1-, 2- and 3-grams of letters and single blanks; None without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    codes = np.frombuffer((" " + NO_LETTER.sub(" ", text.lower()) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    two = codes[:-1] * np.uint32(65599) + codes[1:]
    three = two[:-1] * np.uint32(65599) + codes[2:]
    hashed = np.concatenate([codes, two, three]) * np.uint32(2654435761) >> np.uint32(20)
    return np.bincount(hashed, minlength=WIDTH)[:WIDTH]


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-12)


def kmeans(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; starts from the row farthest from those chosen so far, so reruns agree."""
    chosen = [0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    centers = x[chosen]
    for _ in range(rounds):
        own = (x @ centers.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centers[j] for j in range(len(centers))])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers


def learn(train: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, list[str], np.ndarray]:
    """IDF, and a language and a vector per centroid, from (doc_id, text, lang)."""

    def frequencies(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            found = [c for c in map(grams, part["text"].to_pylist()) if c is not None]
            total = np.zeros(WIDTH, dtype=np.int64)
            for c in found:
                total += c > 0
            yield pa.record_batch([pa.array([-1, *range(WIDTH)], pa.int32()), pa.array([len(found), *total.tolist()], pa.int64())], names=["gram", "n"])

    table = through_arrow(train.select("text"), frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # WIDTH + 1 rows
    df = {r["gram"]: r["n"] for r in table}
    n = df.get(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + df.get(g, 0))) + 1 for g in range(WIDTH)])
    key = F.xxhash64("doc_id", F.lit("fit"))
    ids = train.select("lang", key.alias("key"), salt_of(F.col("doc_id")).alias("salt"))
    ids = ids.withColumn("at", F.row_number().over(W.partitionBy("lang", "salt").orderBy("key"))).filter(F.col("at") <= fit_rows)
    ids = ids.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("key"))).filter(F.col("at") <= fit_rows)
    cuts = staged(ids.groupBy("lang").agg(F.max("key").alias("cut")), "language-cuts")
    rows = train.withColumn("key", key).join(cuts, "lang").filter(F.col("key") <= F.col("cut")).select("lang", "key", "text")

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            counts = [grams(t) for t in part["text"].to_pylist()]
            found = [None if c is None else vector(c, idf).astype(np.float16).tobytes() for c in counts]
            yield pa.record_batch([part["lang"], part["key"], pa.array(found, pa.binary())], names=["lang", "key", "x"])

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "x"]).head(2 * fit_rows)  # more only where an id repeats
        x = np.stack([np.frombuffer(b, dtype=np.float16) for b in part["x"]]).astype(np.float32)
        return pd.DataFrame({"lang": part["lang"].iloc[0], "center": [c.tobytes() for c in kmeans(x)]})

    vectors = through_arrow(rows, describe, "lang string, key long, x binary").filter("x is not null")
    centers = sorted(map(tuple, vectors.groupBy("lang").applyInPandas(cluster, "lang string, center binary").collect()))
    return idf, [lang for lang, _ in centers], np.array([np.frombuffer(c, dtype=np.float32) for _, c in centers]).reshape(-1, WIDTH)


def identified(docs: DataFrame, learn_from: DataFrame, fit_rows: int = FIT_ROWS, reject: float = REJECT) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score (the cosine, 0 to 1), rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, as is
    everything when there is nothing to learn from. Ties go to the first language by code
    point. ``learn_from`` rows with null lang teach nothing. Extra columns are ignored.
    """
    train = learn_from.select(column(learn_from, "doc_id").alias("doc_id"), column(learn_from, "text").alias("text"), column(learn_from, "lang").alias("lang"))
    idf, langs, centers = learn(train.filter("lang is not null"), fit_rows)

    def name(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            preds, scores = [], []
            for text in part["text"].to_pylist():
                counts = grams(text) if langs else None
                near = None if counts is None else centers @ vector(counts, idf)
                best = 0 if near is None else int(near.argmax())
                preds.append(UNKNOWN if near is None else langs[best])
                scores.append(0.0 if near is None else min(1.0, max(0.0, float(near[best]))))
            rejected = [p == UNKNOWN or s < reject for p, s in zip(preds, scores)]
            yield pa.record_batch([part["doc_id"], pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    return through_arrow(rows, name, "doc_id long, lang_pred string, score double, rejected boolean")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identified(docs, docs.filter(~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
