"""Quality classifier from weak labels.

Overlapping heuristics vote bad, good or abstain. How often each votes what in either
class is estimated by expectation-maximisation over the counts of vote patterns, which
cover all documents and of which there are at most 3 ** (number of labellers). The
posteriors then train a hashed linear scorer on character shapes, which also judges texts
on which no heuristic votes.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, fresh, in_pieces, through_arrow

#: Hashed features, and rows that the scorer is fitted on (drawn by hash; votes use all rows).
WIDTH = 2048
FIT_ROWS = 6000
#: Added to the length that a vector is divided by.
SHRINK = 8
#: A document goes from this probability of being bad on.
REJECT = 0.5
BAD, ABSTAIN, GOOD = 0, 1, 2
LABELLERS = ("symbols", "capitals", "exclaims", "repeats", "bars", "prose")


def shape_table() -> bytes:
    table = bytearray(range(256))
    for b in range(256):
        if 0x41 <= b <= 0x5A:
            table[b] = ord("X")
        elif 0x61 <= b <= 0x7A or b >= 0x80:
            table[b] = ord("x")
        elif 0x30 <= b <= 0x39:
            table[b] = ord("9")
        elif b <= 0x20:
            table[b] = 0x20
    return bytes(table)


SHAPES = shape_table()


def repeated(words: list[bytes]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def votes(text: str | None) -> int:
    """The votes of all labellers as digits to base 3; a text without words has only abstentions."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return sum(ABSTAIN * 3**k for k in range(len(LABELLERS)))
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    letters = count[0x41:0x5B].sum() + count[0x61:0x7B].sum() + count[0x80:].sum()
    marks = count[list(b"#*$%&<>")].sum() / n
    capitals = count[0x41:0x5B].sum() / max(1, letters)
    exclaims, bars = count[0x21] / n, count[0x7C] / n
    again = repeated(words) / n
    stops = (count[0x2E] + count[0x2C]) / n
    bad = (marks > 0.5, capitals > 0.6, exclaims > 0.5, again > 0.3, bars > 0.3)
    calm = marks < 0.05 and capitals < 0.3 and exclaims < 0.05 and again < 0.05 and bars < 0.05
    given = [BAD if x else ABSTAIN for x in bad] + [GOOD if calm and stops > 0.02 else ABSTAIN]
    return sum(v * 3**k for k, v in enumerate(given))


def features(text: str | None) -> np.ndarray:
    """Shares of hashed 3-grams of the text's shape (runs taken as one), near unit length, and of repeated words.

    Short texts say little: their vector is shortened, so they stay near the intercept.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(WIDTH, dtype=np.float32)
    shape = np.frombuffer(b" " + data.translate(SHAPES) + b" ", dtype=np.uint8)
    shape = shape[np.r_[True, shape[1:] != shape[:-1]]].astype(np.uint32)
    if len(shape) >= 3:
        h = (shape[:-2] * 961 + shape[1:-1] * 31 + shape[2:]) * np.uint32(2654435761) >> np.uint32(16)
        out += np.bincount(h % (WIDTH - 1), minlength=WIDTH)
        out /= np.linalg.norm(out) + SHRINK
    words = data.split()
    out[WIDTH - 1] = repeated(words) / (len(words) + SHRINK)
    return out


def estimate(patterns: dict[int, int], rounds: int = 100) -> tuple[np.ndarray, dict[int, float]]:
    """Votes' probabilities by class (labeller, class, vote) and each pattern's probability of being bad."""
    keys = np.array(sorted(patterns), dtype=np.int64)
    n = np.array([patterns[k] for k in keys.tolist()], dtype=float)
    digits = keys[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    chance = np.full((len(LABELLERS), 2, 3), 0.0)
    chance[:, 0], chance[:, 1] = (0.3, 0.6, 0.1), (0.01, 0.59, 0.4)  # class 0 is the bad one
    prior = np.array([0.15, 0.85])
    for _ in range(rounds):
        log = np.log(prior) + sum(np.log(chance[k][:, digits[:, k]]).T for k in range(len(LABELLERS)))
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        weight = post * n[:, None]
        prior = (weight.sum(axis=0) + 1) / (n.sum() + 2)
        for k in range(len(LABELLERS)):
            for v in range(3):
                chance[k, :, v] = weight[digits[:, k] == v].sum(axis=0) + 0.5 + (0.5 if v == ABSTAIN else 0)
            chance[k] /= chance[k].sum(axis=1, keepdims=True)
    return chance, dict(zip(keys.tolist(), post[:, 0].tolist()))


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the intercept of a logistic scorer of soft labels (Adam, full batches)."""
    x, y = np.c_[x, np.ones(len(x), dtype=np.float32)].astype(np.float32), y.astype(np.float32)
    w, m, v = np.zeros((3, x.shape[1]), dtype=np.float32)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / max(1, len(y)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray | None:
    """The scorer's weights; None for an empty table."""

    def vote(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            yield pa.record_batch([pa.array([votes(t) for t in part["text"].to_pylist()], pa.int32())], names=["pattern"])

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            texts = part["text"].to_pylist()
            rows = [features(t).astype(np.float16).tobytes() for t in texts]
            yield pa.record_batch([pa.array([votes(t) for t in texts], pa.int32()), pa.array(rows, pa.binary())], names=["pattern", "x"])

    texts = docs.select(column(docs, "text").alias("text"))
    counts = through_arrow(texts, vote, "pattern int").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # 729 rows at most
    patterns = {r["pattern"]: r["n"] for r in counts}
    total = sum(patterns.values())
    if not total:
        return None
    _, bad = estimate(patterns)
    drawn = F.pmod(F.xxhash64(column(docs, "doc_id"), F.octet_length(column(docs, "text")), F.lit("fit")), F.lit(1 << 30))
    sample = docs.filter(drawn < int(min(1.0, fit_rows / total) * (1 << 30))).select(column(docs, "text").alias("text")).limit(2 * fit_rows)
    rows = through_arrow(sample, describe, "pattern int, x binary").collect()
    if not rows:
        return None
    x = np.array([np.frombuffer(r["x"], dtype=np.float16) for r in rows], dtype=np.float32)
    return fit_linear(x, np.array([bad[r["pattern"]] for r in rows]))


def badness(x: np.ndarray, weights: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(float(x @ weights[:-1] + weights[-1]), -30, 30))))


def scored(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1, higher: better), kept.

    Null and empty texts have no features and get the scorer's intercept like any text of
    no shape. Copies of a text score alike. An empty table gives no rows; extra columns are
    ignored.
    """
    weights = learn(docs, fit_rows)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            w = np.zeros(WIDTH + 1) if weights is None else weights
            bad = np.array([badness(features(t), w) for t in part["text"].to_pylist()])
            yield pa.record_batch([part["doc_id"], pa.array(1 - bad), pa.array(bad < REJECT)], names=["doc_id", "score", "kept"])

    return through_arrow(docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text")), score, "doc_id long, score double, kept boolean")


def drop_bad(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, each by its own text, with all their columns."""
    weights = learn(docs, fit_rows)
    if weights is None:
        return docs
    text = fresh(docs.columns, "judged_text")

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, text):
            stays = [bool(badness(features(t), weights) < REJECT) for t in part[text].to_pylist()]
            yield part.filter(pa.array(stays, pa.bool_())).select(list(range(part.num_columns - 1)))

    rows = docs.withColumn(text, column(docs, "text"))
    return through_arrow(rows, keep, docs.schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir))
