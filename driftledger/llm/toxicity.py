"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary labelled texts each have a model of a word after the one before it. Pairs
of words are counted by documents and discounted; what the discounts free goes to the class's
continuation counts (how many distinct words a word follows in texts of the class), and what
is discounted there to the shared ones: how many distinct words it follows in either class.
So a rare word or pair has nearly the same probability in both classes, and a word that
comes after many different ones in toxic texts alone has not.

Log-likelihood ratios are compared length-normalised: those of the words by the lower order,
and what the word before adds to them. Of either the largest counts besides, and the sum of
what exceeds STRONG, so that a long text does not drown one insult. A logistic curve, fitted
on labelled rows that the counts do not cover, turns the six into a probability.

Words are counted under a hash of ``WORDS`` values and share counts where they share a value;
what is kept per word goes along with the tasks and has a fixed size. Pairs grow with the
corpus and are all kept, in a table. Texts ask it by chunks: a chunk's distinct pairs go to
the buckets of their hash, the counts come back to the chunk, and its texts are described.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, freed_exchanges, held_out, in_pieces, through_arrow
from driftledger.llm.quality import fit_linear
from driftledger.session import scratch_dir

#: Ratios above this count as strong evidence. Chosen, as the features and the discounts were, by cross-validation on rows not held out.
STRONG = 3.0
#: Labelled rows that the curve is fitted on, drawn by hash; the counts use all their rows.
FIT_ROWS = 20_000
THRESHOLD = 0.3
#: Values of the hash of a word; 24 bytes each in a task, compressed on the way.
WORDS = 1 << 21
#: Buckets of pairs are as many as hold about so many each, and at least as many as these.
PER_BUCKET, LEAST_BUCKETS = 1 << 20, 256
#: Parts of the documents that are described one after the other, so that only one part's exchanges are on disk.
ROUNDS = 3
PAIR = "pair long, toxic long, ordinary long"
#: What comes before a text's first word.
START = WORDS
#: What a count loses at least, so that every context leaves something to the lower order.
LEAST_LOSS = 0.1
TOKEN = re.compile(r"[^\W\d_]+")
CLASSES = ("toxic", "ordinary")
FEATURES = [f"{order}_{what}" for order in ("word", "pair") for what in ("peak", "mean", "strong")]


def tokens(text: str | None) -> list[int]:
    """The bins of a text's words."""
    return [xxhash.xxh64_intdigest(w) & (WORDS - 1) for w in TOKEN.findall((text or "").lower())]


def pairs(words: np.ndarray) -> np.ndarray:
    """Every word with the one before it, as one number."""
    before = np.r_[START, words[:-1]][: len(words)]
    return (before << 32) | words


def mixed(pair: np.ndarray) -> np.ndarray:
    x = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def dealt(pair: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of pairs by bucket, as they stand within one, and where each bucket begins and the last ends."""
    bucket = ((mixed(pair) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def packed(numbers: np.ndarray) -> bytes:
    """Byte by byte, since the high ones are mostly 0."""
    return zlib.compress(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def loosened(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel()


def counted(rows: DataFrame) -> DataFrame:
    """pair, toxic, ordinary: documents of each class that hold the pair."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            by_text = [np.unique(pairs(np.array(tokens(t), dtype=np.int64))) for t in part["text"].to_pylist()]
            toxic = np.repeat(part["toxic"].to_numpy() == 1, [len(p) for p in by_text])
            found, which = np.unique(np.concatenate(by_text), return_inverse=True)
            n = [np.bincount(which[chosen], minlength=len(found)) for chosen in (toxic, ~toxic)]
            yield pa.record_batch([pa.array(found, pa.int64()), *[pa.array(c, pa.int64()) for c in n]], names=["pair", *CLASSES])

    table = through_arrow(rows.select("text", "toxic"), count, PAIR)
    return table.groupBy("pair").agg(*[F.sum(c).alias(c) for c in CLASSES])


def discounts(n1: int, n2: int, n3: int) -> tuple[float, float, float]:
    """What a count of one, of two and of more loses, from how many counts are 1, 2 and 3.

    Larger counts lose LEAST_LOSS alone: a word that three others precede is no accident.
    """
    n1, n2, n3 = n1 + 1, n2 + 1, n3 + 1
    rate = n1 / (n1 + 2 * n2)
    return max(LEAST_LOSS, 1 - 2 * rate * n2 / n1), max(LEAST_LOSS, 2 - 3 * rate * n3 / n2), LEAST_LOSS


@dataclass(frozen=True)
class Model:
    """Per class: a word's probability by the lower order; of the word before one over its count
    and the share freed by discounts; the discounts of a pair's count. ``pairs`` is the folder of
    all counts, ``buckets`` how many parts they are looked up in."""

    word: tuple[np.ndarray, np.ndarray]
    per: tuple[np.ndarray, np.ndarray]
    freed: tuple[np.ndarray, np.ndarray]
    lost: tuple[tuple[float, float, float], ...]
    pairs: str
    buckets: int

    def __reduce__(self) -> tuple:
        """Compressed: most of it is empty until the corpus is large."""
        return unpacked, (zlib.compress(pickle.dumps((self.word, self.per, self.freed, self.lost, self.pairs, self.buckets)), 1),)

    def ratios(self, words: np.ndarray, before: np.ndarray, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """By the lower order, and what the word before adds, by the pairs' counts per class."""
        logs, lower = [], []
        for k, n in enumerate(counts):
            p = self.word[k][words].astype(np.float64)
            lower.append(np.log(p))
            kept = (n - np.select([n == 1, n == 2, n > 2], self.lost[k], 0.0)).astype(np.float32)
            logs.append(np.log(kept.astype(np.float64) * self.per[k][before] + self.freed[k][before] * p))
        own = lower[0] - lower[1]
        return own, logs[0] - logs[1] - own


def unpacked(data: bytes) -> Model:
    return Model(*pickle.loads(zlib.decompress(data)))


def learnt(counts: DataFrame) -> Model | None:
    """The model of ``counted`` pairs, which are staged for it; None if a class has none. What
    reaches the driver is bounded by WORDS."""
    place = scratch_dir(counts.sparkSession, "toxicity-pairs")
    with freed_exchanges(counts.sparkSession):
        counts.write.parquet(place)
    counts = counts.sparkSession.read.schema(PAIR).parquet(place)
    before, word = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    of = counts.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c) == k).alias(f"{c}{k}") for c in CLASSES for k in (1, 2, 3)], *[F.max(c).alias(c) for c in CLASSES]).first()
    if not of.toxic or not of.ordinary:
        return None
    lost = {c: discounts(*[of[f"{c}{k}"] for k in (1, 2, 3)]) for c in CLASSES}
    loss = {c: F.when(F.col(c) == 1, lost[c][0]).when(F.col(c) == 2, lost[c][1]).when(F.col(c) > 2, lost[c][2]).otherwise(0.0) for c in CLASSES}

    follows = counts.groupBy(word.cast("int").alias("word")).agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(c) > 0).alias(c) for c in CLASSES]).toArrow()
    at, n_all = follows["word"].to_numpy(), follows["all"].to_numpy()
    shared = np.full(WORDS, 1.0)
    shared[at] += n_all
    shared /= n_all.sum() + len(n_all) + 1
    lower = []
    for c in CLASSES:
        n = follows[c].to_numpy()
        d = discounts(*[int((n == k).sum()) for k in (1, 2, 3)])
        gone = np.select([n == 1, n == 2, n > 2], d, 0.0)
        p = gone.sum() / n.sum() * shared
        p[at] += (n - gone) / n.sum()
        lower.append(p.astype(np.float32))

    contexts = counts.groupBy(before.cast("int").alias("before")).agg(*[f(x).alias(f"{k}_{c}") for c in CLASSES for k, f, x in (("n", F.sum, F.col(c)), ("gone", F.sum, loss[c]))])
    contexts = contexts.select("before", *[x.cast("float").alias(f"{k}_{c}") for c in CLASSES for k, x in (("per", F.coalesce(F.try_divide(F.lit(1.0), f"n_{c}"), F.lit(0.0))), ("freed", F.coalesce(F.try_divide(f"gone_{c}", f"n_{c}"), F.lit(1.0))))]).toArrow()
    per, freed = ([np.full(WORDS + 1, empty, dtype=np.float32) for _ in CLASSES] for empty in (0, 1))
    for k, c in enumerate(CLASSES):
        per[k][contexts["before"].to_numpy()] = contexts[f"per_{c}"].to_numpy()
        freed[k][contexts["before"].to_numpy()] = contexts[f"freed_{c}"].to_numpy()
    return Model(tuple(lower), tuple(per), tuple(freed), tuple(lost[c] for c in CLASSES), place, max(LEAST_BUCKETS, -(-of.n // PER_BUCKET)))


def summary(ratios: np.ndarray) -> tuple[float, float, float]:
    """The largest, the mean, log of what exceeds STRONG."""
    if not len(ratios):
        return 0.0, 0.0, 0.0
    return float(ratios.max()), float(ratios.mean()), float(np.log1p(np.maximum(ratios - STRONG, 0).sum()))


def chunked(rows: DataFrame) -> DataFrame:
    """chunk (a digest of what it holds), doc_ids, lengths and words of some texts a row."""

    def chunk(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            by_text = [np.array(tokens(t), dtype=np.int32) for t in part["text"].to_pylist()]
            words, lengths, ids = np.concatenate(by_text), [len(w) for w in by_text], part["doc_id"].to_pylist()
            digest = xxhash.xxh3_64_intdigest(pickle.dumps((ids, lengths)) + words.tobytes()) - (1 << 63)
            columns = [[digest], pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), [zlib.compress(words.tobytes(), 1)]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["chunk", "doc_ids", "lengths", "words"])

    return through_arrow(rows.select("doc_id", "text"), chunk, "chunk long, doc_ids array<long>, lengths array<int>, words binary")


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's words, the same with the one before each, and the bounds of its texts."""
    words = np.frombuffer(zlib.decompress(row["words"]), dtype=np.int32).astype(np.int64)
    bounds = np.r_[0, np.cumsum(row["lengths"], dtype=np.int64)]
    both = pairs(words)
    starts = bounds[:-1][np.diff(bounds) > 0]
    both[starts] = (START << 32) | words[starts]
    return words, both, bounds


def asked(chunks: DataFrame, buckets: int) -> DataFrame:
    """bucket, chunk, pairs, toxic, ordinary: the distinct pairs of each chunk by bucket, without counts."""

    def ask(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            found = np.unique(opened(row)[1])
            order, at = dealt(found, buckets)
            some = [b for b in range(buckets) if at[b] < at[b + 1]]
            blobs = [packed(np.diff(found[order[at[b] : at[b + 1]]], prepend=0)) for b in some]
            empty = pa.nulls(len(some), pa.binary())
            yield pa.record_batch([pa.array(some, pa.int32()), pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(blobs, pa.binary()), empty, empty], names=["bucket", "chunk", "pairs", *CLASSES])

    return through_arrow(chunks, ask, "bucket int, chunk long, pairs binary, toxic binary, ordinary binary")


def kept_pairs(counts: DataFrame, buckets: int, most: int = 1 << 20) -> DataFrame:
    """The same columns without a chunk: the counted pairs by bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= most:
                yield of(held)
                held = []
        if held:
            yield of(held)

    def of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        pair, *n = (np.concatenate([b[c].to_numpy() for b in held]) for c in ("pair", *CLASSES))
        rising = np.argsort(pair)
        order, at = dealt(pair[rising], buckets)
        order = rising[order]
        some = [b for b in range(buckets) if at[b] < at[b + 1]]
        places = [order[at[b] : at[b + 1]] for b in some]
        blobs = [[packed(np.diff(pair[i], prepend=0)) for i in places], *[[packed(c[i]) for i in places] for c in n]]
        return pa.record_batch([pa.array(some, pa.int32()), pa.nulls(len(some), pa.int64()), *[pa.array(b, pa.binary()) for b in blobs]], names=["bucket", "chunk", "pairs", *CLASSES])

    return counts.mapInArrow(deal, "bucket int, chunk long, pairs binary, toxic binary, ordinary binary")


def answered(table: pa.Table) -> pa.Table:
    """What one bucket's pairs count, for every chunk that asks, in the order of its asking."""
    kept, asking = table.filter(table["chunk"].is_null()), table.filter(table["chunk"].is_valid())
    none = [np.zeros(0, dtype=np.int64)]
    pair = np.concatenate([loosened(x).cumsum() for x in kept["pairs"].to_pylist()] + none)
    order = np.argsort(pair)
    pair = np.r_[pair[order], -1]  # nothing is -1: a place for what is larger than all
    n = [np.r_[np.concatenate([loosened(x) for x in kept[c].to_pylist()] + none)[order], 0] for c in CLASSES]
    blobs = []
    for data in asking["pairs"]:
        wanted = loosened(data.as_py()).cumsum()
        at = np.searchsorted(pair[:-1], wanted)
        there = pair[at] == wanted
        blobs.append([packed(np.where(there, c[at], 0)) for c in n])
    columns = [pa.array([b[k] for b in blobs], pa.binary()) for k in range(2)]
    return pa.table([asking["chunk"], asking["bucket"], *columns], names=["chunk", "bucket", *CLASSES])


def described(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id and FEATURES of every row of (doc_id, text), by a broadcast model (or None)."""
    model = shared.value
    if model is None:
        return rows.select("doc_id", *[F.lit(0.0).alias(f) for f in FEATURES])
    buckets, place = model.buckets, model.pairs

    def describe(chunks: pa.Table, replies: pa.Table) -> pa.Table:
        parts = {r["bucket"]: r for r in replies.to_pylist()}
        ids, found = [], []
        for row in chunks.to_pylist():
            words, both, bounds = opened(row)
            distinct, which = np.unique(both, return_inverse=True)
            order, at = dealt(distinct, buckets)
            n = [np.zeros(len(distinct), dtype=np.int64) for _ in CLASSES]
            for b in range(buckets):
                if at[b] < at[b + 1]:
                    for k, c in enumerate(CLASSES):
                        n[k][order[at[b] : at[b + 1]]] = loosened(parts[b][c])
            own, added = shared.value.ratios(words, both >> 32, [c[which] for c in n])
            ids += row["doc_ids"]
            found += [summary(own[i:j]) + summary(added[i:j]) for i, j in zip(bounds, bounds[1:])]
        values = np.array(found, dtype=np.float64).reshape(-1, len(FEATURES)).T
        return pa.table([pa.array(ids, pa.int64()), *map(pa.array, values)], names=["doc_id", *FEATURES])

    chunks = chunked(rows).repartition("chunk")  # both uses read one exchange
    table = kept_pairs(rows.sparkSession.read.schema(PAIR).parquet(place), buckets)
    replies = asked(chunks, buckets).unionByName(table).groupBy("bucket").applyInArrow(answered, "chunk long, bucket int, toxic binary, ordinary binary")
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(describe, schema)


def scored(docs: DataFrame, labels: DataFrame, counts_from: Column, curve_from: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1), predicted.

    ``counts_from`` and ``curve_from`` say of ``doc_id`` which labelled rows the counts and
    the curve may learn from. Labels that repeat an id count as toxic if one of them does;
    null labels teach nothing. Null, empty and wordless texts get the curve's value for no
    evidence; without toxic and ordinary labelled text every score is 0. Every row
    comes out once, repeated rows each; for the curve, rows that repeat an id count as one
    with their mean. An empty table gives no rows.
    """
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels grow with the corpus: always joined by shuffling, so that small inputs take the same way.
    texts = rows.filter(counts_from).hint("merge").join(known.filter(counts_from), "doc_id")
    model = learnt(counted(texts))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, lot = scratch_dir(docs.sparkSession, "toxicity-features"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for i in range(ROUNDS):
        with freed_exchanges(docs.sparkSession):
            described(rows.filter(lot == i), shared).write.mode("append").parquet(place)
    out = docs.sparkSession.read.parquet(place)
    n = known.filter(curve_from).count()
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(1 << 30)) < int(min(1.0, fit_rows / max(1, n)) * (1 << 30))
    chosen = known.filter(curve_from & drawn)  # about fit_rows ids: small enough to go to the rows
    fit = out.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), *[F.avg(c).alias(c) for c in FEATURES])
    found = fit.select("toxic", *FEATURES).collect()
    x = np.array([r[1:] for r in found], dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array([r[0] == 1 for r in found], dtype=np.float64)
    middle, spread = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    w = fit_linear((x - middle) / spread, y, 500, 0.1) if model and 0 < y.sum() < len(y) else None
    if w is None:
        score = F.lit(0.0)
    else:
        z = F.lit(float(w[-1])) + sum((F.col(c) - float(middle[k])) / float(spread[k]) * float(w[k]) for k, c in enumerate(FEATURES))
        score = 1 / (1 + F.exp(-z))
    return out.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = scored(documents(spark, sf_dir), labels, fold.isin(0, 1), fold == 3)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
