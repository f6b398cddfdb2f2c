"""Ranked lexical search through FP-trees of documents.

Queries are taken in blocks of a bounded number of distinct terms. One pass over the
texts keeps of every document its length and the counts of the block's terms; document
frequencies follow from these. The kept vectors, terms by falling document frequency, are
then inserted into trees, so that documents with the same frequent terms share a path
(paths without a fork are one node). A node knows the largest count of every term and the
smallest length norm below it, and so an upper bound on any score there; each query walks
a tree depth-first, best bound first, and leaves out what cannot reach its best k any more.

Trees are made inside the tasks that read the vectors: nothing is shuffled but each task's
best k per query, which are reduced twice, salted first.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, in_pieces, staged, through_arrow

TOP = 50
#: Distinct terms of one block of queries, and so of what tasks and driver hold of it.
BLOCK_TERMS = 8192
#: Counts (documents times terms) that one tree may hold.
CELLS = 1 << 22
#: Nodes that one step of a walk opens.
STEP = 64
SALTS = 32

#: Bytes of a term as they are, A-Z lowered, and a blank for everything else; letters beyond
#: ASCII are bytes from 0x80 on, so terms of the bytes are terms of the text.
LETTERS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


@dataclass(frozen=True)
class Block:
    """Queries with their terms' numbers; ``vocabulary`` has one entry per distinct term."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, list[int]]]


def blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[Block]:
    """The queries in blocks of at most ``most`` distinct terms (or one query)."""
    vocabulary: dict[bytes, int] = {}
    inside: list[tuple[int | None, list[int]]] = []
    rows = items.select(column(items, "item_id").cast("long").alias("item_id"), column(items, "text").alias("text"))
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        own = sorted(set(terms(row.text)))
        if inside and len(vocabulary) + sum(t not in vocabulary for t in own) > most:
            yield Block(vocabulary, inside)
            vocabulary, inside = {}, []
        inside.append((row.item_id, [vocabulary.setdefault(t, len(vocabulary)) for t in own]))
    if inside:
        yield Block(vocabulary, inside)


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), term and tf (the vocabulary's terms) of every row that has a term."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            ids, sizes, ends, term, tf = [], [], [0], [], []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                words = terms(text)
                if not words:
                    continue
                found = Counter(filter(vocabulary.__contains__, words))
                ids.append(doc_id)
                sizes.append(len(words))
                term += map(vocabulary.__getitem__, found)
                tf += found.values()
                ends.append(len(term))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (term, tf)]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    texts = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    return through_arrow(texts, work, "doc_id long, n long, term array<int>, tf array<int>")


def frequencies(kept: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term; one count per term and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch["term"].flatten().to_numpy(), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["t", "df"])

    parts = kept.select("term").mapInArrow(run, "t int, df long").groupBy("t").agg(F.sum("df").alias("df"))
    df = np.zeros(size, dtype=np.int64)
    for t, n in parts.collect():  # a row per term of the block
        df[t] = n
    return df


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a count is worth under a norm, before the term's weight; grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """FP-tree of documents given as counts[document, term rank]; rank 0 is the most frequent term.

    Documents are sorted by their terms, which lays every subtree's documents side by side:
    a node is a range of them that shares its first ``depth`` terms and no more. Nodes
    come parents first; ``most`` and ``least`` are the largest counts and the smallest norm
    below each. The last ones are the documents' own, one node for equal term sets.
    """

    def __init__(self, counts: np.ndarray, m: np.ndarray, ids: np.ndarray, unknown: np.ndarray):
        rows, ranks = np.nonzero(counts)
        bounds = np.searchsorted(rows, np.arange(len(counts) + 1))
        big = ranks.astype(">u4")
        paths = [big[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.counts, self.m, self.ids, self.unknown = counts[order], m[order], ids[order], unknown[order]
        paths = [paths[i] for i in order]
        shared = [common(a, b) for a, b in zip(paths, paths[1:])]
        # Intervals of equal prefixes, by a stack as for a tree of suffixes.
        nodes: list[list[int]] = []  # first, last + 1, parent

        def node(first: int) -> int:
            nodes.append([first, -1, -1])
            return len(nodes) - 1

        root = node(0)
        stack: list[tuple[int, int]] = [(0, root)]  # depth, node
        for k, path in enumerate(paths):
            if k:
                depth, last = shared[k - 1], -1
                while stack[-1][0] > depth:
                    top, last = stack.pop()
                    nodes[last][1] = k
                    if stack[-1][0] >= depth:
                        nodes[last][2] = stack[-1][1]
                if stack[-1][0] < depth:  # a fork inside the path just left
                    fork = node(nodes[last][0])
                    nodes[last][2] = fork
                    stack.append((depth, fork))
            if stack[-1][0] < len(path) // 4:
                stack.append((len(path) // 4, node(k)))
        while stack:
            _, last = stack.pop()
            nodes[last][1] = len(paths)
            nodes[last][2] = stack[-1][1] if stack else -1
        first, end, parent = np.array(nodes, dtype=np.int64).T
        rank = np.lexsort((-end, first))  # parents before children
        place = np.empty(len(rank), dtype=np.int64)
        place[rank] = np.arange(len(rank))
        self.first, self.end = first[rank], end[rank]
        parent = parent[rank]
        parent[parent >= 0] = place[parent[parent >= 0]]
        kids = np.argsort(parent, kind="stable")
        self.kids, self.below = kids, np.searchsorted(parent[kids], np.arange(len(parent) + 1))
        # Documents that end at a node: those no child covers. They are the first of its range.
        starts = np.full(len(parent), np.iinfo(np.int64).max)
        np.minimum.at(starts, parent[1:], self.first[1:])
        self.own_end = np.minimum(starts, self.end)
        self.most = np.empty((len(parent), counts.shape[1]), dtype=counts.dtype)
        self.least = np.empty(len(parent), dtype=np.int64)
        for v in range(len(parent) - 1, -1, -1):
            a, b = self.first[v], self.own_end[v]
            kids_v = self.kids[self.below[v] : self.below[v + 1]]
            if b > a:
                self.most[v], self.least[v] = self.counts[a:b].max(axis=0), self.m[a:b].min()
                if len(kids_v):
                    np.maximum(self.most[v], self.most[kids_v].max(axis=0), out=self.most[v])
                    self.least[v] = min(self.least[v], self.least[kids_v].min())
            else:
                self.most[v], self.least[v] = self.most[kids_v].max(axis=0), self.least[kids_v].min()

    def walk(self, ranks: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Depth-first from the root: the most promising nodes' children next, the others wait."""
        if not len(ranks):
            return
        waiting = [(np.array([0]), self.bounds(np.array([0]), ranks, weights))]
        while waiting:
            nodes, bound = waiting.pop()
            alive = (bound > 0) & (bound >= best.floor)  # an equal score may win by its id
            if not alive.all():
                nodes, bound = nodes[alive], bound[alive]
            if not len(nodes):
                continue
            if len(nodes) > STEP:
                order = np.argsort(-bound, kind="stable")
                waiting.append((nodes[order[STEP:]], bound[order[STEP:]]))
                nodes = nodes[order[:STEP]]
            own = spans(self.first[nodes], self.own_end[nodes])
            if len(own):
                best.offer((gain(self.counts[np.ix_(own, ranks)].astype(np.int64), self.m[own, None]) * weights).sum(axis=1), self.ids[own], self.unknown[own])
            children = self.kids[spans(self.below[nodes], self.below[nodes + 1])]
            if len(children):
                waiting.append((children, self.bounds(children, ranks, weights)))

    def bounds(self, nodes: np.ndarray, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return (gain(self.most[np.ix_(nodes, ranks)].astype(np.int64), self.least[nodes, None]) * weights).sum(axis=1)


def common(a: bytes, b: bytes) -> int:
    """Terms that two paths share from the root."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 4
    x, y = np.frombuffer(a[:n], dtype=">u4"), np.frombuffer(b[:n], dtype=">u4")
    return int((x != y).argmax())


def spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first ... end - 1, one range after the other."""
    n = end - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Best:
    """The k best (score, id) of one query so far: highest score, then smallest id, null last."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.ids, self.unknown = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def offer(self, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        good = score >= self.floor
        if not good.any():
            return
        score, ids, unknown = np.r_[self.score, score[good]], np.r_[self.ids, ids[good]], np.r_[self.unknown, unknown[good]]
        order = np.lexsort((ids, unknown, -score))[: self.k]
        self.score, self.ids, self.unknown = score[order], ids[order], unknown[order]
        if len(order) == self.k:
            self.floor = int(self.score[-1])


def norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 50 + (50 n N) div L, in integers that cannot overflow for texts of up to 2^40 terms."""
    whole, rest = divmod(50 * n_docs, n_terms)
    if (int(n.max(initial=0)) + 1) * max(rest, 1) < 1 << 62:
        return 50 + n * whole + (n * rest) // n_terms
    return np.array([50 + (50 * int(x) * n_docs) // n_terms for x in n], dtype=np.int64)


def searched(kept: DataFrame, block: Block, n_docs: int, n_terms: int, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """q (the query's place in the block), doc_id, score: every task's best of each query."""
    size = len(block.vocabulary)
    df = frequencies(kept, size)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    by_rank = np.lexsort((np.arange(size), -df))  # falling document frequency
    rank = np.empty(size, dtype=np.int64)
    rank[by_rank] = np.arange(size)
    queries = [np.sort(rank[np.array(own, dtype=np.int64)]) for _, own in block.items]
    weights = [weight[by_rank[q]] for q in queries]
    room = max(8, cells // max(1, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries]
        waiting: list[pa.RecordBatch] = []

        def search(batch: pa.RecordBatch) -> None:
            n = batch["term"].value_lengths().to_numpy()
            counts = np.zeros((batch.num_rows, size), dtype=np.int32)
            counts[np.repeat(np.arange(batch.num_rows), n), rank[batch["term"].flatten().to_numpy()]] = batch["tf"].flatten().to_numpy()
            ids = batch["doc_id"]
            tree = Tree(counts, norms(batch["n"].to_numpy(), n_docs, n_terms), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
            for q, w, b in zip(queries, weights, best):
                tree.walk(q, w, b)

        def full(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            held = sum(b.num_rows for b in waiting)
            if held and held >= least:
                table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                at = 0
                while table.num_rows - at >= least and at < table.num_rows:
                    yield table.slice(at, room)
                    at += room
                waiting = [table.slice(at)] if at < table.num_rows else []

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                for part in full(room):
                    search(part)
        for part in full(1):
            search(part)
        for k, b in enumerate(best):
            if len(b.score):
                ids = pa.array(b.ids, mask=b.unknown)
                yield pa.record_batch([pa.array(np.full(len(b.score), k, np.int32)), ids, pa.array(b.score)], names=["q", "doc_id", "score"])

    return kept.mapInArrow(run, "q int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, most: int = BLOCK_TERMS, cells: int = CELLS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents with a score above 0.

    Null and empty texts, and texts of other characters only, have no terms: such a
    document is in no count and no result, such an item has no rows. Equal scores go by
    ascending doc_id, null ids last; rows that repeat a doc_id rank each for itself. Items
    that repeat an item_id (or have none) each get their own ranking under it. Empty
    tables, of documents or items, give no rows; extra columns are ignored. ``most`` and
    ``cells`` bound memory and change no result.
    """
    spark = docs.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    out: DataFrame | None = None
    for block in blocks(items, most):
        kept = staged(vectors(docs, block.vocabulary), "search-vectors")
        n_docs, n_terms = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs or not block.vocabulary:
            continue
        found = searched(kept.filter(F.size("term") > 0), block, n_docs, n_terms, top, cells)
        best = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)).cast("int")
        found = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(W.partitionBy("q", "salt").orderBy(*best))).filter(F.col("rank") <= top)
        found = found.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(*best))).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(block.items)], "q int, item_id long")
        # Written, so that a block's vectors are searched once whatever becomes of the result.
        part = staged(found.join(names, "q").select("item_id", "rank", "doc_id", "score"), "search-found")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
totals AS (SELECT count(*) AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
tf AS (SELECT row, doc_id, size, term, count(*) AS tf
       FROM (SELECT row, doc_id, len(terms) AS size, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, totals WHERE term IN (SELECT term FROM q) GROUP BY term, n),
scored AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // l))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term), totals GROUP BY item_id, row, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""
