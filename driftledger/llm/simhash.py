"""SimHash near-dedup with BK-trees.

Distinct fingerprints are dealt to shards and every shard's fingerprints form a BK-tree:
children hang below a parent on edges numbered by their Hamming distance to it, and a
query at distance d from a node follows only the edges d - radius ... d + radius.

No fingerprint has to see every tree. Cut into ``radius + 2`` blocks of bits, two linked
fingerprints differ in at most ``radius`` blocks and so agree on some two; a shard is the
fingerprints that agree on one pair of blocks. A tree, too, is held only by the tasks that
query it, in place of a broadcast that would grow with the corpus. A shard that is too
large for one tree is several trees, each queried by the whole shard.

A task emits a forest and never pairs: it unites what its trees link and names each
fingerprint's smallest partner. Components of these links come from alternating large-star
and small-star steps over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, fresh, in_pieces, salt_of, spread_join, staged, through_arrow

RADIUS = 4
SHINGLE = 4
#: Fingerprints of one tree; larger shards are several trees.
TREE = 4096
#: Pairs of query and node that one step holds.
FRONTIER = 1 << 20


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``shingle`` words, repeated ones too; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and white space only
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    hashes = hashes.astype(">u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return majority(shingles(text, shingle)) if (text or "").encode("utf-8", "surrogatepass").split() else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            fps = np.array([fingerprint(t) for t in part["text"].to_pylist()], dtype=np.uint64)
            yield pa.record_batch([part["doc_id"], pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return through_arrow(docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text")), work, "doc_id long, fp long")


class Trees:
    """BK-trees of many groups at once, as arrays; the fingerprints of a group are distinct.

    ``first`` and ``last`` bound a node's children, which lie together and are sorted by edge.
    """

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        order = np.arange(len(fp))
        self.fp = fp
        self.edge = np.zeros(len(fp), dtype=np.int64)
        at = group.astype(np.int64)  # the group or node and edge below which an item is still to be placed
        parents, nodes = [], []
        above = np.full(len(fp), -1, dtype=np.int64)
        while len(order):
            rank = np.argsort(at, kind="stable")
            order, at = order[rank], at[rank]
            new = np.r_[True, at[1:] != at[:-1]]
            chosen = order[new]
            nodes.append(chosen)
            parents.append(above[chosen])
            below = chosen[np.cumsum(new) - 1][~new]
            order = order[~new]
            distance = np.bitwise_count(fp[order] ^ fp[below]).astype(np.int64)
            above[order] = below
            self.edge[order] = distance
            at = below * 65 + distance
        child, parent = np.concatenate(nodes), np.concatenate(parents)
        self.roots = child[parent < 0]
        child, parent = child[parent >= 0], parent[parent >= 0]
        rank = np.lexsort((self.edge[child], parent))
        self.children, parent = child[rank], parent[rank]
        self.keys = parent * 65 + self.edge[self.children]

    def find(self, queries: np.ndarray, fps: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) within the radius; ``roots`` has the tree of each query."""
        waiting = [(queries, fps, roots)]
        while waiting:
            query, own, node = waiting.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                waiting += [(query[:half], own[:half], node[:half]), (query[half:], own[half:], node[half:])]
                continue
            distance = np.bitwise_count(own ^ self.fp[node]).astype(np.int64)
            near = distance <= radius
            yield query[near], node[near]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 1), side="left")
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), side="right")
            n = np.maximum(hi - lo, 0)
            total = int(n.sum())
            if total:
                step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                waiting.append((np.repeat(query, n), np.repeat(own, n), self.children[np.repeat(lo, n) + step]))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each a and b; every item points at its set's smallest one after it."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def forest(shard: np.ndarray, tree: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together what lies within the radius; ``tree`` is false for pure queries."""
    values, item = np.unique(fp, return_inverse=True)
    parent = np.arange(len(fp))
    inside = np.flatnonzero(tree)
    trees = Trees(shard[inside], fp[inside])
    of_shard = dict(zip(shard[inside][trees.roots].tolist(), trees.roots.tolist()))
    roots = np.array([of_shard.get(s, -1) for s in shard.tolist()], dtype=np.int64)
    ask = np.flatnonzero(roots >= 0)
    for query, node in trees.find(ask, fp[ask], roots[ask], radius):
        unite(parent, query, inside[node])
    moved = np.flatnonzero(parent != np.arange(len(fp)))
    pairs = np.unique(np.stack([item[moved], item[parent[moved]]]), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    return values[pairs[0]], values[pairs[1]]


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """a, b: links among the distinct ``fp`` whose components are those of all links."""
    blocks = radius + 2
    bounds = [64 * k // blocks for k in range(blocks + 1)]
    parts = [F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND((1 << (hi - lo)) - 1) for lo, hi in zip(bounds, bounds[1:])]
    keys = F.array(*[
        F.shiftleft(parts[i], bounds[j + 1] - bounds[j]).bitwiseOR(parts[j]).bitwiseOR(F.lit(k << 40)) for k, (i, j) in enumerate(combinations(range(blocks), 2))
    ])
    dealt = fps.select("fp", F.explode(keys).alias("key"))
    large = staged(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree), "simhash-large")
    n_trees = F.ceil(F.col("n") / tree).cast("int")
    hot = dealt.withColumn("salt", salt_of(F.col("fp")))
    if large.isEmpty():
        asked = dealt.select("fp", "key", F.lit(0).alias("tree"), F.lit(True).alias("held"))
    else:
        hot = spread_join(hot, large.select("key", n_trees.alias("n_trees")), "key", "salt")
        hot = hot.select("fp", "key", F.pmod(F.xxhash64("fp"), F.col("n_trees")).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("n_trees") - 1)).alias("tree"))
        hot = hot.select("fp", "key", "tree", (F.col("own") == F.col("tree")).alias("held"))
        asked = dealt.join(large, "key", "left_anti").select("fp", "key", F.lit(0).alias("tree"), F.lit(True).alias("held")).unionByName(hot)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Shards are sorted: the last one of a batch may go on in the next.
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (rest["key"] == rest["key"].iloc[-1]) & (rest["tree"] == rest["tree"].iloc[-1])
            yield from one(rest[~last])
            rest = rest[last]
        if rest is not None:
            yield from one(rest)

    def one(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(rows):
            shard = rows.groupby(["key", "tree"], sort=False).ngroup().to_numpy()
            a, b = forest(shard, rows["held"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), radius)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    shards = asked.repartition("key", "tree").sortWithinPartitions("key", "tree")
    return shards.mapInPandas(work, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the smallest node reachable) of every node that has an edge.

    Ends when a round of stars changes nothing, within some log of the longest path.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "components-edges")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = staged(large, "components-large")
        small = star(large)
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(large.groupBy("a").agg(F.min("b").alias("b")))
        after = staged(small.filter("a != b").distinct(), "components-edges")
        if same(after, edges):
            break
        edges = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def star(edges: DataFrame) -> DataFrame:
    """Every edge with the least of ``a`` and its neighbours; hubs are spread."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return spread_join(edges.withColumn("salt", salt_of(F.col("b"))), least, "a", "salt")


def same(one: DataFrame, other: DataFrame) -> bool:
    def sign(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h)).first())

    return sign(one) == sign(other)


def near_groups(docs: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Per row of ``docs``: doc_id, fp, component_id.

    Texts without words (null, empty) have fingerprint 0 and are linked like any other.
    ``component_id`` is the smallest id reachable over links, null ids aside. Rows that
    repeat an id each get their row. An empty table gives no rows; extra columns are ignored.
    """
    rows = staged(fingerprints(docs), "simhash-fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = staged(components(links(nodes.select("fp"), radius, tree)), "simhash-components")
    nodes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = spread_join(nodes.withColumn("salt", salt_of(F.col("fp"))), ids, "root", "salt").select("fp", "component_id")
    return spread_join(rows.withColumn("salt", salt_of(F.col("doc_id"))), nodes, "fp", "salt").select("doc_id", "fp", "component_id")


def text_digest(docs: DataFrame) -> Column:
    """128 bits of the text's SHA-256; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(column(docs, "text"), F.lit("")).cast("binary"), 256), 1, 32))


def keep_firsts(docs: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest id (null last), then the smallest digest.

    ``members`` has doc_id, digest and node of every row, ``roots`` node and root of the
    nodes that are not alone. Of rows that repeat both id and text one is taken.
    """
    id_, digest, kept_digest = fresh(docs.columns, "kept_id"), fresh(docs.columns, "digest"), fresh(docs.columns, "kept_digest")
    members = staged(members.groupBy("node", "doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")), "keep-members")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest", "copies")
    nodes = members.groupBy("node").agg(F.min(rank).alias("first")).join(roots, "node", "left")
    stay = nodes.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    stay = staged(stay.select(F.col("first.doc_id").alias(id_), F.col("first.digest").alias(kept_digest), F.col("first.copies").alias("copies")), "keep-firsts")
    rows = docs.withColumn(digest, text_digest(docs))
    same = column(docs, "doc_id").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(kept_digest))
    kept = rows.join(stay.drop("copies"), same, "left_semi")
    if not stay.filter("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", digest])
    return kept.drop(digest)


def drop_near(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per component (``keep_firsts``).

    Null and empty texts have fingerprint 0 and are one component with what is near it; an
    empty table stays empty.
    """
    rows = docs.withColumn(digest := fresh(docs.columns, "digest"), text_digest(docs))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            fps = np.array([fingerprint(t) for t in part["text"].to_pylist()], dtype=np.uint64)
            yield pa.record_batch([part["doc_id"], part["digest"], pa.array(fps.view(np.int64))], names=["doc_id", "digest", "node"])

    texts = rows.select(column(rows, "doc_id").cast("long").alias("doc_id"), F.col(digest).alias("digest"), column(rows, "text").alias("text"))
    members = staged(through_arrow(texts, work, "doc_id long, digest binary, node long"), "simhash-members")
    roots = staged(components(links(members.select(F.col("node").alias("fp")).distinct(), radius)), "simhash-components")
    return keep_firsts(docs, members, roots)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_groups(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
