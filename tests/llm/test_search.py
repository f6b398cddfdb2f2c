"""Ranked search against brute force: every document scored for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import assert_same

from driftledger.llm import search
from driftledger.llm.queries import ORACLES, QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, n long, term string, score int, rank int"
ITEMS = "item_id long, text string, doc_id string"


def found(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top):
    counts = [(i, Counter(found(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in items:
        own = set(found(text))
        df = {t: sum(t in c for _, c in counts) for t in own}
        rows = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own}
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own)
            if score > 0:
                rows.append((-score, doc is None, doc, score))
        out += [(item, k, doc, score) for k, (_, _, doc, score) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["ÄRGER", "Ärger", "日本語", "x\x7fy", "a_b", "3D"]
    texts = [" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    return [(k, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward():
    docs = rows(1, 300)
    docs += [(1000 + k, "w1 W2 w3 w3") for k in range(70)]  # a group of copies: ties beyond any top
    docs += [(2000, None), (2001, ""), (2002, " -- !"), (2003, "w5 " * 30000), (None, "w7 w7"), (None, "w7 w7"), (7, "w9 w9 w9"), (7, "w9 w9 w9")]
    items = [(0, "w1 w2 W3 ärger Ärger"), (1, "w7"), (2, None), (3, "--"), (4, "nowhere at all"), (5, "w9 w9 w30 w31 日本語 a b 3d x y"), (5, "w5"), (None, "w2 w40")]
    return docs, items


@pytest.mark.parametrize("top, most, cells", [(50, 8192, 1 << 22), (3, 6, 512), (400, 1, 64)])
def test_equals_brute_force(spark, awkward, top, most, cells):
    docs, items = awkward
    table = spark.createDataFrame([(*d, 1, "x", 2, 3) for d in docs], DOCS).repartition(3)
    got = search.ranked(table, spark.createDataFrame([(*i, "y") for i in items], ITEMS), top, most, cells)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_empty_tables(spark, awkward):
    docs, items = (spark.createDataFrame(t, s) for t, s in zip(awkward, ("doc_id long, text string", "item_id long, text string")))
    assert search.ranked(docs.limit(0), items).count() == search.ranked(docs, items.limit(0)).count() == 0


def test_tree_bounds_hold():
    """A node's counts and norm are the extremes of its documents, and every document hangs somewhere once."""
    rng = np.random.default_rng(5)
    counts = (rng.random((200, 12)) < 0.4) * rng.integers(1, 5, (200, 12))
    counts[:40] = counts[0]
    m = rng.integers(50, 400, 200)
    counts = counts[counts.any(axis=1)].astype(np.int32)
    m = m[: len(counts)]
    tree = search.Tree(counts, m, np.arange(len(counts)), np.zeros(len(counts), bool))
    assert sorted(tree.ids.tolist()) == list(range(len(counts)))
    owned = np.concatenate([np.arange(a, b) for a, b in zip(tree.first, tree.own_end)])
    assert sorted(owned.tolist()) == list(range(len(counts)))
    for v in range(len(tree.first)):
        inside = slice(tree.first[v], tree.end[v])
        assert (tree.most[v] == tree.counts[inside].max(axis=0)).all() and tree.least[v] == tree.m[inside].min()
    assert len(tree.first) < 2 * len(counts)
    assert max(b - a for a, b in zip(tree.first, tree.own_end)) >= 40  # copies share one node


def test_walk_leaves_out_what_cannot_win(monkeypatch):
    """With few frequent terms most nodes are never opened once the best are found."""
    rng = np.random.default_rng(7)
    counts = (rng.random((3000, 30)) < np.linspace(0.9, 0.01, 30)).astype(np.int32)
    counts[:, 29] = 0
    counts[:5, 29] = 9
    counts = counts[counts.any(axis=1)]
    tree = search.Tree(counts, np.full(len(counts), 100), np.arange(len(counts)), np.zeros(len(counts), bool))
    opened = []
    bounds = tree.bounds
    monkeypatch.setattr(tree, "bounds", lambda nodes, *a: opened.append(len(nodes)) or bounds(nodes, *a))
    best = search.Best(3)
    tree.walk(np.array([0, 29]), np.array([10, 5000]), best)
    assert best.score[0] > 0 and sum(opened) < len(tree.first) / 2


def test_query_equals_sql(spark, sf_dir):
    assert_same(QUERIES["op12_lexical_search"](spark, sf_dir), sf_dir, ORACLES["op12_lexical_search"])
