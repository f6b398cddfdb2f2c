"""All five stages over a small table of awkward rows, against a plain computation of each."""

import hashlib
import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash

from driftledger.llm import packing, simhash

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACE = re.compile("[\x20\x09-\x0d]")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest_right int, kept_digest int, salt int"


def prose(rng, words):
    return " ".join("".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 8))) for _ in range(words)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [prose(rng, rng.choice([12, 60, 200, 600])) for _ in range(60)]
    for k in range(12):  # near copies: a word or two of many changed
        words = texts[k].split()
        words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    texts += [texts[3]] * 9 + [texts[4].replace(" ", "  "), texts[5] + "\n"]
    texts += [None, "", " \t", "x" * 4000, "long " * 9000]
    out = [(k, t, ("en", "fr", None)[k % 3], "hot" if k % 3 else ("a", "b", None)[k // 3 % 3]) for k, t in enumerate(texts)]
    out += [(None, prose(rng, 40), "en", "hot"), (None, prose(rng, 40), "en", "a"), (7, prose(rng, 40), "en", "b"), (3, texts[3], "en", "b"), (3, texts[3], "en", "b")]  # whole rows repeated
    return [(*r, len(r[1] or ""), 1, 2, 3) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def key(r):
    return repr(tuple(r))


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def norm(text):
    return SPACE.sub("", text or "")


def exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def fingerprint(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    bits = np.array([[xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for b in range(64)] for s in runs])
    return sum(int(on) << b for b, on in enumerate(2 * bits.sum(axis=0) > len(runs)))


def near(rows):
    fps = [fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[find(k)].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()[:16])) for g in groups.values()]


def mixed(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    size = {s: sum(len(WORD.findall(r[1] or "")) for r in g) for s, g in by.items()}
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, sum(size.values()), set(order)
    while True:  # share again and again
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if level * weight[s] > 3 * size[s]}
        if not full:
            break
        target |= {s: 3.0 * size[s] for s in full}
        left -= sum(3 * size[s] for s in full)
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    out = []
    for s, group in by.items():
        budget = int(target[s] + 0.5)
        epochs, rest = divmod(budget, size[s]) if size[s] else (0, 0)

        def place(r):
            digest = hashlib.md5(("null" if r[0] is None else str(r[0])).encode()).hexdigest()
            return int(digest[:15], 16), r[0] is not None, r[0] or 0, len(WORD.findall(r[1] or ""))

        for r in sorted(group, key=place):
            words = WORD.findall(r[1] or "")
            if not words:
                continue
            out += [r] * epochs
            if rest >= len(words):
                out.append(r)
            elif rest > 0:
                cut = " ".join(words[:rest])
                out.append((r[0], cut, r[2], r[3], len(cut), *r[5:]))
            rest = max(0, rest - len(words))
    return out


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]


def test_quality_stage_keeps_by_its_scores(spark, docs):
    """A row stays if the classifier's score of its own text says so, and unchanged."""
    kept = corpus_pipeline.STAGES[0][1](spark, docs, "")
    assert kept.columns == docs.columns
    got, all_rows = kept.collect(), [tuple(r) for r in docs.collect()]
    assert {key(r) for r in got} <= {key(r) for r in all_rows}
    texts = {r.text for r in got}
    assert all((r[1] in texts) == (key(r) in {key(g) for g in got}) for r in all_rows)  # equal texts, equal fate
    clean = [r for r in all_rows if len((r[1] or "").split()) >= 60 and "long long" not in r[1]]
    assert sum(r[1] in texts for r in clean) >= 0.95 * len(clean)


def test_filtering_stages_equal_brute_force(spark, docs, rows):
    stages = dict(corpus_pipeline.STAGES)
    table, want = docs, rows
    for name, plain in (("exact_dedup", exact), ("simhash_near_dedup", near), ("mixing", mixed)):
        table = corpus_pipeline.staged(stages[name](spark, table, ""), f"test-{name}")
        want = plain(want)
        assert table.columns == docs.columns
        same(table.collect(), want)


def test_packing_stage_packs_what_is_left(spark, docs):
    packed = corpus_pipeline.STAGES[4][1](spark, docs, "").collect()
    assert len({(r.doc_id, r.ids_crc32, r.start) for r in packed}) >= docs.select("doc_id").distinct().count()
    used = defaultdict(list)
    for r in packed:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_stages_of_an_empty_table(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_run_passes_documents_on(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), f"test-{name}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after and after <= ids
        ids = after
        if name != "packing":
            assert docs.columns == columns


def test_near_stage_takes_the_operators_numbers():
    assert (simhash.SHINGLE, simhash.RADIUS) == (4, 4)
