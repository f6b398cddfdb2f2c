"""The operators on a small table of awkward rows, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from compare import assert_same
from pyspark.sql import functions as F

from driftledger.llm import exact_dedup, language, mixing, packing, quality, rules, simhash, suffixes, token_counts, toxicity
from driftledger.llm.queries import ORACLES, QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, gram int, digest int, salt int"
PROSE = "The old ship left the port at dawn, and nobody saw it return before the long winter. "
LONG = " ".join(f"word{i % 977} of part {i}" for i in range(4000))


def table(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    texts = [PROSE * 3, PROSE * 3, None, "", " \n\t", PROSE + "Another end of this text, quite new.", LONG, LONG + " tail", "a a a a " * 40, "ßÉ 日本語 🙂 " * 9]
    texts += [f"Text number {i} is about {i * 7919 % 101} things that nobody counted so far in {i}." for i in range(30)]
    texts += ["12 34", "x" * 300, "x" * 400, (PROSE * 3).replace(" ", "\n")]
    return [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3 if i < 20 else 0]) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_packing_keeps_every_id(docs, rows, none):
    from tokenizers import Tokenizer

    fast = Tokenizer.from_file(packing.VOCABULARY[0])
    got = packing.pack(docs, *packing.VOCABULARY).collect()
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for i, text, *_ in rows:
        ids = fast.encode(text or "", add_special_tokens=False).ids + [packing.END]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert b"".join(bytes(p.ids) for p in parts) == b"".join(x.to_bytes(4, "little") for x in ids)
        assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in parts)
    for inside in bins.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert packing.pack(none, *packing.VOCABULARY).count() == 0


def test_packing_takes_small_batches(spark, monkeypatch):
    """Two tasks' batches lie beside the heap of an executor that earlier stages have filled."""
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))
    asked, real = [], packing.through_arrow
    monkeypatch.setattr(packing, "through_arrow", lambda df, work, schema, *more: asked.append(more) or real(df, work, schema, *more))
    packing.pieces(docs, *packing.VOCABULARY)
    assert asked and asked[0]

    def sizes(batch):
        yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    found = [r.n for r in real(docs, sizes, "n long", *asked[0]).collect()]
    assert sum(found) > 12_000_000 and max(found) < 5 << 20


def test_best_fit_decreasing_is_the_plain_one():
    counts = {7: 5, 5: 9, 4: 3, 3: 11, 2: 6, 1: 4}
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [i for i, room in enumerate(rooms) if room >= length]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(10 - length)
    placed = packing.best_fit_decreasing(counts, 10)
    assert max(first + n for _, _, n, first, _ in placed) == len(rooms)


def windows_removed(rows, span=50):
    out, seen = {}, {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        strings = [data[k : k + span] for k in range(len(data) - span + 1)]
        gone = bytearray(len(data))
        for k, s in enumerate(strings):
            if seen.setdefault(s, i) < i:
                gone[k : k + span] = b"\1" * span
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return out


def test_suffixes(docs, rows, none):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeats(docs).collect()}
    assert got == windows_removed(rows)
    clashing = suffixes.repeats(docs, marked=lambda piece: len(piece) % 2).collect()  # most pieces of a minimizer look alike
    assert got == {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in clashing}
    assert suffixes.repeats(none).count() == 0


def test_rules_statistics(docs, rows, none):
    got = {r.doc_id: r for r in rules.judged(docs, least_rows=5).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        spans = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        often, covered, lines = Counter(spans), set(), [x for x in (text or "").split("\n") if WORD.search(x)]
        for k, s in enumerate(spans):
            if often[s] > 1:
                covered.update(range(k, k + 8))
        r = got[i]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert tuple(r[f] for f in rules.FIELDS) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.kept and r.base_failed)
    assert rules.judged(none).count() == 0


def test_rules_reject_an_outlier(spark):
    rows = [(i, f"{PROSE}This is row {i} with {'more ' * (i % 5)}words of no weight at all.", "en", "a") for i in range(80)]
    rows.append((80, " ".join(f"w{i}###%%%" for i in range(60)), "en", "a"))
    assert [r.doc_id for r in rules.judged(table(spark, rows)).filter("NOT kept").collect()] == [80]


def test_exact_groups(docs, rows, none):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i))
    want = {(i, min(g)[1], len(g), min(g)[1] == i) for g in groups.values() for _, i in g}
    assert {tuple(r)[:4] for r in exact_dedup.exact_groups(docs).collect()} == want
    # One digest for all texts: only the texts themselves can tell them apart.
    from pyspark.sql import functions as F

    assert {tuple(r)[:4] for r in exact_dedup.exact_groups(docs, lambda text: F.lit("same")).collect()} == want
    assert exact_dedup.exact_groups(none).count() == 0
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == sorted(min(g)[1] for g in groups.values())


@pytest.mark.parametrize("tree", [4096, 3])
def test_simhash_components(docs, rows, none, tree):
    prints = {}
    for i, text, *_ in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]), 42) for k in range(max(1, len(words) - 3))] if words else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    least = {i: i for i in prints}
    for _ in prints:
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    least[i] = least[j] = min(least[i], least[j])
    got = simhash.near_groups(docs, tree=tree).collect()
    assert {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got} == {(i, prints[i], least[i]) for i in prints}
    assert simhash.near_groups(none).count() == 0
    assert sorted(r.doc_id for r in simhash.drop_near(docs).collect()) == sorted(set(least.values()))


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k not in (0, 100)} == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)}


def test_token_counts_and_their_cache(docs, rows, none, tmp_path):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for _ in range(2):
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, path, str(tmp_path / "store")).collect()}
        assert got == {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in rows}
    assert docs.sparkSession.read.parquet(str(tmp_path / "store")).count() == len({t or "" for _, t, *_ in rows})
    assert token_counts.token_counts(none, path, str(tmp_path / "empty")).count() == 0


def test_mixing_is_exact(docs, rows, none):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.taken for r in own) == round(own[0].target)
        assert all(r.taken <= 3 * r["size"] for r in own)
    assert sum(len(WORD.findall(r.text)) for r in mixing.mix(docs).collect()) == sum(r.taken for r in got)
    assert mixing.mixed(none).count() == 0


def test_models_take_any_rows(docs, rows, none):
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    from pyspark.sql import functions as F

    got = toxicity.scored(docs, labels, F.col("doc_id") % 3 > 0, F.col("doc_id") % 3 == 0).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows] and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(none, labels.limit(0), F.lit(True), F.lit(True)).count() == 0
    found = {r.doc_id: r for r in language.identified(docs, docs).collect()}
    assert all((found[i].lang_pred == "und") == (not any(map(str.isalpha, t or ""))) for i, t, *_ in rows)
    assert language.identified(docs, none).filter("lang_pred != 'und'").isEmpty()
    assert quality.scored(docs).count() == len(rows) and quality.scored(none).count() == 0


def test_toxicity_model_equals_brute_force(spark, docs, rows):
    """Discounted pairs over class continuation counts over shared ones, text by text, with words in place of bins."""
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    model = toxicity.learnt(toxicity.counted(docs.join(labels, "doc_id")))
    found = {r.doc_id: r[1:] for r in toxicity.described(docs, spark.sparkContext.broadcast(model)).collect()}
    split = {i: re.findall(r"[^\W\d_]+", (t or "").lower()) for i, t, *_ in rows}
    assert len({w for t in split.values() for w in t}) == len({b for _, t, *_ in rows for b in toxicity.tokens(t)})
    both = {i: list(zip([None] + words, words)) for i, words in split.items()}
    seen = {c: Counter(p for i in both if i % 2 == c for p in set(both[i])) for c in (0, 1)}
    every = set(seen[0]) | set(seen[1])
    follows = Counter(w for _, w in every)

    def discount(counts):
        n1, n2, n3 = (sum(1 for n in counts if n == k) + 1 for k in (1, 2, 3))
        y = n1 / (n1 + 2 * n2)
        d = {0: 0, 1: max(0.1, 1 - 2 * y * n2 / n1), 2: max(0.1, 2 - 3 * y * n3 / n2)}
        return lambda n: d.get(n, 0.1)

    def chance(c):
        own = Counter(w for _, w in seen[c])
        total, low, high = sum(own.values()), discount(own.values()), discount(seen[c].values())
        n, gone = Counter(), Counter()
        for (v, _), k in seen[c].items():
            n[v] += k
            gone[v] += high(k)

        def lower(w):
            return (own[w] - low(own[w])) / total + sum(map(low, own.values())) / total * (follows[w] + 1) / (len(every) + len(follows) + 1)

        def upper(v, w):
            return (seen[c][v, w] - high(seen[c][v, w])) / n[v] + gone[v] / n[v] * lower(w) if n[v] else lower(w)

        assert sum(map(lower, follows)) < 1
        return lower, upper

    (lower0, upper0), (lower1, upper1) = chance(0), chance(1)

    def three(x):
        return (max(x), sum(x) / len(x), math.log1p(sum(max(a - 3, 0) for a in x))) if x else (0, 0, 0)

    for i in both:
        own = [math.log(lower1(w) / lower0(w)) for _, w in both[i]]
        added = [math.log(upper1(v, w) / upper0(v, w)) - o for (v, w), o in zip(both[i], own)]
        assert found[i] == pytest.approx(three(own) + three(added), abs=1e-4)


def test_toxicity_finds_an_expression_of_ordinary_words(spark):
    """Each word is as frequent in either class; only one order of two of them is toxic."""
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("ab", "ed", "in", "or", "ul")]
    rng = np.random.default_rng(5)
    texts = []
    for i in range(600):
        body = [words[k] for k in rng.integers(0, len(words), 30)]
        at = int(rng.integers(0, 28))
        body[at : at + 2] = ["walking", "carpet"] if i % 3 == 0 else ["carpet", "walking"]
        texts.append((i, " ".join(body), int(i % 3 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    from pyspark.sql import functions as F

    fold = F.col("doc_id") % 5
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, docs.select("doc_id", "toxic"), fold < 2, fold == 2).collect()}
    apart = [(t, got[i]) for i, _, t in texts if i % 5 > 2]
    assert sum(t != p for t, p in apart) <= 0.05 * len(apart)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    named = language.op7_language_id(spark, sf_dir).filter("held_out").join(truth, "doc_id")
    assert named.selectExpr("avg(CAST(lang = lang_pred AS double))").first()[0] > 0.98
    kept = quality.op5_quality_classifier(spark, sf_dir).join(labels, "doc_id")
    right = {r[0]: r[1] for r in kept.groupBy("quality").avg("score").collect()}
    assert right[1] > 0.9 > 0.5 > right[0]


def test_toxicity_counts_every_pair(spark):
    """All ordered pairs of 200 words, toxic where their numbers add up to an odd one: texts of
    one class are alike, however many pairs share a value of some hash."""
    texts = [(a * 200 + b, f"{a:o} {b:o}".translate(str.maketrans("01234567", "abcdefgh")), (a + b) % 2) for a in range(200) for b in range(200) if a != b]
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = spark.sparkContext.broadcast(toxicity.learnt(toxicity.counted(docs)))
    found = {0: set(), 1: set()}
    for r in toxicity.described(docs, model).collect():
        found[(r.doc_id // 200 + r.doc_id % 200) % 2].add(tuple(round(x, 4) for x in r[1:]))
    assert [len(found[k]) for k in (0, 1)] == [1, 1] and found[0] != found[1]
