"""Null and repeated ids: every row is judged by its own text."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftledger.llm import quality, simhash, suffixes, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA)


def sentence(r, n):
    return " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(3, 8))) for _ in range(n))


def test_toxicity_gives_each_row_its_own(spark):
    rows = [(1, "one two three"), (1, "one two three"), (1, "four"), (2, None), (2, ""), (None, "one"), (None, "one"), (None, None), (3, "five one")]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    model = spark.sparkContext.broadcast(toxicity.learnt(toxicity.counted(docs.join(labels, "doc_id"))))
    found = Counter((r.doc_id, *[round(x, 5) for x in r[1:]]) for r in toxicity.described(docs.select("doc_id", "text"), model).collect())
    assert sum(found.values()) == len(rows) and Counter(k[0] for k in found.elements()) == Counter(i for i, _ in rows)
    by_text = {t: k for t in ("one", "four") for k in [toxicity.described(table(spark, [(9, t)]), model).first()]}
    assert found[(None, *[round(x, 5) for x in by_text["one"][1:]])] == 2 and found[(1, *[round(x, 5) for x in by_text["four"][1:]])] == 1
    assert found[(2, *[0.0] * 6)] == 2 and found[(None, *[0.0] * 6)] == 1


def removed(rows, span=50):
    """Brute force: a null id is one id beyond all others."""
    of = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    seen, out = {}, []
    for i, (_, text) in zip(of, rows):
        data = (text or "").encode()
        for k in range(len(data) - span + 1):
            seen[data[k : k + span]] = min(i, seen.get(data[k : k + span], i))
    for i, (own, text) in zip(of, rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - span + 1):
            if seen[data[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        out.append((own, len(data), sum(gone), hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()))
    return Counter(out)


def test_suffixes_of_the_largest_id(spark):
    r = random.Random(12)
    shared = sentence(r, 30)
    most = (1 << 63) - 1
    rows = [(1, shared), (most, "its own " + shared), (None, "null " + shared + " end"), (most, sentence(r, 20))]
    got = Counter((x.doc_id, x.n_bytes, x.n_removed) for x in suffixes.repeats(table(spark, rows)).collect())
    assert {k[0] for k in got} == {1, most, None} and sum(got.values()) == 4
    lost = {k[0]: k[2] for k in got if k[2]}
    assert set(lost) == {most, None} and all(n >= len(shared) for n in lost.values())


def test_a_collision_takes_another_base(monkeypatch):
    """With a base of 1 every permutation of a string collides: the order is made again."""
    import numpy as np

    r = random.Random(3)
    core = b"x" * 18
    pieces = [bytes(r.choices(b"ab", k=32)) + core + bytes(r.choices(b"ab", k=32)) for _ in range(40)]
    pieces += [pieces[k][:20] + p[20:] for k, p in enumerate(pieces[5:12])] + pieces[:3]
    group, ahead = np.zeros(len(pieces), np.int64), np.full(len(pieces), 32)
    docs = np.arange(len(pieces))
    want = suffixes.repeated_starts(group, docs, ahead, pieces)
    real, tried = suffixes.bases, []
    monkeypatch.setattr(suffixes, "bases", lambda k: tried.append(k) or (np.uint64(1) if k == 0 else real(k)))
    assert (suffixes.repeated_starts(group, docs, ahead, pieces) == want).all() and tried == [0, 1]
    for i, p in enumerate(pieces):
        brute = [any(p[k : k + 50] == q[k : k + 50] for q in pieces[:i]) for k in range(len(p) - 49)]
        assert [bool(want[i] >> k & 1) for k in range(len(p) - 49)] == brute


def test_only_starts_that_may_repeat_are_sorted(monkeypatch):
    """A frequent string in many different surroundings: the sort gets its few repeats, not every start."""
    import numpy as np

    r = random.Random(14)
    pieces = [bytes(r.choices(b"abcdefgh", k=32)) + b"x" * 18 + bytes(r.choices(b"abcdefgh", k=32)) for _ in range(400)]
    pieces += [bytes(r.choices(b"abcdefgh", k=10)) + pieces[k][10:] for k in (3, 5)] + pieces[7:8]
    docs = np.array(r.sample(range(1000), len(pieces)))
    sorted_, real = [], suffixes.in_order
    monkeypatch.setattr(suffixes, "in_order", lambda codes, at, segment, span: sorted_.append(len(at)) or real(codes, at, segment, span))
    mask = suffixes.repeated_starts(np.zeros(len(pieces), np.int64), docs, np.full(len(pieces), 32), pieces)
    least = {}
    for d, p in zip(docs, pieces):
        for k in range(len(p) - 49):
            least[k, p[k : k + 50]] = min(d, least.get((k, p[k : k + 50]), d))
    assert mask.tolist() == [sum(1 << k for k in range(len(p) - 49) if least[k, p[k : k + 50]] < d) for d, p in zip(docs, pieces)] and mask.any()
    assert sum(sorted_) < sum(len(p) - 49 for p in pieces) / 4


def test_equal_strings_of_many_pieces_are_sorted_once(monkeypatch):
    """The end of a frequent line before many different texts: the sort gets its few different strings, not every copy."""
    import numpy as np

    r = random.Random(16)
    line = bytes(r.choices(b"abcdefgh", k=64))
    pieces = [line[-49 - r.randint(1, 15) :] + bytes(r.choices(b"ab", k=r.randint(1, 6)) + r.choices(b"abcdefgh", k=12)) for _ in range(600)]
    docs = np.array(r.sample(range(1000), len(pieces)))
    ahead = np.array([min(len(p), p.index(line[-20:])) for p in pieces])
    sorted_, real = [], suffixes.in_order
    monkeypatch.setattr(suffixes, "in_order", lambda codes, at, segment, span: sorted_.append(len(at)) or real(codes, at, segment, span))
    mask = suffixes.repeated_starts(np.zeros(len(pieces), np.int64), docs, ahead, pieces)
    least = {}
    for d, a, p in zip(docs, ahead, pieces):
        for k in range(len(p) - 49):
            least[a - k, p[k : k + 50]] = min(d, least.get((a - k, p[k : k + 50]), d))
    want = [sum(1 << k for k in range(len(p) - 49) if least[a - k, p[k : k + 50]] < d) for d, a, p in zip(docs, ahead, pieces)]
    assert mask.tolist() == want and sum(x.bit_count() for x in want) > 5000
    assert 0 < sum(sorted_) < len(pieces)
    asked, whole = [], suffixes.repeats_of_smaller
    monkeypatch.setattr(suffixes, "repeats_of_smaller", lambda data, at, *more: asked.append(len(at)) or whole(data, at, *more))
    monkeypatch.setattr(suffixes, "MOST_STARTS", 1000)  # a group of more is compared one distance after the other
    assert suffixes.repeated_starts(np.zeros(len(pieces), np.int64), docs, ahead, pieces).tolist() == want
    assert sum(asked) == sum(len(p) - 49 for p in pieces) and max(asked) <= len(pieces)


def test_sides_of_equal_strings_are_equal():
    r = random.Random(17)
    core = bytes(r.choices(b"abcd", k=400))
    texts = [bytes(r.choices(b"abcd", k=r.randint(0, 70))) + core[a : a + r.randint(20, 300)] + bytes(r.choices(b"ab", k=r.randint(0, 70))) for a in range(0, 300, 9)]
    side_of, n_starts = {}, 0
    for i, _, start, n, ahead, n_far, far, near in zip(*(x.tolist() for x in suffixes.sided_pieces(texts))):
        assert 0 <= n_far <= n and all((ahead - k >= 16) == (k < n_far) for k in range(n))
        for k in range(n):
            n_starts += 1
            side = far if k < n_far else near
            assert side_of.setdefault(texts[i][start + k : start + k + 50], side) == side
    assert n_starts == sum(max(0, len(t) - 49) for t in texts) and len(set(side_of.values())) > 100


def test_pieces_that_share_their_minimizer_alone_are_not_compared(spark, monkeypatch):
    """Very many texts have short strings in common; what goes on are the parts that may repeat a whole span."""
    r = random.Random(18)
    common, passage = sentence(r, 9)[:24], sentence(r, 40)
    rows = [(i, sentence(r, 12) + common + sentence(r, 12)) for i in range(60)] + [(100 + i, sentence(r, 12) + passage) for i in range(3)]
    compared, real = {}, suffixes.written
    monkeypatch.setattr(suffixes, "written", lambda df, purpose, *more: compared.setdefault(purpose, real(df, purpose, *more)))
    got = Counter((x.doc_id, x.n_bytes, x.n_removed, x.kept_sha256) for x in suffixes.repeats(table(spark, rows)).collect())
    assert got == removed(rows) and sum(n > 0 for _, _, n, _ in got) == 2
    assert {x.id for x in compared["suffix-pieces"].collect()} == {100, 101, 102}


def test_texts_cut_together_are_cut_as_alone():
    r = random.Random(15)
    texts = [bytes(r.choices(b"ab", k=r.choice([0, 0, 1, 17, 49, 50, 51, 90, 400]))) for _ in range(300)] + [b"a" * 70_000, b"", b"b" * 60]
    owner, *together = (x.tolist() for x in suffixes.pieces_of_all(texts))
    alone = [(i, *p) for i, t in enumerate(texts) for p in zip(*(x.tolist() for x in suffixes.pieces_of(t)))]
    assert list(zip(owner, *together)) == alone
    for i, gram, start, n, ahead in alone:
        assert start + n + 49 <= len(texts[i])
        for k in range(start, start + n):  # the minimizer is the leftmost of the smallest in the window
            hashes = [int(h) >> 32 for h in suffixes.mixed(suffixes.gram_hashes(suffixes.np.frombuffer(texts[i][k : k + 50], "u1").astype("u8") + suffixes.np.uint64(1)))]
            assert k + hashes.index(min(hashes)) == start + ahead and min(hashes) == (gram & (1 << 64) - 1) >> 32
        if start > 1000:
            break


def test_suffixes_of_null_and_repeated_ids(spark):
    r = random.Random(4)
    one, two, three = (sentence(r, 30) for _ in range(3))
    rows = [
        (1, one + " end"), (2, two), (None, "short " + one), (None, sentence(r, 200) + " " + two), (None, "short " + one),
        (7, sentence(r, 5) + one), (7, sentence(r, 90) + three), (7, three), (7, three), (8, sentence(r, 3) + three), (9, None),
    ]
    got = Counter((x.doc_id, x.n_bytes, x.n_removed, x.kept_sha256) for x in suffixes.repeats(table(spark, rows)).collect())
    assert got == removed(rows)


def test_near_rows_of_null_and_repeated_ids(spark):
    r = random.Random(5)
    texts = [sentence(r, 60) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[3].upper()), (None, texts[4]), (7, texts[4]), (7, texts[4]), (8, texts[5])]
    want = Counter([rows[0], rows[1], rows[2], rows[3], rows[6], rows[8]])
    assert Counter((x.doc_id, x.text) for x in simhash.drop_near(table(spark, rows)).collect()) == want


@pytest.mark.parametrize("id_", [None, 4])
def test_a_rejected_row_goes_whatever_its_id(spark, id_):
    r = random.Random(6)
    good = [(i + 100, f"{sentence(r, 12).capitalize()}. {sentence(r, 9).capitalize()}, {sentence(r, 8)}.") for i in range(60)]
    bad = [(i + 200, " ".join(w + "###%%%" for w in sentence(r, 20).split())) for i in range(20)]
    rows = good[1:] + bad[1:] + [(id_, good[0][1]), (id_, bad[0][1])]
    docs = table(spark, rows)
    kept = quality.drop_bad(docs)
    assert kept.columns == docs.columns
    assert Counter((x.doc_id, x.text) for x in kept.filter(F.col("doc_id").eqNullSafe(F.lit(id_))).collect()) == Counter([(id_, good[0][1])])
