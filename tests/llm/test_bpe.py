"""The monoid tree against the tiktoken library, and exact round trips."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from driftledger.llm import bpe
from driftledger.llm.queries import QUERIES

PATTERN = public_tokenizers.PATTERN
RANKS = bpe.read_ranks(bpe.VOCABULARY)
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.Codec(RANKS, PATTERN)
ODD = ["a", "b", "ab", " ", "  ", "\n", "\t", "'s", "'re", "'", "l", "ll", "é", "日本", "🙂", "1", "22", "!!", " ", "́", "꟎", "\U000120ff", "aaaa", "the", " ", "՘", " \n", "<|endoftext|>"]


def library(text):
    return array("I", LIBRARY.encode_ordinary(text)).tobytes()


def test_odd_pieces():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 40)))
        assert OWN.encode(text) == library(text), repr(text)
        assert OWN.decode(OWN.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert OWN.encode(text) == library(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3001, "abc" * 999 + "a", "\n" * 700, "aA" * 400 + "zz" * 300, "x" * 20001, "é" * 3000])
def test_one_long_match(text):
    assert OWN.encode(text) == library(text)


def test_windows_grow_until_stable():
    """Random vocabularies, where merges reach far over a border: the tree equals plain merging."""
    rng = random.Random(9)
    far = 0
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        for _ in range(25):
            known = [w for w in ranks if set(w) <= set(b"abc") and len(w) < 9]
            word = rng.choice(known) + rng.choice(known)
            ranks.setdefault(word, len(ranks))
        merges = bpe.Merges(ranks)
        for _ in range(40):
            piece = bytes(rng.choices(b"abc", k=rng.randint(1, 60)))
            whole = merges.merge_short(piece)
            assert merges.tree(piece) == whole == merges.merge_long(piece)
            half = len(piece) // 2
            if half:
                a, b = merges.merge_short(piece[:half]), merges.merge_short(piece[half:])
                far += whole[: max(0, len(a) - 1)] != a[:-1]
                assert merges.join(a, b) == whole
    assert far > 20  # cases in which more than the outermost tokens changed


def test_stretches_are_borders_of_matches():
    rng = random.Random(6)
    split = OWN.split
    for _ in range(2000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 30)))
        parts = bpe.stretches(text)
        assert "".join(parts) == text
        assert [m for part in parts for m in split(part)] == split(text)


def test_tables(spark):
    rows = [(1, "plain words, and more"), (1, None), (2, ""), (None, "x y  z\n"), (3, "word " * 50000), (3, "word " * 50000)]
    docs = spark.createDataFrame([(i, t, b"", "h") for i, t in rows], "doc_id long, text string, ids binary, ids_sha256 string")
    got = sorted((tuple(r) for r in bpe.round_trip(docs).collect()), key=repr)

    def expected(i, t):
        ids = library(t or "")
        return i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    assert got == sorted((expected(*r) for r in rows), key=repr)
    encoded = bpe.encoded(docs)
    assert sorted((r.doc_id is None, r.doc_id, bytes(r.ids)) for r in encoded.collect()) == sorted((i is None, i, library(t or "")) for i, t in rows)
    back = bpe.decoded(encoded).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
