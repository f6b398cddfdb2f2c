"""Byte-level BPE by a monoid tree: encode halves, join neighbours, decode up the same tree.

The elements are stretches of text with their token ids, and joining two of them gives
the element of the text put together. That takes two arguments, one per level.

Inside a match of the splitting pattern: a sequence of tokens is the encoding of its
bytes if every two neighbours are the encoding of theirs. (Merges go by rank, then from
the left, so a run over the whole restricted to two tokens is the run over these two; the
first merge that crosses a border would cross it there, too.) Two encodings are joined by
encoding a window of tokens around the border anew and keeping the rest: right as soon as
the tokens at the window's edges come out as they were, or go with their new neighbours.
Until then the side that fails grows to twice its tokens.

Between matches: the pattern has no look-behind, so what follows a border of matches does
not depend on what precedes it, and a blank between two other characters that are no
white space always begins a match. Texts are cut at such blanks; stretches join there
without any window. A worker remembers the ids of stretches it has met.
"""

from __future__ import annotations

import hashlib
from array import array
from base64 import b64decode
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, in_pieces, through_arrow

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes that are merged outright; anything longer is halved.
LEAF = 4
#: Windows of more bytes go by a heap.
SHORT = 256
#: Stretches, and pairs of tokens, that a worker remembers; beyond it starts afresh.
REMEMBERED = 500_000
#: Tokens of one leaf in decoding.
SPAN = 4096
COLUMNS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class Merges:
    """Encodings as lists of token bytes, by ranks of the tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for {len(missing)} of the 256 bytes")
        self.ranks = ranks
        self.last = max(ranks.values()) + 1  # the rank of what is no token
        self.met: dict[bytes, list[bytes]] = {}
        self.halves: dict[bytes, list[bytes]] = {}
        self.stable: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """Merge the pair of the lowest rank, of equals the leftmost, as long as there is one."""
        if len(piece) > SHORT:
            return self.merge_long(piece)
        parts = self.met.get(piece)
        if parts is None:
            parts = self.merge_short(piece)
            if len(piece) <= 4 * LEAF:
                if len(self.met) >= REMEMBERED:
                    self.met.clear()
                self.met[piece] = parts
        return parts

    def merge_short(self, piece: bytes) -> list[bytes]:
        get, last = self.ranks.get, self.last
        parts = [piece[k : k + 1] for k in range(len(piece))]
        pairs = [get(piece[k : k + 2], last) for k in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == last:
                break
            k = pairs.index(low)
            del pairs[k]
            parts[k] += parts.pop(k + 1)
            if k < len(pairs):
                pairs[k] = get(parts[k] + parts[k + 1], last)
            if k:
                pairs[k - 1] = get(parts[k - 1] + parts[k], last)
        return parts

    def merge_long(self, piece: bytes) -> list[bytes]:
        """The same with a heap of pairs and links between the parts that are left."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
        before = list(range(-1, n))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := get(piece[k : k + 2])) is not None]
        heapify(heap)
        while heap:
            _, k, stop = heappop(heap)
            middle = end[k]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two has been merged since
            end[k], end[middle] = stop, 0
            if stop < n:
                before[stop] = k
                if (r := get(piece[k : end[stop]])) is not None:
                    heappush(heap, (r, k, end[stop]))
            if k and (r := get(piece[before[k] : stop])) is not None:
                heappush(heap, (r, before[k], stop))
        parts, k = [], 0
        while k < n:
            parts.append(piece[k : end[k]])
            k = end[k]
        return parts

    def fit(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens stay as they are side by side."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= REMEMBERED:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(a + b) == [a, b]
        return known

    def join(self, a: list[bytes], b: list[bytes]) -> list[bytes]:
        """The encoding of two neighbours from theirs."""
        if self.fit(a[-1], b[0]):
            return a + b
        i = j = 1
        while True:
            i, j = min(i, len(a)), min(j, len(b))
            window = self.merge(b"".join(a[len(a) - i :]) + b"".join(b[:j]))
            left = i == len(a) or window[0] == a[-i] or self.fit(a[-i - 1], window[0])
            right = j == len(b) or window[-1] == b[j - 1] or self.fit(window[-1], b[j])
            if left and right:
                return a[: len(a) - i] + window + b[j:]
            i, j = (i if left else 2 * i), (j if right else 2 * j)

    def tree(self, piece: bytes) -> list[bytes]:
        """Halves first; what a worker has met as a half of one match serves all others."""
        if len(piece) <= LEAF:
            return self.merge(piece)
        parts = self.halves.get(piece)
        if parts is None:
            half = len(piece) // 2
            parts = self.join(self.tree(piece[:half]), self.tree(piece[half:]))
            if len(piece) <= 2 * LEAF:
                if len(self.halves) >= REMEMBERED:
                    self.halves.clear()
                self.halves[piece] = parts
        return parts

    def ids(self, piece: bytes) -> list[int]:
        """One match: a token of its own, or merged."""
        own = self.ranks.get(piece)
        return [own] if own is not None else list(map(self.ranks.__getitem__, self.tree(piece)))


class Splitter:
    """Matches of the pattern, with the character classes of the tiktoken library.

    Unicode versions differ in which characters are letters or numbers. Up to U+024F all
    agree; any other character is shown to the library once, beside a letter, a digit and a
    mark, and takes part in the matching as a stand-in of the class it then has.
    """

    SAME = "ɐ"
    STAND_INS = {"a": "ª", "1": "²", "!": "¤"}  # of a letter, a number, a mark; else white space
    SPACE = " "

    def __init__(self, pattern: str):
        self.pattern = pattern
        self.compiled = regex.compile(pattern)
        self.known: dict[int, str] = {}

    def learn(self, new: set[str]) -> None:
        import tiktoken

        for c in new:
            self.known[ord(c)] = self.SPACE
        for lead, stand_in in self.STAND_INS.items():
            ranks = {bytes([b]): b for b in range(256)}
            ranks |= {(lead + c).encode(): 256 + k for k, c in enumerate(sorted(new))}
            probe = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            for c in new:
                if len(probe.encode_ordinary(lead + c)) == 1:  # one match, as it is one token
                    self.known[ord(c)] = stand_in

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or max(text) < self.SAME:
            return self.compiled.findall(text)
        if new := {c for c in set(text) if c >= self.SAME and ord(c) not in self.known}:
            self.learn(new)
        return [text[m.start() : m.end()] for m in self.compiled.finditer(text.translate(self.known))]


class Codec:
    """Ids of whole texts, as little-endian 32-bit numbers, and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = Merges(ranks)
        self.split = Splitter(pattern)
        self.known: dict[str, bytes] = {}
        self.token = {rank: word for word, rank in ranks.items()}

    def stretch(self, text: str) -> bytes:
        ids = array("I")
        for match in self.split(text):
            ids.extend(self.merges.ids(match.encode("utf-8", "surrogatepass")))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        known = self.known
        if len(known) >= REMEMBERED:
            known.clear()
        out = []
        for part in stretches(text):
            ids = known.get(part)
            if ids is None:
                ids = self.stretch(part)
                if len(part) <= 64:
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        numbers, token = array("I", ids), self.token.__getitem__

        def up(first: int, last: int) -> bytes:
            if last - first <= SPAN:
                return b"".join(map(token, numbers[first:last]))
            half = (first + last) // 2
            return up(first, half) + up(half, last)

        return up(0, len(numbers))


def stretches(text: str) -> list[str]:
    """``text`` cut before each blank that stands between two characters that are no white space."""
    words = text.split(" ")
    first, *rest = words
    out = [first]
    glued = not first or first[-1].isspace()
    for word in rest:
        space = not word or word[0].isspace()
        if glued or space:
            out[-1] += " " + word
        else:
            out.append(" " + word)
        glued = not word or word[-1].isspace()
    return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per worker."""
    return Codec(read_ranks(path), pattern)


def through_codec(docs: DataFrame, path: str, pattern: str, schema: str, row: Callable[[Codec, int | None, str], Sequence]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in in_pieces(batch, "text", 1 << 20):
            rows = [row(own, doc_id, text or "") for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist())]
            yield pa.record_batch([pa.array(c) if k else pa.array(c, pa.int64()) for k, c in enumerate(zip(*rows))], names=names)

    names = [field.split()[0] for field in schema.split(", ")]
    texts = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    return through_arrow(texts, work, schema)


def encoded(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    Null texts are empty texts and have no ids. Texts are taken whole, however long, one
    at a time. Rows that repeat an id each get their row, null ids stay null, an empty
    table gives no rows, and extra columns are ignored.
    """

    def row(own: Codec, doc_id: int | None, text: str) -> Sequence:
        ids = own.encode(text)
        return doc_id, len(ids) // 4, ids

    return through_codec(docs, path, pattern, "doc_id long, n_tokens long, ids binary", row)


def decoded(ids: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, text of rows of ``encoded``; null ids are no ids. An id that is no token fails."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        texts = [own.decode(i or b"").decode("utf-8", "replace") for i in batch["ids"].to_pylist()]
        yield pa.record_batch([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return through_arrow(ids.select(F.col("doc_id").cast("long"), "ids"), work, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row of ``docs`` (as for ``encoded``): doc_id, n_tokens, ids_sha256, decoded_sha256, in one pass."""

    def row(own: Codec, doc_id: int | None, text: str) -> Sequence:
        ids = own.encode(text)
        return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    return through_codec(docs, path, pattern, COLUMNS, row)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
