"""Best-fit packing of token sequences.

Pieces of one length are interchangeable, so best-fit decreasing needs only how many
pieces each length has: at most ``capacity`` numbers, whatever the corpus. The driver
packs these counts with a segment tree over remaining capacities, which yields for every
length the bins that its first, second, ... pieces go to, as ranges of ranks. Spark ranks
the pieces inside their lengths (salted, with prefix sums over the salts) and joins the
ranges. The packing is the one that best-fit decreasing gives on the whole corpus.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, in_pieces, salt_of, staged, through_arrow

CAPACITY = 1024
END = 2
SALTS = 256
#: Words whose ids a worker remembers, about 200 bytes each; beyond it starts afresh.
REMEMBERED = 300_000
#: Arrow batches of texts and of ids: two tasks' batches are held by Python and by the JVM.
MOST_BYTES = "4m"
VOCABULARY = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, without special tokens added.

    The byte-level splitter never puts a blank that follows a non-space and precedes one
    anywhere but at the start of a token, so a text cut at such blanks has the ids of its
    parts. Words are so encoded once per stretch of text, all new ones in one call, by
    tiktoken where ``ranks`` names the same vocabulary as ranks (checked entry by entry
    when loaded): it merges several times as fast. Everything out of the ordinary goes
    through the library itself: texts with a blank beside other white space or with a
    special token, and words with letters beyond U+024F, where Unicode versions differ.
    """

    def __init__(self, path: str, ranks: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        merges = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.merge = merges.encode_ordinary
        spelled = byte_letters()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        if any(vocabulary.get("".join(map(spelled.__getitem__, word))) != rank for word, rank in table.items()):
            raise ValueError(f"{ranks} is not the vocabulary of {path}")
        self.n_bytes = np.zeros(max(table.values()) + 1, dtype=np.int64)
        for word, rank in table.items():
            self.n_bytes[rank] = len(word)
        self.known: dict[str, bytes | None] = {}

    def part(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words that follow a blank; None: not to be cut off there."""
        plain = []
        for word in words:
            if not word or len(word.strip()) != len(word):
                self.known[word] = None
            elif word.isascii() or max(word) < "\u0250":
                plain.append(word)
            else:
                self.known[word] = self.part(" " + word)
        if plain:
            ids = np.array(self.merge(" " + " ".join(plain)), dtype="<u4")
            ends = np.cumsum([len(w) + 1 if w.isascii() else len(w.encode()) + 1 for w in plain])
            cuts = (4 * (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1)).tolist()
            flat, at = ids.tobytes(), 0
            for word, cut in zip(plain, cuts):
                self.known[word] = flat[at:cut]
                at = cut

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [text.split(" ") for text in texts]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.learn(set(chain.from_iterable(words[1:] for words in cut)).difference(self.known))
        out = []
        for text, words in zip(texts, cut):
            first = words[0]
            plain = len(words) > 1 and first and not first[-1].isspace() and not any(s in text for s in self.specials)
            try:
                out.append(self.part(first) + b"".join(map(self.known.__getitem__, words[1:])) if plain else self.part(text))
            except TypeError:  # a None among the words
                out.append(self.part(text))
        return out


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, ranks: str) -> Encoder:
    if (path, ranks) not in _ENCODERS:
        _ENCODERS[path, ranks] = Encoder(path, ranks)
    return _ENCODERS[path, ranks]


def pieces(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (the piece's own ids, little-endian 32 bit)."""
    tail = int(end).to_bytes(4, "little")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks)
        for part in in_pieces(batch, "text", 1 << 18):
            rows: list[tuple] = []
            texts = [text or "" for text in part["text"].to_pylist()]
            for doc_id, ids in zip(part["doc_id"].to_pylist(), encode(texts)):
                ids += tail
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own), own))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return through_arrow(docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text")), cut, PIECE + ", ids binary", MOST_BYTES)


class Tightest:
    """Segment tree over remaining capacities: the smallest one of at least n that is open."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.base)

    def put(self, room: int, is_open: bool) -> None:
        i = room + self.base
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def find(self, n: int) -> int | None:
        i = n + self.base
        if self.open[i]:
            return n
        while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
            i //= 2
        if i == 1:
            return None
        i += 1
        while i < self.base:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.base


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pack ``counts[length]`` pieces of each length into bins of ``capacity``.

    Gives (length, first rank, number of pieces, first bin, offset in the bin): the pieces
    with ranks first, first + 1, ... go to the bins first, first + 1, ... at one offset.
    Open bins of one remaining capacity are kept as ranges of bin numbers, so a step
    places as many pieces as the range or the length has left.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    tree = Tightest(capacity)
    placed: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def leave(room: int, first: int, n: int) -> None:
        if room:
            rooms.setdefault(room, []).append((first, n))
            tree.put(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.find(length)
            if room is None:  # new bins, each filled with as many as fit before the next is opened
                first, room, fits = bins, capacity, capacity // length
                n = max(1, left // fits)
                bins += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.put(room, False)
                fits = room // length
                if n > 1 and n * fits > left:
                    use = max(1, left // fits)
                    leave(room, first + use, n - use)
                    n = use
            layers = min(fits, left // n)
            for k in range(layers):
                placed.append((length, rank, n, first, capacity - room + k * length))
                rank += n
            left -= layers * n
            leave(room - layers * length, first, n)
    return placed


def pack(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    Without ``with_ids`` the ids themselves are not kept.

    A document is its text's ids and then ``end``; null texts are empty, so every row
    gives at least one piece. Only documents longer than ``capacity`` are cut: into pieces
    of ``capacity`` with the shorter one first. Repeated rows are packed each for itself
    (which of two pieces of one length comes first does not change the number of
    sequences); an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    salts = salt_of(F.col("doc_id"), F.col("piece"), F.col("ids_crc32"), salts=SALTS)
    table = pieces(docs, path, ranks, capacity, end)
    table = staged((table if with_ids else table.drop("ids")).withColumn("salt", salts), "packing-pieces")
    cells = table.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).collect()  # capacity * SALTS rows at most
    counts: dict[int, int] = {}
    offsets = []
    for length, salt, n in sorted(map(tuple, cells)):
        offsets.append((length, salt, counts.get(length, 0)))
        counts[length] = counts.get(length, 0) + n
    ranges = best_fit_decreasing(counts, capacity)
    offsets = spark.createDataFrame(offsets, "length long, salt int, ahead long")
    inside = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = table.withColumn("at", F.row_number().over(inside).cast("long") - 1).join(offsets, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("at") + F.col("ahead"))
    return located(ranked, ranges)


def located(ranked: DataFrame, ranges: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """sequence_id and offset of ranked pieces.

    The ranges go along with the task. Their number depends on the capacity alone: each
    uses up a length's pieces or the open bins of one remaining capacity, which makes
    thousands of them for 1,024, and less than capacity squared in any case.
    """
    length, rank, _, first, offset = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 5).T
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if "ids" in ranked.columns else [])]

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, at = batch["length"].to_numpy(), batch["rank"].to_numpy()
        k = np.empty(len(own), dtype=np.int64)
        for n in np.unique(own):
            lo, hi = np.searchsorted(length, [n, n + 1])
            k[own == n] = lo + np.searchsorted(rank[lo:hi], at[own == n], side="right") - 1
        yield pa.record_batch([*[batch[c] for c in names], pa.array(first[k] + at - rank[k]), pa.array(offset[k])], names=[*names, "sequence_id", "offset"])

    schema = PIECE + ", ids binary, sequence_id long, offset long" if "ids" in names else PIECE + ", sequence_id long, offset long"
    return through_arrow(ranked, find, schema, MOST_BYTES)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(documents(spark, sf_dir), *VOCABULARY, with_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
