"""Removal of repeated byte strings by a hash-compared suffix sort.

A string of ``span`` bytes that two texts share has the same minimizer in both: of its
GRAM-byte substrings the one with the smallest hash. Texts' minimizers so deal the work
out in pieces, the stretches of text whose ``span``-byte strings have one minimizer. Such
a string also holds about half of what can lie between its ends and the minimizer, on the
left or on the right. Hashes of the minimizer with either half are looked up among all
texts', and only the parts of pieces whose half several texts have go on. Equal pieces
are combined before they are compared.

Among the pieces of one minimizer, equal strings start at one distance from it. Of the
suffixes at each such distance, those whose ``span`` bytes have a hash of their own there
repeat nothing, and those of one hash and the same bytes are combined. The rest is merge-sorted:
two suffixes are compared by their longest common extension, which binary search finds on
prefix polynomial hashes; the order that comes out is verified on the bytes, and made again
with another base if a collision has spoilt it. Runs of neighbours that share ``span`` bytes
are the repeats, and each learns the smallest document of its run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, freed_exchanges, in_batches, in_pieces, salt_of, spread_join, staged, through_arrow

SPAN = 50
GRAM = 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
HIGH = np.uint64(0xFFFFFFFF00000000)
#: Pieces compared in one go.
AT_ONCE = 20_000
#: Bytes of short texts that are cut into pieces, or of pieces that are hashed, in one go.
TOGETHER = 1 << 16
#: Starts that are compared in one go at all their distances.
MOST_STARTS = 1 << 20
#: Starts whose bytes are verified in one go.
BLOCK = 1 << 15
#: Parts of all hashes for each shuffle partition.
PARTS = 4
#: Owner of a hash that several texts of a chunk have.
SEVERAL = np.uint32(0xFFFFFFFF)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    return few_powers(int(base))[: n + 1] if n < 1 << 17 else np.cumprod(np.r_[np.uint64(1), np.full(n, base)])


@lru_cache(4)
def few_powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(1 << 17, np.uint64(base))])


def bases(k: int) -> np.uint64:
    """Odd multipliers for the comparing hashes, tried in this order."""
    return BASE if k == 0 else np.uint64(xxhash.xxh64_intdigest(b"base", k) | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def prefixes(codes: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes, and powers of the base's inverse: hash of [a, b) is (prefix[b] - prefix[a]) * back[a], wherever it lies."""
    return np.r_[np.uint64(0), np.cumsum(codes * powers(len(codes), base)[:-1])], powers(len(codes), np.uint64(pow(int(base), -1, 1 << 64)))


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of every GRAM codes."""
    return hashes_of_length(*prefixes(codes, BASE), GRAM)


def hashes_of_length(prefix: np.ndarray, back: np.ndarray, length: int) -> np.ndarray:
    out = prefix[length:] - prefix[:-length]
    out *= back[: len(out)]
    return out


def pieces_of(data: bytes, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every piece: minimizer, first start, number of starts, bytes before the minimizer; together all starts."""
    return pieces_of_all([data], span)[1:]


def pieces_of_all(texts: list[bytes], span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, and of every piece of its own what ``pieces_of`` gives, text by text."""
    return sided_pieces(texts, span, sides=False)[:5]


def sided_pieces(texts: list[bytes], span: int = SPAN, sides: bool = True) -> tuple[np.ndarray, ...]:
    """What ``pieces_of_all`` gives, and of every piece: starts on the far side, hash of the far side, hash of the near side.

    A start at least ``far`` bytes before the minimizer is on its far side: its string holds
    the minimizer and the ``far`` bytes before it. The string of any other start, nearer to the
    minimizer, holds it and as many bytes after it, and one or two more. Starts of the far side
    come first. The hash of a side on which a piece has no start says nothing.
    """
    found, first = [(np.zeros(0, np.int64),) * 6 + (np.zeros(0, np.uint64),) * 2], 0
    while first < len(texts):  # short texts are worked on together
        last, total = first, 0
        while last < len(texts) and (last == first or total + len(texts[last]) <= TOGETHER):
            total, last = total + len(texts[last]), last + 1
        if total >= span:
            owner, *rest = _pieces_of_joined(texts[first:last], span, sides)
            found.append((owner + first, *rest))
        first = last
    return tuple(map(np.concatenate, zip(*found)))


def _pieces_of_joined(texts: list[bytes], span: int, sides: bool) -> tuple[np.ndarray, ...]:
    ends = np.cumsum([len(t) for t in texts])
    begins = np.r_[0, ends[:-1]]
    n = int(ends[-1]) - span + 1
    codes = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    codes += np.uint64(1)
    prefix, back = prefixes(codes, BASE)
    grams = mixed(hashes_of_length(prefix, back, GRAM))
    # The high half of the hash decides, and among equals the leftmost place: both depend
    # on nothing but the window's own bytes. One number holds the two.
    keys = (grams & HIGH) | np.arange(len(grams), dtype=np.uint64)
    wide = span - GRAM + 1
    size = 1
    while 2 * size <= wide:
        keys, size = np.minimum(keys[:-size], keys[size:]), 2 * size
    if size < wide:
        keys = np.minimum(keys[:n], keys[wide - size : wide - size + n])
    place = (keys & ~HIGH).view(np.int64)
    over = (ends[:-1, None] - np.arange(1, span)).ravel()  # windows that reach into the next text
    place[over[(over >= 0) & (over < n)]] = -1
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    many, at = np.diff(np.r_[new, n]), place[new]
    whole = at >= 0
    new, at = new[whole], at[whole]
    owner = np.searchsorted(begins, new, "right") - 1
    pieces = owner, grams[at].view(np.int64), new - begins[owner], many[whole], at - new
    if not sides:
        return *pieces, *(np.zeros(0, np.int64), *(np.zeros(0, np.uint64),) * 2)
    far = (span - GRAM) // 2

    def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = np.maximum(a, 0), np.minimum(b, len(codes))
        return mixed(mixed((prefix[b] - prefix[a]) * back[a]))

    return *pieces, np.clip(at - new - far + 1, 0, many[whole]), hashes(at - far, at + GRAM), hashes(at, at + span - far + 1)


def among(some: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which of these are among the others."""
    if not len(ascending):
        return np.zeros(len(some), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, some), len(ascending) - 1)] == some


def not_alone(segment: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places, ascending, of all whose hash occurs again in their segment, and of a few others."""
    keys = mixed(mixed(hashes) + segment.astype(np.uint64) * BASE)
    left = np.arange(len(keys))
    for shift in (40, 16):  # 24 bits of the key at a time, folded to twice as many counts as there are keys
        slot = ((keys[left] >> np.uint64(shift)) & np.uint64((1 << min(24, (2 * len(left)).bit_length())) - 1)).view(np.int64)
        left = left[np.bincount(slot, minlength=1)[slot] > 1]
    return left


def in_order(codes: np.ndarray, at: np.ndarray, segment: np.ndarray, span: int) -> np.ndarray | None:
    """Whether each suffix equals the one before it in its segment; None if one is smaller than that."""
    equal = np.zeros(len(at), dtype=bool)
    step = np.arange(span)
    for first in range(1, len(at), 1 << 15):
        here = np.arange(first, min(len(at), first + (1 << 15)))
        here = here[segment[here] == segment[here - 1]]
        own, last = codes[at[here][:, None] + step], codes[at[here - 1][:, None] + step]
        differ = own != last
        equal[here] = ~differ.any(axis=1)
        place = differ.argmax(axis=1)
        row = np.arange(len(here))
        if (own[row, place] < last[row, place]).any():
            return None
    return equal


def span_hashes(data: np.ndarray, at: np.ndarray, span: int, base: np.uint64) -> np.ndarray:
    """Hash of the ``span`` bytes from each of these ascending places."""
    out, first = np.empty(len(at), dtype=np.uint64), 0
    while first < len(at):
        last = int(np.searchsorted(at, at[first] + max(TOGETHER - span, 0), "right"))
        here = at[first:last] - at[first]
        codes = data[at[first] : at[last - 1] + span].astype(np.uint64)
        codes += np.uint64(1)
        prefix, back = prefixes(codes, base)
        out[first:last] = (prefix[here + span] - prefix[here]) * back[here]
        first = last
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> np.ndarray:
    """Whether the ``span`` bytes from a are those from b."""
    spans = np.lib.stride_tricks.sliding_window_view(data, span)
    parts = [(spans[a[k : k + BLOCK]] == spans[b[k : k + BLOCK]]).all(axis=1) for k in range(0, len(a), BLOCK)]
    return np.concatenate([np.zeros(0, dtype=bool), *parts])


def sorted_suffixes(strings: np.ndarray, segment: np.ndarray, base: np.uint64) -> np.ndarray:
    """Numbers of the suffixes that begin with these strings in their order, segment by segment, as far as the strings tell."""
    span = strings.shape[1]
    prefix = np.zeros((len(strings), span + 1), dtype=np.uint64)  # hashes of a string's first bytes
    power = powers(span, base)[:-1]
    np.multiply(strings, power, out=prefix[:, 1:])
    prefix[:, 1:] += power  # as if each byte were one more
    np.cumsum(prefix, axis=1, out=prefix)
    codes, prefix = strings.ravel(), prefix.ravel()

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(a), dtype=np.int64), np.full(len(a), span)
        open_, middle = np.arange(len(a)), hi
        while len(open_):
            same = prefix[a[open_] * (span + 1) + middle] == prefix[b[open_] * (span + 1) + middle]
            lo[open_], hi[open_] = np.where(same, middle, lo[open_]), np.where(same, hi[open_], middle - 1)
            open_ = open_[lo[open_] < hi[open_]]
            middle = (lo[open_] + hi[open_] + 1) // 2
        return lo

    def before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """a's suffix is smaller than b's, by the byte after the common extension."""
        n = extension(a, b)
        end = np.minimum(n, span - 1)
        return (n < span) & (codes[a * span + end] < codes[b * span + end])

    # Bottom-up merges of runs in all segments at once: a suffix's place is its place in its
    # own run and the number of suffixes of the neighbour run that come before it.
    order = np.argsort(segment, kind="stable")
    own = segment[order]
    begin = np.searchsorted(own, own, "left")
    end = np.searchsorted(own, own, "right")
    longest, run = int((end - begin).max(initial=0)), 1
    while run < longest:
        here = np.flatnonzero(end - begin > run)  # the others are one run already
        from_, to = begin[here], end[here]
        local = here - from_
        block = local // run
        is_left = block % 2 == 0
        low = from_ + np.where(is_left, block + 1, block - 1) * run
        lo, hi = np.minimum(low, to), np.minimum(low + run, to)
        from_low = lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            middle = (lo[open_] + hi[open_]) // 2
            mine, other = order[here[open_]], order[middle]
            # Ties: the left run's suffixes come first.
            goes = np.where(is_left[open_], before(other, mine), ~before(mine, other))
            lo[open_] = np.where(goes, middle + 1, lo[open_])
            hi[open_] = np.where(goes, hi[open_], middle)
        placed = order.copy()
        placed[from_ + (block - block % 2) * run + local % run + (lo - from_low)] = order[here]
        order, run = placed, 2 * run
    return order


def repeated_starts(group: np.ndarray, docs: np.ndarray, ahead: np.ndarray, pieces: list[bytes], span: int = SPAN) -> np.ndarray:
    """Bit mask per piece of the starts whose ``span`` bytes also start in a piece of a smaller document.

    ``ahead`` is how far before its minimizer a piece begins.
    """
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    starts = size - span + 1
    rank = np.unique(group, return_inverse=True)[1].ravel()
    mask = np.zeros(len(pieces), dtype=np.int64)

    def compare(owner: np.ndarray, inner: np.ndarray) -> None:
        # Starts of one group at one distance before the minimizer.
        hit = repeats_of_smaller(data, first[owner] + inner, rank[owner] * span + ahead[owner] - inner, docs[owner], span)
        np.add.at(mask, owner[hit], np.int64(1) << inner[hit])

    if starts.sum() <= MOST_STARTS:
        owner = np.repeat(np.arange(len(pieces)), starts)
        compare(owner, np.arange(len(owner)) - (np.cumsum(starts) - starts)[owner])
    else:  # a frequent minimizer: one distance after the other, for what the arrays take
        for distance in range(int((ahead - starts).min()) + 1, int(ahead.max()) + 1):
            owner = np.flatnonzero((ahead >= distance) & (ahead - starts < distance))
            compare(owner, ahead[owner] - distance)
    return mask


def repeats_of_smaller(data: np.ndarray, at: np.ndarray, segment: np.ndarray, docs: np.ndarray, span: int) -> np.ndarray:
    """Which of these starts, ascending, have their ``span`` bytes in common with one of their segment in a smaller document."""
    # A lone one repeats nothing.
    shared = np.flatnonzero(np.bincount(segment, minlength=1)[segment] > 1)
    at, segment = at[shared], segment[shared]
    # A collision may have put suffixes in a wrong place. The order is proven on the bytes,
    # neighbour by neighbour, and made again with another base where it does not hold.
    for k in count():
        base = bases(k)
        hashes = span_hashes(data, at, span, base)
        left = not_alone(segment, hashes)
        keys = mixed(mixed(hashes[left]) + segment[left].astype(np.uint64) * BASE)
        by_key = np.argsort(keys)
        left, keys = left[by_key], keys[by_key]
        new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        again = ~(new & np.r_[new[1:], True][: len(new)])  # the others have a hash of their own
        left, new = left[again], new[again]
        # The first of a hash stands for those with its bytes; one that a collision has put there stands for itself.
        ahead_of = np.flatnonzero(new)[np.cumsum(new) - 1]
        new |= (segment[left] != segment[left[ahead_of]]) | ~same_bytes(data, at[left], at[left[ahead_of]], span)
        stands = (np.cumsum(new) - 1)[np.where(new, np.arange(len(new)), ahead_of)]
        one = left[new]
        # Where one distance has several different strings, their suffixes are sorted.
        _, which, many = np.unique(segment[one], return_inverse=True, return_counts=True)
        several = np.flatnonzero(many[which.ravel()] > 1)
        strings = np.lib.stride_tricks.sliding_window_view(data, span)[at[one[several]]]
        own = segment[one[several]]
        order = sorted_suffixes(strings, own, base)
        if (np.sort(order) == np.arange(len(several))).all():  # else two went to one place
            equal = in_order(strings.ravel(), order * span, own[order], span)
            if equal is not None:
                break
    # Runs of equal strings: of those sorted, then of those that are the only string at their distance.
    run = np.full(len(one), -1)
    run[several[order]] = np.cumsum(~equal) - 1
    only = np.flatnonzero(run < 0)
    run[only] = len(several) + np.arange(len(only))
    run, whose = run[stands], docs[shared[left]]
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, run, whose)
    return shared[left[least[run] < whose]]


def piece_mark(piece: bytes) -> int:
    return xxhash.xxh3_64_intdigest(piece) >> 1


def written(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """``staged``, but its exchanges go when it is written, not when the driver next collects garbage."""
    with freed_exchanges(df.sparkSession):
        return staged(df, purpose, codec)


def lists_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of a column of lists: for every member the row it is in, and the members."""
    return np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)), column.flatten()


def binary(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each value of the first column, by which they are sorted."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for value, of in groupby(rows, key=lambda row: next(iter(row.values()))):
        yield value, list(of)


def shared_sides(single: DataFrame, span: int) -> DataFrame:
    """Per (id, twin) of these texts: hashes of those sides of its pieces that other texts have, too.

    Each batch of texts is a chunk, which finds what its own texts share. Of every other hash it tells
    one holder, in a blob for each part of the range of hashes; what several chunks have told
    is sent back to them. However many texts have a hash, a chunk tells it once.
    """
    parts = PARTS * int(single.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = "part int, chunk long, hashes binary, owners binary, ids binary, twins binary"
    names = [field.split()[0] for field in told.split(", ")]
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            chunk, first, found = next(number), 0, []
            for part in in_pieces(batch, "text", 1 << 20):
                owner, _, _, n, _, n_far, far, near = sided_pieces(binary(part["text"]), span)
                found.append((np.r_[far[n_far > 0], near[n_far < n]], np.r_[owner[n_far > 0], owner[n_far < n]] + first))
                first += part.num_rows
            if not first:
                continue
            hashes, owners = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(hashes)
            hashes, owners = hashes[order], owners[order].astype(np.uint32)
            begin = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
            least, most = (f.reduceat(owners, begin) if len(begin) else owners for f in (np.minimum, np.maximum))
            several = least < most
            own = np.repeat(several, np.diff(np.r_[begin, len(hashes)]))
            columns = (hashes[own], owners[own], *[batch[c].to_numpy() for c in ("id", "twin")])
            rows = [(parts + chunk % parts, chunk, *[c.tobytes() for c in columns])]
            hashes, owners = hashes[begin], np.where(several, SEVERAL, least)
            part_of = ((hashes >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
            bounds = np.searchsorted(part_of, np.arange(parts + 1, dtype=np.uint64)).tolist()
            rows += [(p, chunk, hashes[a:b].tobytes(), owners[a:b].tobytes(), None, None) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            yield batch_of(rows)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in by_part(batches):
            if part < parts:
                hashes, owners = ([np.frombuffer(row[c], kind) for row in rows] for c, kind in (("hashes", np.uint64), ("owners", np.uint32)))
                ends = np.cumsum([len(x) for x in hashes])
                joined = np.concatenate(hashes)
                order = np.argsort(joined)
                again = joined[order[1:]] == joined[order[:-1]]
                shared = np.zeros(len(joined), dtype=bool)
                shared[order[1:][again]] = shared[order[:-1][again]] = True
                shared &= np.concatenate(owners) != SEVERAL
                kept = np.split(shared, ends[:-1])
                out = [(part, row["chunk"], h[k].tobytes(), o[k].tobytes(), None, None) for row, h, o, k in zip(rows, hashes, owners, kept) if k.any()]
            else:
                out = [tuple(row.values()) for row in rows]
            if out:
                yield batch_of(out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_part(batches):
            ids, twins = next([np.frombuffer(row[c], np.int64) for c in ("ids", "twins")] for row in rows if row["ids"] is not None)
            hashes, owners = (np.concatenate([np.frombuffer(row[c], kind) for row in rows]) for c, kind in (("hashes", np.int64), ("owners", np.uint32)))
            order = np.argsort(owners, kind="stable")
            has, begin = np.unique(owners[order], return_index=True)
            if len(has):
                lists = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(order)], pa.int32()), pa.array(hashes[order]))
                yield pa.record_batch([pa.array(ids[has]), pa.array(twins[has]), lists], names=["id", "twin", "sides"])

    asked = in_batches(single).mapInArrow(tell, told).repartition("part").sortWithinPartitions("part")
    answers = asked.mapInArrow(answer, told).drop("part").repartition("chunk").sortWithinPartitions("chunk")
    return answers.mapInArrow(gather, "id long, twin long, sides array<long>")


def repeats(docs: DataFrame, span: int = SPAN, marked: Callable[[bytes], int] = piece_mark, kept: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes left).

    Removes each byte covered by a ``span``-byte string that also starts in a document with
    a smaller id. Null texts are empty; shorter texts lose nothing. Rows that repeat an id
    are not each other's sources, each loses what its own text repeats. Null ids are taken as
    the largest id there can be, 2^63 - 1, and come back as null. An empty table
    gives no rows; extra columns are ignored. Pieces are joined by ``marked``, any hash of their
    bytes: pieces it cannot tell apart are told apart by the bytes.
    """
    whole = F.coalesce(column(docs, "text"), F.lit(""))
    doc_id = column(docs, "doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("id"), doc_id.isNull().alias("unknown"), whole.alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    # Of equal texts the first is compared; the others are repeats from end to end.
    firsts = written(rows.groupBy("digest").agg(F.min("id").alias("first")), "suffix-firsts")
    # Ids may repeat, and null ids share one: where several texts have an id, a text is known
    # by a hash of its digest, too, another hash where two of them have an equal one.
    several = written(firsts.groupBy("first").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("first", F.lit(True).alias("several")), "suffix-several")
    alike = firsts.join(several, "first")
    of_text = next(h for k in count() if alike.groupBy("first", (h := F.xxhash64("digest", F.lit(k)))).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty())
    firsts = firsts.join(several, "first", "left").select("digest", "first", F.when(F.col("several"), of_text).otherwise(0).alias("twin"))
    texts = written(spread_join(rows.withColumn("salt", salt_of(F.col("id"))), firsts, "digest", "salt").drop("salt", "digest"), "suffix-texts", "zstd")
    single = texts.filter("id = first").select("id", "twin", "text")

    wanted = written(shared_sides(single, span), "suffix-wanted")

    def cut(batch: pa.RecordBatch, whole: bool = False) -> Iterator[pa.RecordBatch]:
        # In the order of ids, so that the first of equal pieces is in its smallest document of the batch.
        batch = batch.take(pa.array(np.argsort(batch["id"].to_numpy(), kind="stable")))
        least: dict[bytes, int] = {}  # a piece's bytes go with its smallest document of the batch alone
        first = 0
        for part in in_pieces(batch, "text", 1 << 20):
            texts = binary(part["text"])
            owner, gram, start, n, ahead, n_far, far, near = sided_pieces(texts, span)
            # A hash with a text's number added stands for one of this text; a false one would cost a comparison.
            of, sides = lists_of(part["sides"])
            turns = mixed(np.arange(part.num_rows, dtype=np.uint64) * BASE)
            sides = np.sort(sides.to_numpy().view(np.uint64) + turns[of])
            turn = turns[owner]
            begin, end = np.where(among(far + turn, sides), 0, n_far), np.where(among(near + turn, sides), n, n_far)
            keep = begin < end
            owner, gram, start, n, ahead = (x[keep] for x in (owner, gram, start + begin, end - begin, ahead - begin))
            found = [texts[k][a:b] for k, a, b in zip(owner.tolist(), start.tolist(), (start + n + span - 1).tolist())]
            told = found if whole else [p if least.setdefault(p, k) == k else None for k, p in enumerate(found, first)]
            first += len(found)
            ids, twins = (part[c].to_numpy()[owner] for c in ("id", "twin"))
            columns = (ids, twins, start, gram, n.astype(np.int32), ahead.astype(np.int32), pa.array(told, pa.binary()), pa.array(map(marked, found), pa.int64()))
            yield pa.record_batch([pa.array(c) for c in columns], names=["id", "twin", "at", "gram", "n", "ahead", "piece", "mark"])

    pieces = "id long, twin long, at long, gram long, n int, ahead int, piece binary, mark long"
    holders = single.join(wanted, ["id", "twin"])
    found = written(through_arrow(holders, cut, pieces), "suffix-pieces", "zstd")
    # Dealt out once, by what both the equal pieces and those compared with each other have in common.
    dealt = found.filter("piece IS NOT NULL").select("gram", "mark", "piece", "id", "ahead").repartition("gram")
    distinct = dealt.groupBy("gram", "mark", "piece").agg(F.min("id").alias("first"), F.first("ahead").alias("ahead"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            rest.append(batch)
            if sum(map(len, rest)) >= AT_ONCE and rest[0]["gram"].iloc[0] != batch["gram"].iloc[-1]:
                whole = pd.concat(rest, ignore_index=True)
                last = whole["gram"] == whole["gram"].iloc[-1]
                yield from one(whole[~last])
                rest = [whole[last]]
        if rest:
            yield from one(pd.concat(rest, ignore_index=True))

    def one(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(part):
            pieces = part["piece"].tolist()
            gram = part["gram"].to_numpy()
            mask = repeated_starts(gram, part["first"].to_numpy(), part["ahead"].to_numpy().astype(np.int64), pieces, span)
            alike = part.duplicated(["gram", "mark"], keep=False).to_numpy()  # different pieces, one mark
            told = [p if a else None for p, a in zip(pieces, alike)]
            yield pd.DataFrame({"gram": gram, "mark": part["mark"].to_numpy(), "piece": told, "first": part["first"].to_numpy(), "mask": mask})

    masks = distinct.sortWithinPartitions("gram").mapInPandas(compare, "gram long, mark long, piece binary, first long, mask long")
    masks = written(masks, "suffix-masks")
    # A piece's later documents repeat all of it; its first one what the mask says. Both sides
    # are plain shuffles, so AQE can split a piece that very many documents have. Pieces of an
    # equal mark are cut again and told apart by their bytes.
    fields = ("id", "twin", "at", "n", "first", "mask")
    hits = found.drop("piece").join(masks.filter("piece IS NULL").drop("piece"), ["gram", "mark"]).select(*fields)
    clashing = masks.filter("piece IS NOT NULL")
    if not clashing.isEmpty():
        again = through_arrow(holders, lambda batch: cut(batch, whole=True), pieces)
        hits = hits.unionByName(again.join(clashing, ["gram", "mark", "piece"]).select(*fields))
    every = F.when(F.col("id") > F.col("first"), F.lit(-1).cast("long")).otherwise(F.col("mask"))
    hits = hits.select("id", "twin", F.struct("at", "n", every.alias("mask")).alias("hit")).filter("hit.mask != 0")
    hits = written(hits.groupBy("id", "twin").agg(F.collect_list("hit").alias("hits")), "suffix-hits")

    def remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text", 1 << 20):
            texts = binary(part["text"])
            size = np.array([len(t) for t in texts], dtype=np.int64)
            copied = (part["first"].to_numpy() < part["id"].to_numpy()) & (size >= span)
            n_gone, n_rises, left_of = np.where(copied, size, 0), copied.astype(np.int64), [b"" if c else t for c, t in zip(copied.tolist(), texts)]
            of, hits = lists_of(part["hits"])
            if len(hits):  # rows that have some, one after the other
                rows, of = np.unique(of, return_inverse=True)
                size_of = size[rows]
                end = np.cumsum(size_of)
                begin = end - size_of
                at, n, mask = (pc.struct_field(hits, c).to_numpy().astype(np.int64) for c in ("at", "n", "mask"))
                which = np.repeat(np.arange(len(at)), n)
                inner = np.arange(len(which)) - (np.cumsum(n) - n)[which]
                starts = ((begin[of] + at)[which] + inner)[(mask[which] >> inner) & 1 == 1]
                n_bytes = int(end[-1])
                edges = np.bincount(starts, minlength=n_bytes + 1) - np.bincount(starts + span, minlength=n_bytes + 1)
                # What is removed of a text ends with it at the latest.
                gone = np.cumsum(edges)[:-1] > 0
                rises = gone.copy()
                rises[1:] &= ~gone[:-1]
                rises[begin] = gone[begin]
                n_gone[rows], n_rises[rows] = (np.add.reduceat(x, begin, dtype=np.int64) for x in (gone, rises))
                left = np.frombuffer(b"".join([texts[k] for k in rows.tolist()]), dtype=np.uint8)[~gone].tobytes()
                bounds = np.r_[0, np.cumsum(size_of - n_gone[rows])].tolist()
                for k, a, b in zip(rows.tolist(), bounds, bounds[1:]):
                    left_of[k] = left[a:b]
            ids = pc.if_else(part["unknown"], pa.scalar(None, pa.int64()), part["id"])
            columns = [size, n_gone, n_rises, [hashlib.sha256(x).hexdigest() for x in left_of], left_of]
            yield pa.record_batch([ids, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + kept]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + kept]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    copies = texts.filter("id > first").withColumn("hits", F.lit(None).cast(hits.schema["hits"].dataType))
    owners = texts.filter("id = first").join(hits, ["id", "twin"], "left")
    return through_arrow(owners.unionByName(copies), remove, schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(documents(spark, sf_dir), kept=False)
