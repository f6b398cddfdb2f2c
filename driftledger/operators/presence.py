"""When a problem was seen, as bits: one per scan of a delivery, 64 to a word.

A key's presence over any number of scans is a short sorted list of (word, bits), made
with ``bit_or`` in front of the shuffle; words without a sighting are not kept. What
happened from scan to scan is then a shift and a mask per word, so the cost of a key is
linear in its words, however many scans a backfill has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64
WORDS = "array<struct<word:int,bits:bigint>>"
MOVES = "array<struct<transition:string,word:int,bits:bigint>>"


def word_of(step: Column) -> Column:
    return F.floor(step / WORD).cast("int")


def bit_of(step: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(step, F.lit(WORD)).cast("int"))


def seen_words(sightings: DataFrame, keys: list[str], one_word: bool, **kept: tuple) -> DataFrame:
    """Per key: ``words``, and for each of ``kept`` (name -> (aggregate, column)) its aggregate.

    ``sightings`` has ``step``, null for a sighting outside the scans. The aggregates have to
    be ones that may be taken twice (min, max, and min_by given as a pair of columns). With
    ``one_word`` the caller knows that all steps lie in the first word, and one shuffle is
    enough.
    """
    first = {name: pick(*columns).alias(name) for name, (pick, *columns) in kept.items()}
    bits = F.bit_or(bit_of(F.col("step"))).alias("bits")
    if one_word:
        some = sightings.groupBy(*keys).agg(*first.values(), bits)
        words = F.when(F.col("bits").isNotNull(), F.array(F.struct(F.lit(0).alias("word"), "bits"))).otherwise(F.array().cast(WORDS))
        return some.withColumn("words", words).drop("bits")
    by_word = sightings.groupBy(*keys, word_of(F.col("step")).alias("word")).agg(*first.values(), bits)
    word = F.when(F.col("bits").isNotNull(), F.struct("word", "bits"))
    again = [_again(pick, name, columns).alias(name) for name, (pick, *columns) in kept.items()]
    return by_word.groupBy(*keys).agg(*again, F.sort_array(F.collect_list(word)).alias("words"))


def _again(pick, name: str, columns: list) -> Column:
    # min_by over words: a word's pick goes with its place in time, which its word number gives.
    return pick(F.col(name), F.col("word")) if len(columns) > 1 else pick(F.col(name))


def carried(words: Column, was_open: Column) -> Column:
    """The words with scan 0 added for what was open by then."""
    words = F.coalesce(words, F.array().cast(WORDS))
    first = F.get(words, F.lit(0))
    zero = F.struct(F.lit(0).alias("word"), F.coalesce(F.when(first["word"] == 0, first["bits"]), F.lit(0).cast("bigint")).bitwiseOR(F.lit(1).cast("bigint")).alias("bits"))
    rest = F.when(first["word"] == 0, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words)
    return F.when(was_open, F.concat(F.array(zero), rest)).otherwise(words)


def moves(words: Column, was_open: Column, opens: Column, first: Column) -> Column:
    """What happened to one key, as masks of scans: opened, reopened, closed.

    ``words`` has the carried scan 0; ``first`` is the step at which a key that ``opens`` does. A closure is counted at the scan that misses the key,
    which may be one past the delivery's last; :func:`count_moves` leaves that out.
    """

    def before(i: Column, word: Column) -> Column:  # whether the scan before the word's first saw it
        last = F.get(words, i - 1)
        return F.when((i > 0) & (last["word"] == word - 1), F.shiftrightunsigned(last["bits"], WORD - 1)).otherwise(F.lit(0).cast("bigint"))

    def changed(kind: str, mask) -> Column:
        def at(x: Column, i: Column) -> Column:
            shifted = F.shiftleft(x["bits"], 1).bitwiseOR(before(i, x["word"]))
            return F.struct(F.lit(kind).alias("transition"), x["word"].alias("word"), mask(x, i, shifted).alias("bits"))

        return F.transform(words, at)

    def appeared(x: Column, i: Column, shifted: Column) -> Column:
        known = F.when(was_open & (x["word"] == 0), F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return x["bits"].bitwiseAND(F.bitwise_not(shifted.bitwiseOR(known).bitwiseOR(opened(x, i, shifted))))

    def opened(x: Column, i: Column, shifted: Column) -> Column:
        return F.when(opens & (i == 0), bit_of(first)).otherwise(F.lit(0).cast("bigint"))

    def vanished(x: Column, i: Column, shifted: Column) -> Column:
        return F.bitwise_not(x["bits"]).bitwiseAND(shifted)

    def spilled(x: Column, i: Column) -> Column:
        """The last scan of a word saw it, the first of the next did not and its word is not kept."""
        follows = F.coalesce(F.get(words, i + 1)["word"] == x["word"] + 1, F.lit(False))
        bits = F.when(follows, F.lit(0).cast("bigint")).otherwise(F.shiftrightunsigned(x["bits"], WORD - 1))
        return F.struct(F.lit("closed").alias("transition"), (x["word"] + 1).alias("word"), bits.alias("bits"))

    every = F.concat(changed("opened", opened), changed("reopened", appeared), changed("closed", vanished), F.transform(words, spilled))
    return F.filter(every, lambda m: m["bits"] != 0)


def count_moves(moved: DataFrame, steps: DataFrame) -> DataFrame:
    """Per scan of ``steps``, how many keys opened, reopened and closed."""
    masks = moved.select(F.explode("moves").alias("m")).select("m.transition", "m.word", "m.bits")
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(F.col("bits"), i) == 1)
    at = masks.select("transition", "word", F.explode(set_bits).alias("bit")).withColumn("step", F.col("word") * WORD + F.col("bit"))
    kinds = ("opened", "reopened", "closed")
    counted = at.groupBy("step").agg(*[F.count_if(F.col("transition") == kind).alias(kind) for kind in kinds])
    return steps.join(counted, "step", "left").na.fill(0, list(kinds))
