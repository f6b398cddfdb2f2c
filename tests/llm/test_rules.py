import random

import pytest

from driftledger.llm import rules

SCHEMA = "doc_id long, text string, lang string, source string"


def prose(r, n=60):
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.choice((2, 3, 4, 5, 6, 7, 8)))) for _ in range(n))


def outliers(r):
    """One text per statistic that is unusual in this one alone."""
    phrase = prose(r, 9)
    return {
        "word_chars": " ".join(prose(r, 10).replace(" ", "") for _ in range(40)),
        "n_symbols": prose(r, 60).replace("e", "#").replace("a", "%"),
        "n_dup_lines": "\n".join(f"{w}\nyes" for w in prose(r, 60).split()),
        "n_repeat_words": f"{phrase} {prose(r, 45)} {phrase}",
    }


@pytest.mark.parametrize("name", ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
def test_every_statistic_rejects_alone(spark, name):
    r = random.Random(1)
    rows = [(i, prose(r), "en", "a") for i in range(120)] + [(120, outliers(r)[name], "en", "a")]
    got = {x.doc_id: x for x in rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[120].base_failed and [i for i, x in got.items() if not x.kept] == [120]


def test_small_cells_are_judged_by_wider_ones(spark):
    r = random.Random(2)
    bad = outliers(r)["n_symbols"]
    rows = [(i, prose(r), "en", f"s{i % 40}") for i in range(80)]  # two rows a source, 80 a language
    rows += [(100, bad, "en", "s0"), (101, bad, "xx", None), (102, prose(r), "xx", None), (103, bad, None, "s1"), (104, "short", "yy", "s1")]
    got = {x.doc_id: x for x in rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all((x.distance is None) == x.base_failed for x in got.values())
    assert sorted(i for i, x in got.items() if not x.kept) == [100, 101, 103, 104]
