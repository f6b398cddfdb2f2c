"""Quality rules by robust multivariate outliers.

Per language and source (small ones: per language, or of all rows) the statistics' centre
and covariance are estimated by minimum covariance determinant: from medians and MADs on, concentration steps take the three
quarters of the rows that are nearest by Mahalanobis distance and estimate anew. A step is
one grouped aggregate over all rows (sums, products and a quantile sketch), so a group may
hold any share of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, documents, in_pieces, salt_of, spread_join, staged, through_arrow

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SPAN = 8
SYMBOLS = b"#*$%&|<>"
#: Smallest deviation by dimension: keeps the covariance of features that are mostly zero regular.
#: Each is below a quarter of its feature's reach among rows that pass the base (log1p(100), and
#: log1p(30) for repeated words), so that every feature alone can cross the cutoff.
FLOORS = (0.15, 0.5, 0.5, 0.5)
DIMS = len(FLOORS)
SHARE, STEPS = 0.75, 4
#: Squared distance that rejects: the 0.999 quantile of chi-square with DIMS degrees of freedom.
CUTOFF = 18.467
#: The covariance of the nearest SHARE of normal rows, times this, is that of all of them:
#: SHARE / P(chi-square with DIMS + 2 degrees of freedom <= the SHARE quantile with DIMS).
CONSISTENCY = 1.486
#: Passing rows that a language and source needs for estimates of its own, and a language too.
LEAST_ROWS = 50


def repeat_words(words: list[bytes], span: int = SPAN) -> int:
    """Words in windows of ``span`` words found twice or more; windows get exact ranks by doubling."""
    if len(words) <= span:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    step = 1
    while step < span:
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pair, return_inverse=True)[1]
        step *= 2
    found = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + span, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: the six ASCII characters
    lines = [line for line in data.split(b"\n") if line.strip()]
    blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\r", b"\v", b"\f")))
    symbols = sum(data.count(bytes([b])) for b in SYMBOLS)
    return len(words), len(text or "") - blanks, symbols, len(lines) - len(set(lines)), repeat_words(words)


def measured(docs: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batch, "text"):
            values = np.array([measure(t) for t in part["text"].to_pylist()], dtype=np.int64).reshape(-1, len(FIELDS)).T
            yield pa.record_batch([part["doc_id"], part["cell"], *map(pa.array, values)], names=["doc_id", "cell", *FIELDS])

    cell = F.to_json(F.struct(column(docs, "lang").alias("lang"), column(docs, "source").alias("source")))
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), cell.alias("cell"), column(docs, "text").alias("text"))
    return through_arrow(rows, work, "doc_id long, cell string, " + ", ".join(f"{f} long" for f in FIELDS))


def transformed() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda top, below: F.log1p(100 * F.col(top) / below)
    return [F.log1p(F.col("word_chars") / n), share("n_symbols", F.greatest(F.col("word_chars"), F.lit(1))), share("n_dup_lines", n), share("n_repeat_words", n)]


def distance() -> Column:
    """Squared Mahalanobis distance from ``center`` and the upper triangle ``inverse``."""
    d = [F.col(f"x{i}") - F.col("center")[i] for i in range(DIMS)]
    cells = combinations_with_replacement(range(DIMS), 2)
    return sum((1.0 if i == j else 2.0) * F.col("inverse")[k] * d[i] * d[j] for k, (i, j) in enumerate(cells))


def inverted(moments: DataFrame) -> DataFrame:
    """cell, n, center, inverse from cell, n, m (means) and c (upper triangle of covariances): one row per group."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for cov in batch["c"]:
                full = np.zeros((DIMS, DIMS))
                full[np.triu_indices(DIMS)] = cov
                full = full + np.triu(full, 1).T + np.diag(np.square(FLOORS))
                out.append(np.linalg.inv(full)[np.triu_indices(DIMS)].tolist())
            yield pd.DataFrame({"cell": batch["cell"], "n": batch["n"], "center": batch["m"], "inverse": out})

    return moments.mapInPandas(work, "cell string, n long, center array<double>, inverse array<double>")


def determinant_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """cell, n, center, inverse of rows with cell, salt and x0, x1, ..."""
    xs = [F.col(f"x{i}") for i in range(DIMS)]
    middle = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.percentile_approx(x, 0.5, 1000) for x in xs]).alias("m"))
    off = [F.percentile_approx(F.abs(x - F.col("m")[i]), 0.5, 1000) for i, x in enumerate(xs)]
    zero = [F.pow(1.4826 * off[i], F.lit(2.0)) if i == j else F.lit(0.0) for i, j in combinations_with_replacement(range(DIMS), 2)]
    middle = staged(middle, "rules-medians")
    spread = spread_join(rows, middle, "cell", "salt").groupBy("cell").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.array(*zero).alias("c"))
    found = staged(inverted(spread), "rules-start")
    for _ in range(steps):
        near = spread_join(rows, found, "cell", "salt").withColumn("d", distance())
        cut = staged(near.groupBy("cell").agg(F.percentile_approx("d", SHARE, 1000).alias("cut")), "rules-cuts")
        near = spread_join(near.drop("n"), cut.join(found.select("cell", "n"), "cell"), "cell", "salt").filter(F.col("d") <= F.col("cut"))
        cov = [CONSISTENCY * F.covar_pop(xs[i], xs[j]) for i, j in combinations_with_replacement(range(DIMS), 2)]
        found = near.groupBy("cell").agg(F.first("n").alias("n"), F.array(*[F.avg(x) for x in xs]).alias("m"), F.array(*cov).alias("c"))
        found = staged(inverted(found), "rules-step")
    return found


def estimated_from(cells: DataFrame, least_rows: int) -> DataFrame:
    """cell, use, keys of cell, n: whose estimates judge a cell, and to which ones its rows contribute.

    A cell with fewer than ``least_rows`` rows is judged by its language's, a language with
    fewer by those of all rows.
    """
    language = F.to_json(F.struct(F.get_json_object("cell", "$.lang").alias("lang")))
    cells = cells.withColumn("language", language)
    cells = cells.join(cells.groupBy("language").agg(F.sum("n").alias("language_n")), "language")
    own, wider, all_ = F.concat(F.lit("0"), "cell"), F.concat(F.lit("1"), "language"), F.lit("2")
    use = F.when(F.col("n") >= least_rows, own).when(F.col("language_n") >= least_rows, wider).otherwise(all_)
    cells = staged(cells.select("cell", use.alias("use"), F.array(own, wider, all_).alias("keys")), "rules-cells")
    wanted = cells.select(F.col("use").alias("key")).distinct()
    keys = cells.select("cell", F.explode("keys").alias("key")).join(wanted, "key", "left_semi")
    return staged(cells.drop("keys").join(keys.groupBy("cell").agg(F.collect_set("key").alias("keys")), "cell"), "rules-keys")


def judged(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS, steps: int = STEPS) -> DataFrame:
    """Per row of ``docs``: doc_id, the base statistics, base_failed, kept, distance.

    Estimates use all rows that pass the base rules. A row is judged by the estimates of its
    language and source (nulls are values of their own), with fewer than ``least_rows`` such
    rows by those of its language, and failing that by those of all rows: every row that
    passes the base has a distance. Null, empty and wordless texts fail the base. Repeated
    rows count each; an empty table gives no rows; extra columns are ignored.
    """
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = measured(docs).withColumn("base_failed", base).withColumn("salt", salt_of(F.col("doc_id")))
    rows = staged(rows.select("*", *[x.alias(f"x{i}") for i, x in enumerate(transformed())]), "rules-rows")
    cells = estimated_from(rows.groupBy("cell").agg(F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n")), least_rows)
    passing = spread_join(rows.filter("NOT base_failed"), cells.select("cell", "keys"), "cell", "salt")
    passing = passing.select(F.explode("keys").alias("cell"), "salt", *[f"x{i}" for i in range(DIMS)])
    found = determinant_estimates(staged(passing, "rules-passing"), steps)
    cells = cells.select("cell", "use").join(found.select(F.col("cell").alias("use"), "center", "inverse"), "use", "left")
    out = spread_join(rows, cells, "cell", "salt").withColumn("distance", F.when(~F.col("base_failed"), distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return out.select("doc_id", *FIELDS, "base_failed", kept.alias("kept"), "distance")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir))
