"""Embedding whitening by spectrum slicing.

Vectors become integers (``floor(64 * c) + 1000000``), so that counts, sums and products
add up exactly in any order. One pass gives n and the sums S; a second one the products
of x minus the integer next to its mean, reduced inside the tasks and then summed cell by
cell, from which the covariance follows without a rounding before the last.

Of the covariance (dimension squared, whatever the number of rows) the driver takes the
leading eigenvalues one by one: the signs in a factorisation L D L^T of V - s I count the
eigenvalues above s, bisection by such counts isolates one, Rayleigh quotient iteration
then converges cubically, and counts on both sides of the result certify its number.
Values that no count can tell apart in double precision are taken together, as one
subspace.

A third pass measures the whitened rows' own covariance; the last one writes the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftledger.llm.common import column, through_arrow

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
EPS = np.finfo(np.float64).eps
#: The golden cut of a block (Bunch and Kaufman): a pivot this large against its column stays.
PIVOT = (1 + 17**0.5) / 8
CELLS = "i int, j int, v decimal(38,0)"
ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def inertia(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` are above ``shift``.

    L D L^T with symmetric pivoting into blocks of one or two: D has as many positive
    eigenvalues as V - shift I.
    """
    a = v - shift * np.eye(len(v))
    above = 0
    while len(a):
        below = np.abs(a[1:, 0])
        most = below.max(initial=0.0)
        if max(abs(a[0, 0]), most) == 0:  # a zero pivot: not above
            a = a[1:, 1:]
            continue
        two = None
        if abs(a[0, 0]) < PIVOT * most:
            r = 1 + int(below.argmax())
            column_r = np.abs(a[:, r])
            column_r[r] = 0
            other = column_r.max()
            if abs(a[0, 0]) * other >= PIVOT * most * most:
                pass
            elif abs(a[r, r]) >= PIVOT * other:
                a[[0, r]] = a[[r, 0]]
                a[:, [0, r]] = a[:, [r, 0]]
            else:
                two = r
        if two is None:
            above += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
        else:
            a[[1, two]] = a[[two, 1]]
            a[:, [1, two]] = a[:, [two, 1]]
            above += 1  # such a block has one eigenvalue of each sign
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return above


def start(size: int, k: int, found: list[np.ndarray]) -> np.ndarray:
    """A fixed vector off those found."""
    x = np.random.default_rng(k).standard_normal(size)
    return off(x, found)


def off(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):  # twice is enough
        for q in found:
            x = x - (q @ x) * q
    return x / np.linalg.norm(x)


def solved(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    a = v - shift * np.eye(len(v))
    try:
        y = np.linalg.solve(a, x)
    except np.linalg.LinAlgError:
        y = np.linalg.solve(a + EPS * max(1.0, abs(shift)) * np.eye(len(v)), x)
    return y / np.linalg.norm(y)


def iterate(v: np.ndarray, low: float, high: float, k: int, found: list[np.ndarray]) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from the middle; None where it leaves the interval."""
    rough = EPS * len(v) * np.abs(v).sum(axis=1).max()
    shift, x = (low + high) / 2, start(len(v), k, found)
    x = off(solved(v, shift, x), found)
    x = off(solved(v, shift, x), found)
    for _ in range(30):
        shift = float(x @ v @ x)
        if np.linalg.norm(v @ x - shift * x) <= rough:
            break
        x = off(solved(v, shift, x), found)
    shift = float(x @ v @ x)
    settled = np.linalg.norm(v @ x - shift * x) <= 16 * rough
    return (shift, x) if settled and low <= shift <= high else None


def together(v: np.ndarray, low: float, high: float, first: int, last: int, found: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
    """The subspace of eigenvalues that lie too close to be counted apart."""
    basis: list[np.ndarray] = []
    for k in range(first, last + 1):
        x = start(len(v), k, found + basis)
        for _ in range(4):
            x = off(solved(v, (low + high) / 2, x), found + basis)
        basis.append(x)
    q = np.stack(basis, axis=1)
    values, turn = np.linalg.eigh(q.T @ v @ q)
    return [(float(values[i]), q @ turn[:, i]) for i in range(len(values) - 1, -1, -1)]


def spectrum(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues above rounding, falling, and their unit vectors as columns.

    Fewer where ``v`` has fewer: a value within rounding of zero belongs to no component.
    """
    v = np.asarray(v, dtype=np.float64)
    size = len(v)
    norm = np.abs(v).sum(axis=1).max(initial=0.0)
    rounding = EPS * size * norm
    values: list[float] = []
    vectors: list[np.ndarray] = []
    wanted = min(most, inertia(v, rounding)) if norm else 0
    counts = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(v, shift)
        return counts[shift]

    while len(values) < wanted:
        k = len(values) + 1
        low, high = rounding, norm * (1 + 8 * EPS) + rounding
        for shift, n in counts.items():  # what earlier counts know already
            if n >= k:
                low = max(low, shift)
            else:
                high = min(high, shift)
        got = None
        while high - low > 4 * rounding:
            if above(low) == k and above(high) == k - 1:
                got = iterate(v, low, high, k, vectors)
                if got is not None:
                    break
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        if got is None:
            # The interval has all values from number k on that its ends cannot separate.
            while above(high) > k - 1:
                high += rounding
            group = together(v, low, high, k, max(k, above(low)), vectors)
        else:
            group = [got]
        for value, vector in group:
            values.append(value)
            vectors.append(vector)
        edge = 16 * rounding
        if not inertia(v, values[-1] + edge) < len(values) <= inertia(v, values[-1] - edge):
            raise ArithmeticError(f"eigenvalue {len(values)} is not where the counts say")
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.stack(vectors, axis=1)[:, order] if values else np.zeros((size, 0))


@dataclass(frozen=True)
class Whitening:
    """What a fit knows; its size depends on the dimension alone."""

    n: int
    sums: np.ndarray  # exact, of x
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def near(self) -> np.ndarray:
        """The integers next to the mean."""
        return np.array([(2 * int(s) + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Mean minus ``near``, as double."""
        return np.array([(int(s) - self.n * int(k)) / self.n for s, k in zip(self.sums, self.near)])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.near).astype(np.float64) - self.rest
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact; None where it does not fit a long."""
        off_near = x - self.near
        shift = [int(s) - self.n * int(k) for s, k in zip(self.sums, self.near)]
        most = (int(np.abs(off_near).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 62:
            return ((self.n * off_near - np.array(shift, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off_near.astype(object) - np.array(shift, dtype=object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that remain: no null vector, and no entry that is null or not finite."""
    c = column(vectors, "embedding").cast("array<double>")
    rows = vectors.select(column(vectors, "vec_id").cast("long").alias("vec_id"), c.alias("embedding")).filter("embedding is not null")
    return rows.filter(F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))


def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = pc.list_flatten(batch["embedding"]).to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat.reshape(batch.num_rows, size)) + SHIFT).astype(np.int64)


def exact_sum(table: np.ndarray) -> list[int]:
    if len(table) * (int(np.abs(table).max(initial=0)) + 1) < 1 << 62:
        return table.sum(axis=0).tolist()
    return [int(s) for s in table.astype(object).sum(axis=0)]


def exact_products(d: np.ndarray) -> np.ndarray:
    """d^T d of integers, exact."""
    most = int(np.abs(d).max(initial=0))
    if most * most * len(d) < 1 << 53:
        return (d.astype(np.float64).T @ d.astype(np.float64)).astype(np.int64)
    return d.astype(object).T @ d.astype(object)


def cells(i: np.ndarray, j: np.ndarray, v: list) -> pa.RecordBatch:
    import decimal

    values = pa.array([decimal.Decimal(int(x)) for x in v], pa.decimal128(38, 0))
    return pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], names=["i", "j", "v"])


def summed(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Cell sums over all tasks; dimension squared rows at most come back."""
    return {(r.i, r.j): int(r.v) for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def reduced(rows: DataFrame, schema: str, zero, add, out) -> DataFrame:
    """One accumulator per task over all its batches, written as few rows at the task's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zero
        for batch in batches:
            if batch.num_rows:
                total = add(total, batch)
        if total is not zero:
            yield out(total)

    return rows.mapInArrow(run, schema)


def dimension(rows: DataFrame) -> int:
    """The length that most vectors have (the larger of equals); 0 without rows."""
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return top[0].d if top else 0


def fit(rows: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """Whitening of ``usable`` rows of ``size`` entries each; None without rows or spread."""
    every = np.arange(size)

    def add_sums(total, batch):
        x = matrix(batch, size)
        return (total[0] + len(x), [a + b for a, b in zip(total[1], exact_sum(x))])

    def out_sums(total):
        return cells(np.r_[-1, every], np.zeros(size + 1), [total[0], *total[1]])

    first = summed(reduced(rows, CELLS, (0, [0] * size), add_sums, out_sums))
    if not first:
        return None
    n = first.pop((-1, 0))
    sums = np.array([first[k, 0] for k in range(size)], dtype=object)
    plain = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    near, upper = plain.near, np.triu_indices(size)

    def add_products(total, batch):
        p = exact_products(matrix(batch, size) - near).astype(object)
        return p if total is None else total + p

    second = summed(reduced(rows, CELLS, None, add_products, lambda p: cells(*upper, p[upper].tolist())))
    shift = [int(s) - n * int(k) for s, k in zip(sums, near)]
    v = np.zeros((size, size))
    for (i, j), c in second.items():
        v[i, j] = v[j, i] = (n * c - shift[i] * shift[j]) / (n * n)  # of integers: one rounding
    values, vectors = spectrum(v, most)
    if not len(values):
        return None
    fitted = Whitening(n, sums, values, vectors, float(np.trace(v)))
    return Whitening(n, sums, values, vectors, fitted.trace, measured(rows, size, fitted))


def measured(rows: DataFrame, size: int, fitted: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    k = len(fitted.values)

    def add(total, batch):
        w = fitted.whiten(matrix(batch, size))
        part = np.vstack([w.T @ w, w.sum(axis=0)])
        return part if total is None else total + part

    def out(total):
        i, j = np.indices(total.shape)
        return pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    parts = reduced(rows, "i int, j int, v double", None, add, out).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((k + 1, k))
    for i, j, v in parts.collect():  # at most dimension squared rows
        total[i, j] = v / fitted.n
    # Rows are centred before multiplying; what rounding leaves of their mean goes too.
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry are left out of fit and
    result, and so are vectors of another length than most rows have (a longer one of two
    lengths as frequent is taken). Rows that repeat an id, or a vector, each count and each
    get their rows; null ids stay null. Components are those with an eigenvalue above
    rounding, ``most`` at most: fewer for short or dependent vectors, none (no rows) for an
    empty table, a single row, or rows that are all equal. Equal eigenvalues get some
    orthonormal vectors of their space. ``deviation`` is null where it exceeds a long.
    Extra columns are ignored.
    """
    rows = usable(vectors)
    size = dimension(rows)
    rows = rows.filter(F.size("embedding") == size)
    fitted = fit(rows, size, most) if size else None
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], ROWS)
    k = len(fitted.values)
    explained = fitted.values / fitted.trace

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = matrix(batch, size)
        m = len(x)
        own = pa.array(np.repeat(np.arange(m), k))
        columns = [
            batch["vec_id"].take(own),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
            pa.array(np.full(m * k, fitted.n, dtype=np.int64)),
            pa.array(fitted.deviation(x), pa.int64()).take(own),
            pa.array(fitted.whiten(x).ravel()),
            pa.array(np.tile(explained, m)),
            pa.array(np.full(m * k, fitted.identity_error)),
        ]
        yield pa.record_batch(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return through_arrow(rows, lambda batch: work(batch) if batch.num_rows else iter(()), ROWS)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
