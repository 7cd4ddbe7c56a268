"""Whitening of embeddings with a compensated covariance.

Three passes over the vectors, each a sum per task that Spark merges. The first adds up whole numbers exactly. The
second subtracts the mean, held in double-double (an unevaluated sum of two doubles), multiplies each two dimensions without error
(Dekker's splitting) and adds the products in double-double (Knuth's two-sum), pairwise within a block of rows; the
tasks' high and low parts are added the same way. The third measures what came out.

The dims x dims matrix is all that reaches the driver. Its eigenvectors come from LAPACK's divide-and-conquer
solver for symmetric matrices (``numpy.linalg.eigh`` calls ``syevd``): reduction to a tridiagonal matrix, which is
cut in halves whose solutions are joined through the secular equation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import stage

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Integers beyond this have no room in a block's exact sums; larger ones stop there.
LIMIT = 1 << 48
#: Rows multiplied at once. Shares into which the tasks' parts of a row are dealt for merging.
BLOCK, SHARES = 2_048, 16
#: Eigenvalues below this share of the trace are rounding, not variance: their components are zero.
FLOOR = 1e-13
SPLIT = float((1 << 27) + 1)


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b, and exactly what rounding took from it."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def fast_two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for abs(a) >= abs(b)."""
    s = a + b
    return s, b - (s - a)


def halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a as a sum of two numbers of 26 bits, whose products are exact."""
    c = SPLIT * a
    high = c - (c - a)
    return high, a - high


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two double-doubles."""
    s, e = two_sum(a[0], b[0])
    t, f = two_sum(a[1], b[1])
    s, e = fast_two_sum(s, e + t)
    return fast_two_sum(s, e + f)


def fold(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over the first axis, in pairs."""
    while len(high) > 1:
        n = len(high) // 2
        odd = (high[2 * n :], low[2 * n :])
        high, low = add((high[:n], low[:n]), (high[n : 2 * n], low[n : 2 * n]))
        if len(odd[0]):
            high, low = np.concatenate([high, odd[0]]), np.concatenate([low, odd[1]])
    return high[0], low[0]


def outer_sum(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over rows of each two columns' product, upper triangle by rows; the columns are double-doubles."""
    d = high.shape[1]
    ah, al = halves(high)
    parts = []
    for i in range(d):
        a, b = slice(i, i + 1), slice(i, d)
        p = high[:, a] * high[:, b]
        e = ((ah[:, a] * ah[:, b] - p) + ah[:, a] * al[:, b] + al[:, a] * ah[:, b]) + al[:, a] * al[:, b]
        parts.append(fold(*fast_two_sum(p, e + (high[:, a] * low[:, b] + low[:, a] * high[:, b]))))
    return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])


def as_pair(x: Fraction) -> tuple[float, float]:
    high = float(x)
    return high, float(x - Fraction(high))


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """x - mean in double-double."""
    s, e = two_sum(x, -mean[0])
    return fast_two_sum(s, e - mean[1])


def _matrix(b: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    lists = b.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(column: str, dims: int):
    """Per task and dimension the exact sum of whole numbers, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for b in batches:
            x = _matrix(b, column, dims)
            for lo in range(0, len(x), 4_096):
                total = [t + s for t, s in zip(total, x[lo : lo + 4_096].sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([str(t) for t in total])], names=["dim", "total"])

    return run


def _double_sums(column: str, dims: int, mean: tuple[np.ndarray, np.ndarray] | None):
    """Per task the sum of vectors (without ``mean``) or of centred outer products, a row for each ``row`` of the triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _matrix(b, column, dims).astype(np.float64)
            for lo in range(0, len(x), BLOCK):
                block = x[lo : lo + BLOCK]
                got = fold(block, np.zeros_like(block)) if mean is None else outer_sum(*centred(block, mean))
                total = got if total is None else add(total, got)
        if total is not None:
            yield from _rows(total, dims, mean is None)

    return run


def _rows(total: tuple[np.ndarray, np.ndarray], dims: int, single: bool) -> Iterator[pa.RecordBatch]:
    cuts = [0, dims] if single else np.cumsum([0, *range(dims, 0, -1)])
    at = list(zip(cuts[:-1], cuts[1:], strict=True))
    yield pa.RecordBatch.from_arrays([pa.array(range(len(at)), pa.int32()), *[pa.array([v[a:b] for a, b in at], pa.list_(pa.float64())) for v in total]], names=["row", "high", "low"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the tasks' parts of each row; one part a row is held."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for row, high, low in zip(b.column("row").to_pylist(), b.column("high"), b.column("low"), strict=True):
            part = (high.values.to_numpy(), low.values.to_numpy())
            held[row] = add(held[row], part) if row in held else part
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), *[pa.array([v[i] for v in held.values()], pa.list_(pa.float64())) for i in (0, 1)]], names=["row", "high", "low"])


PARTS = "row int, high array<double>, low array<double>"


def double_sum(vectors: DataFrame, column: str, dims: int, mean: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Over all vectors, in double-double: their sum, or with ``mean`` the sum of centred outer products (dims x dims)."""
    parts = vectors.select(column).mapInArrow(_double_sums(column, dims, mean), PARTS)
    # merged twice, so that no task reads more than a share of the tasks' parts
    spread = parts.withColumn("share", F.spark_partition_id() % SHARES).repartition("row", "share").drop("share").mapInArrow(_merge, PARTS)
    rows = sorted(spread.repartition("row").mapInArrow(_merge, PARTS).collect(), key=lambda r: r.row)  # dims rows
    high, low = (np.concatenate([np.array(r[i]) for r in rows]) for i in ("high", "low"))
    if mean is None:
        return high, low
    full = tuple(np.zeros((dims, dims)) for _ in range(2))
    for out, flat in zip(full, (high, low), strict=True):
        at = np.triu_indices(dims)
        out[at] = flat
        out[(at[1], at[0])] = flat
    return full


@dataclass
class Whitening:
    """n vectors, exact sums per dimension, mean and covariance in double-double, components (rows) with their variances."""

    n: int
    sums: list[int]
    mean: tuple[np.ndarray, np.ndarray]
    covariance: tuple[np.ndarray, np.ndarray]
    components: np.ndarray
    variances: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        trace = float(np.trace(self.covariance[0]))
        return self.variances / trace if trace > 0 else np.zeros_like(self.variances)

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(variance), 0 for components without variance."""
        return np.where(self.explained > FLOOR, 1 / np.sqrt(np.where(self.explained > FLOOR, self.variances, 1.0)), 0.0)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, x: the whole numbers of vectors that are not null or empty, without null or non-finite entries, and of the most frequent length (of equals the larger)."""
    c = F.col("embedding").cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = lambda v: F.greatest(F.least(F.floor(v * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)) + SHIFT
    good = vectors.select("vec_id", c.alias("c")).where((F.size("c") > 0) & ~F.exists("c", bad))
    return good.select("vec_id", F.transform("c", whole).cast("array<bigint>").alias("x"))


def fit(rows: DataFrame, dims: int) -> Whitening:
    """``rows``: vectors x of whole numbers, all of ``dims`` entries."""
    n = rows.count()
    parts = rows.select("x").mapInArrow(_sums("x", dims), "dim int, total string")
    totals = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # dims rows
    sums = [int(r.total) for r in sorted(totals, key=lambda r: r.dim)]
    pairs = [as_pair(Fraction(s, n)) for s in sums]
    mean = tuple(np.array([p[i] for p in pairs]) for i in (0, 1))
    high, low = double_sum(rows, "x", dims, mean)
    exact = [[as_pair((Fraction(float(a)) + Fraction(float(b))) / n) for a, b in zip(x, y, strict=True)] for x, y in zip(high, low, strict=True)]
    v = tuple(np.array([[p[i] for p in row] for row in exact]) for i in (0, 1))
    values, vectors = np.linalg.eigh(v[0])
    order = np.argsort(-values, kind="stable")
    return Whitening(n, sums, mean, v, vectors[:, order].T.copy(), np.maximum(values[order], 0.0))


def _project(model: Whitening, components: int):
    axes, scale = model.components[:components].copy(), model.scales[:components]
    n, sums, mean = model.n, np.array(model.sums, object), model.mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, "x", len(sums))
            y = (centred(x.astype(np.float64), mean)[0] @ axes.T) * scale
            deviation = []
            for lo in range(0, len(x), BLOCK):
                d = x[lo : lo + BLOCK].astype(object) * n - sums  # Python's whole numbers
                deviation += (d * d).sum(axis=1).tolist()
            fits = [int(v) if v < 1 << 63 else None for v in deviation]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(fits, pa.int64()), pa.array(list(y), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component (from 1, at most ``components``): vec_id, component, n, deviation, whitened, explained, identity_error.

    ``vectors``: vec_id, embedding. Vectors that are null or empty or hold null or non-finite entries are left out,
    as are those of another length than most; rows that repeat count each; other columns are ignored. A component without variance (a
    share of the trace below ``FLOOR``, as for equal vectors) is zero for all rows and takes no part in identity_error.
    ``deviation`` is null where it passes 2**63 - 1. Entries stop at 2**48 in size. Without any vector the result is empty.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["vec_id"]
    rows = stage(usable(vectors), "whiten_rows")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    dims = lengths.dims
    rows = rows.where(F.size("x") == dims)
    model = fit(rows, dims)
    components = min(components, dims)
    out = stage(rows.mapInArrow(_project(model, components), f"vec_id {kind}, deviation long, whitened array<double>"), "whitened")

    total = double_sum(out, "whitened", components)
    mean = tuple(np.array([as_pair((Fraction(float(a)) + Fraction(float(b))) / model.n)[i] for a, b in zip(*total, strict=True)]) for i in (0, 1))
    high, _ = double_sum(out, "whitened", components, mean)
    live = model.scales[:components] > 0
    error = float(np.abs((high / model.n - np.eye(components))[np.ix_(live, live)]).max()) if live.any() else 0.0

    explained = F.array(*[F.lit(float(e)) for e in model.explained[:components]])
    each = out.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return each.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"),
    )
