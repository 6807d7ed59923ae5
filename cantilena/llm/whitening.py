"""Whitening of embeddings: principal directions of a covariance that is accumulated in twice the precision of a double.

Entries become integers, so sums and means are exact (a mean is a double and what a double leaves of it). A task centres its vectors, splits each centred number
into slices of few bits without any error, and multiplies slices: sums of such products fit into a double's bits exactly, or their error is far below
those of double-doubles. They are added to the task's total, a high and a low part, by two-sums, which lose nothing. Tasks' totals are merged in two levels, high and low
parts by two-sums again, so the driver sees MERGES rows, whatever the input. The eigen-solve is LAPACK's: tridiagonal, then divide and conquer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keeps_columns

#: How entries become integers, groups that tasks' totals are merged in, bits of a slice, rows of an exact product: 2 * BITS + log2(ROWS) <= 53.
SCALE, SHIFT = 1024, 100_000
MERGES, BITS, ROWS = 16, 20, 4096
COMPONENTS = 8


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b as its double and the exact rest."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def two_product(a: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
    """a * b as its double and the exact rest: both factors are split into halves whose products are exact."""
    halves = lambda x: (h := (t := x * 134217729.0) - (t - x), x - h)
    p, (a1, a2), (b1, b2) = a * b, halves(a), halves(b)
    return p, ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2


class Total:
    """A sum of arrays in double-doubles."""

    def __init__(self, shape: tuple[int, ...]):
        self.high, self.low = np.zeros(shape), np.zeros(shape)

    def add(self, high: np.ndarray, low: np.ndarray | float = 0.0) -> None:
        s, rest = two_sum(self.high, high)
        self.high, self.low = two_sum(s, self.low + (rest + low))


def slices(y: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """y + rest as three parts: two of BITS bits below the largest |y| of a column, and what they leave. The first two subtractions are exact."""
    unit = np.ldexp(1.0, np.frexp(np.abs(y).max(axis=0, initial=0.0))[1] - BITS)
    first = np.rint(y / unit) * unit
    left = y - first
    second = np.rint(left / unit * 2.0**BITS) * (unit * 2.0**-BITS)
    return first, second, (left - second) + rest


def add_products(total: Total, x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> None:
    """Adds the outer products of the centred rows of x."""
    for at in range(0, len(x), ROWS):
        y, rest = two_sum(x[at : at + ROWS].astype(float), np.broadcast_to(-mean[0], x[at : at + ROWS].shape))
        a, b, c = slices(y, rest - mean[1])
        ab, ac, bc = a.T @ b, a.T @ c, b.T @ c
        for part in (a.T @ a, ab, ab.T, b.T @ b, ac, ac.T, bc, bc.T, c.T @ c):
            total.add(part)


def integers(vector: str = "embedding") -> Column:
    """Entries as integers: floor(SCALE * entry) + SHIFT; null for a vector that is null, empty, or holds nulls or numbers that aren't finite."""
    v = F.col(vector)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    exact = F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long") + SHIFT)
    return F.when(v.isNull() | (F.size(v) == 0) | F.exists(v, bad), None).otherwise(exact)


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    mean: tuple[np.ndarray, np.ndarray]
    values: np.ndarray  # the eigenvalues kept, falling
    directions: np.ndarray  # their unit vectors, as columns
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Components of rows of integers; not a number where a component has no spread."""
        y = (x - self.mean[0]) - self.mean[1]
        scale = np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return (y @ self.directions) / scale


def exact_mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    exact = [Fraction(s, max(n, 1)) for s in sums]
    high = [float(m) for m in exact]
    return np.array(high), np.array([float(m - Fraction(h)) for m, h in zip(exact, high, strict=True)])


def covariance(rows: DataFrame, d: int, mean: tuple[np.ndarray, np.ndarray], n: int, how: Whitening | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The covariance of rows (x) of d integers, divisor n, as high and low parts; with how, that of their whitened components, centred at mean."""

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["x"].tolist(), dtype=np.int64)
                x = np.nan_to_num(how.whitened(x)) if how else x
                total = total or Total((x.shape[1], x.shape[1]))
                add_products(total, x, mean)
        if total is not None:
            yield pd.DataFrame({"grp": [TaskContext.get().partitionId() % MERGES], "high": [total.high.ravel()], "low": [total.low.ravel()]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = Total(np.shape(pdf["high"].iloc[0]))
        for high, low in zip(pdf["high"], pdf["low"], strict=True):
            total.add(np.asarray(high), np.asarray(low))
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "high": [total.high], "low": [total.low]})

    schema = "grp int, high array<double>, low array<double>"
    total = Total((d * d,))
    for r in rows.select("x").mapInPandas(totals, schema).groupBy("grp").applyInPandas(merged, schema).sort("grp").collect():  # MERGES rows at most
        total.add(np.array(r["high"]), np.array(r["low"]))
    high = total.high / n
    back, rest = two_product(high, float(n))
    return high.reshape(d, d), ((total.high - back - rest + total.low) / n).reshape(d, d)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of rows (x): arrays of as many integers each."""
    got = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum("v").alias("s")).sort("i").collect()  # a row a dimension
    n, sums = (got[0]["n"] if got else 0), [r["s"] for r in got]
    mean = exact_mean(sums, n)
    if not n:
        return Whitening(0, (), mean, np.zeros(0), np.zeros((0, 0)), 0.0)
    high, low = covariance(rows, len(sums), mean, n)
    values, vectors = np.linalg.eigh(high + low)  # syevd: Householder to tridiagonal form, Cuppen's divide and conquer
    values, vectors = values[::-1][:components].copy(), vectors[:, ::-1][:, :components]
    trace = float(sum(Fraction(a) + Fraction(b) for a, b in zip(high.diagonal().tolist(), low.diagonal().tolist(), strict=True)))
    values[values <= len(sums) * np.finfo(float).eps * trace] = 0.0  # no spread beyond rounding
    return Whitening(n, tuple(sums), mean, values, vectors, trace)


def identity_error(rows: DataFrame, how: Whitening) -> float:
    """The largest entry of the whitened components' covariance over rows (x) less the identity, over the components with spread; measured, not derived."""
    spread = how.values > 0
    if not how.n or not spread.any():
        return 0.0
    k = len(how.values)
    zero = np.zeros(k)
    # The mean of the components is 0 but for rounding; both parts of it are taken off again here.
    shift = how.whitened(np.array([how.mean[0]])).ravel()
    high, low = covariance(rows, k, (np.nan_to_num(shift), zero), how.n, how)
    return float(np.abs((high + low - np.eye(k))[spread][:, spread]).max())


def deviations(x: np.ndarray, how: Whitening) -> list[int | None]:
    """The sum over dimensions of (n * x - S) ** 2, exact; None beyond a long."""
    sums, top = np.array(how.sums, dtype=np.int64), 2**63 - 1
    near = ((x * float(how.n) - sums) ** 2).sum(1)
    if (near < top / 2).all() and float(np.abs(x).max(initial=0)) * how.n < top / 2:
        return ((x * how.n - sums) ** 2).sum(1).tolist()
    exact = [sum((how.n * a - s) ** 2 for a, s in zip(row, how.sums, strict=True)) for row in x.tolist()]
    return [e if e <= top else None for e in exact]


@keeps_columns
def whitened(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """table with n, deviation, identity_error and parts: an array of (component, whitened, explained) for each of up to `components` directions, by falling spread.

    Rows whose vector is null or empty, or holds a null or a number that isn't finite, go; so do vectors of another length than the commonest (of equally common ones
    the longest). Repeated rows count as often as they come; equal spreads keep the solver's order. A direction without spread (fewer rows than dimensions, equal
    vectors) has null for whitened and 0 for explained. A deviation beyond a long is null. An empty table, or one without a good vector, gives no rows. Columns of
    these names are replaced. Four passes over the vectors, no shuffle of them; the state is d * d.
    """
    from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

    named = ["n", "deviation", "identity_error", "parts"]
    good = table.drop(*[c for c in named if c != vector]).withColumn("_x", integers(vector)).where("_x is not null")
    if vector in named:
        good = good.drop(vector)
    common = good.groupBy(F.size("_x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    good = good.where(F.size("_x") == (common["d"] if common else 0))
    fitted = good.select(F.col("_x").alias("x"))
    how = fit(fitted, components)
    error, k = identity_error(fitted, how), len(how.values)
    explained = [float(v / how.trace) if how.trace else 0.0 for v in how.values]
    part = StructType([StructField("component", IntegerType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType())])
    schema = StructType([*[f for f in good.schema.fields if f.name != "_x"], StructField("deviation", LongType()), StructField("_w", ArrayType(DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array(pdf.pop("_x").tolist(), dtype=np.int64).reshape(len(pdf), -1)
            if not len(x):
                continue
            w = [[None if v != v else v for v in row] for row in how.whitened(x).tolist()]
            yield pdf.assign(deviation=pd.array(deviations(x, how), dtype="Int64"), _w=w)

    out = good.mapInPandas(run, schema)
    parts = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col("_w")[i].alias("whitened"), F.lit(explained[i]).alias("explained")) for i in range(k)]) if k else F.array().cast(ArrayType(part))
    return out.select(*[c for c in out.columns if c != "_w"], F.lit(how.n).cast("long").alias("n"), F.lit(error).alias("identity_error"), parts.alias("parts"))
