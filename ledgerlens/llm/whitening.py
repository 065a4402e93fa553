"""Whitening of embeddings from polarised variances.

Covariances come from variances alone: Var(i + j) - Var(i) - Var(j) is twice the covariance of dimensions i and
j. So the fit adds up, for every dimension and every sum of two dimensions, exact squares of centred whole
numbers. The sums are put together to a covariance matrix, which is the size of the dimensions squared and
the only thing that reaches the driver, and its eigenvectors whiten all rows in one pass.

Entries are counted in steps of 1/64. A dimension is centred at the whole number nearest its mean; what that
number is off by is corrected in whole numbers at the end, so every sum is exact however many rows there
are and however they are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 16
# Entries of this many steps and more count as that many, so that sums of squares fit 38 digits.
MOST_STEPS = float(1 << 50)
ROWS_AT_ONCE = 4_096


def in_steps(vector: Column) -> Column:
    """Entries as whole steps above ``-OFFSET``."""

    def steps(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * STEPS, F.lit(MOST_STEPS)), F.lit(-MOST_STEPS))).cast("bigint") + OFFSET

    return F.transform(vector, steps)


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, x)`` of the rows that whitening takes: vectors in steps, without null or non-finite entries.

    Where lengths differ, the most frequent one counts, the longer of equals; rows of other lengths, like null and
    empty vectors, are left out. Repeated rows stay, with whatever id.
    """
    rows = df.select(df[id_col].alias("id"), df[vector_col].alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    found = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("v") == (found["d"] if found else 0)).select("id", in_steps(F.col("v")).alias("x"))


def _nearest_whole(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def squared_sums(y: np.ndarray) -> list[list[int]]:
    """Row i, for j >= i: exact sums of ``(y_i + y_j)^2`` over the rows; where j is i, of ``y_i^2``."""
    dims = y.shape[1]
    # A square of a sum of two is at most four times the largest square.
    largest = int(np.abs(y).max(initial=0))
    if 4 * largest * largest * max(len(y), 1) >= 1 << 63:
        y = y.astype(object)
    out = []
    for i in range(dims):
        own = y[:, i : i + 1]
        sums = own + y[:, i:]
        sums[:, :1] = own
        out.append([int(v) for v in (sums * sums).sum(axis=0)])
    return out


class Whitener:
    """What a fit keeps: counts and sums over the fit list, the covariance in steps, and its eigenvectors."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums, self.covariance = n, sums, covariance
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[: min(components, len(values))]
        self.values, self.vectors = values[order], vectors[:, order]
        trace = float(np.trace(covariance))
        self.explained = [float(v) / trace if trace > 0 else None for v in self.values]
        # What eigh returns for a direction without variance is rounding.
        self.varies = self.values > 1e-12 * max(float(values.max(initial=0.0)), 0.0)
        self.scale = np.where(self.varies, 1 / np.sqrt(np.where(self.varies, self.values, 1)), 0.0)
        # The mean as the nearest whole number and the rest of less than one, so that no digits are lost.
        self.base = np.array([_nearest_whole(s, n) for s in sums], np.int64)
        self.rest = np.array([float(Fraction(s, n) - int(b)) for s, b in zip(sums, self.base, strict=True)])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of rows given in steps."""
        return ((x - self.base).astype(np.float64) - self.rest) @ self.vectors * self.scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact squared distance of ``n`` times the row from the sums; null where that leaves a long."""
        off = x - self.base
        residue = np.array([self.n * int(b) - s for s, b in zip(self.sums, self.base, strict=True)], object)
        largest = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 1 << 63:
            centred = off * self.n + residue.astype(np.int64)
            return (centred * centred).sum(axis=1).tolist()
        centred = off.astype(object) * self.n + residue
        return [v if v < 1 << 63 else None for v in (centred * centred).sum(axis=1)]


def fit(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitener | None, DataFrame]:
    """Fit on the distinct vectors of ``usable`` rows; also the fit list, stored. No rows, no whitener."""
    distinct = materialize(rows.select("x").distinct(), "fit-list")
    entries = distinct.select(F.posexplode("x").alias("i", "x")).groupBy("i")
    total = F.sum(F.col("x").cast("decimal(38,0)"))
    totals = entries.agg(F.count(F.lit(1)).alias("n"), total.alias("s")).orderBy("i").collect()
    if not totals:
        return None, distinct
    n, sums, dims = totals[0]["n"], [int(r["s"]) for r in totals], len(totals)
    base = [_nearest_whole(s, n) for s in sums]

    def squares(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[0] * (dims - i) for i in range(dims)]
        for batch in stream:
            x = _matrix(batch.column("x"), dims) - np.array(base, np.int64)
            for start in range(0, len(x), ROWS_AT_ONCE):
                for own, more in zip(held, squared_sums(x[start : start + ROWS_AT_ONCE]), strict=True):
                    own[:] = map(int.__add__, own, more)
        left = [i for i in range(dims) for _ in range(i, dims)]
        right = [j for i in range(dims) for j in range(i, dims)]
        flat = [q for own in held for q in own]
        kinds = [pa.int32(), pa.int32(), pa.decimal128(38, 0)]
        columns = [pa.array(c, k) for c, k in zip((left, right, flat), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "q"])

    added = distinct.mapInArrow(squares, "i int, j int, q decimal(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q"))
    # How far the centre is off, summed over the rows: less than half of n.
    off = [s - n * b for s, b in zip(sums, base, strict=True)]
    variance: dict[tuple[int, int], Fraction] = {}
    for i, j, q in added.collect():
        gap = off[i] if i == j else off[i] + off[j]
        variance[i, j] = Fraction(n * int(q) - gap * gap, n * n)
    covariance = np.empty((dims, dims))
    for (i, j), v in variance.items():
        covariance[i, j] = covariance[j, i] = float(v if i == j else (v - variance[i, i] - variance[j, j]) / 2)
    return Whitener(n, sums, covariance, components), distinct


def identity_error(whitener: Whitener, fit_list: DataFrame) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity, measured on its rows.

    Components without variance cannot be whitened and are left out.
    """
    dims, k = len(whitener.sums), len(whitener.values)

    def products(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((k, k)), np.zeros(k)
        for batch in stream:
            w = whitener.project(_matrix(batch.column("x"), dims))
            gram += w.T @ w
            total += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([gram.ravel().tolist()]), pa.array([total.tolist()])], ["g", "t"])

    parts = fit_list.mapInArrow(products, "g array<double>, t array<double>")
    entries = parts.select(F.posexplode(F.concat("g", "t")).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    flat = np.array([r["v"] for r in entries.orderBy("at").collect()]) / whitener.n
    mean = flat[k * k :]
    off = np.abs(flat[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k))
    return float(off[np.ix_(whitener.varies, whitener.varies)].max(initial=0.0))


def whiten(
    df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` per usable row and component.

    ``component`` counts from 1 by falling eigenvalue, up to ``components`` or the number of dimensions. The fit list
    is each distinct vector once, so repeated rows do not weigh in, but each gets its own result; ties between
    eigenvalues are in any order, the same for all rows. ``whitened`` is null for a component without variance, as
    are all where there is one distinct vector, and ``explained`` where there is no variance at all; ``deviation`` is
    null where it exceeds a long. Rows that ``usable`` leaves out get no result; an empty table gives none. Entries
    beyond 2^44 in size count as that; other columns are ignored. The matrix held on the driver and by each task
    grows with the square of the dimensions only.
    """
    rows = usable(df, id_col, vector_col)
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    whitener, fit_list = fit(rows, components)
    if whitener is None:
        return df.sparkSession.createDataFrame([], schema)
    error, dims, k = identity_error(whitener, fit_list), len(whitener.sums), len(whitener.values)

    def projected(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = _matrix(part.column("x"), dims)
                each = np.repeat(np.arange(len(x)), k)
                whitened = whitener.project(x).ravel()
                void = np.tile(~whitener.varies, len(x))
                columns = [
                    part.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), whitener.n, np.int64)),
                    pa.array(whitener.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(whitened, mask=void),
                    pa.array(whitener.explained * len(x), pa.float64()),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(projected, schema)

