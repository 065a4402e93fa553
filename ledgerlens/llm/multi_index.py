"""Nearest neighbours with an inverted multi-index.

The two halves of the vectors are quantised separately with K centroids each; a cell is a pair of
centroids, so K + K centroids give K * K cells. A query goes through the cells in order of the sum of
its squared distances to the two centroids, with a heap over the two sorted centroid lists, until the
cells it has taken hold enough entries, and these are reranked with exact distances.

Equal vectors are one entry with its smallest ids, of which no query needs more than it returns, and
equal queries are one search; a vector that many rows share thus costs what one does. Queries
meet entries by the first half's centroid, with the list of cells each query takes there; a centroid with
many entries is cut into parts, and its queries likewise, so no task gathers one in whole.
Codebooks are fitted on a sample bounded by ``sample``; every row is indexed.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

SAMPLE = 20_000
MOST_CENTROIDS = 256
ROUNDS = 12
CENTROIDS_PER_ROOT = 0.57
# Entries a query looks at. Vectors without any clusters, the worst case, need about this share for nine
# of ten true neighbours (see the README); set it lower for data that has some.
LEAST_ENTRIES, ENTRY_SHARE = 4_000, 0.36
PART = 2_048
SALTS = 64


@dataclass
class Index:
    """Distinct vectors with their cell and smallest ids (``entries``), the codebooks and the number of entries per cell."""

    entries: DataFrame
    codebooks: tuple[np.ndarray, np.ndarray]
    cell_sizes: np.ndarray
    keep: int


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)`` in double precision of rows whose vector can take part."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (
        df.select(df[id_col].cast("long").alias("id"), vector.alias("vector"))
        .filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
        .filter(finite & F.exists("vector", lambda x: x != 0))
        # Minus zero is equal to zero.
        .withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    )


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from evenly spaced starting points of the sorted sample; empty centroids keep their place."""
    points = np.unique(points, axis=0)
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)] or [np.empty(0, np.int64)])


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def build(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, keep: int = 10) -> Index:
    """Index every usable row. ``keep`` is the largest number of neighbours that will be asked for.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
    without id; all others must be of one length. An id with several vectors has an entry for each.
    """
    rows = usable(df, id_col, vector_col)
    # One id more than is returned, since a query's own may be among them.
    distinct = materialize(_with_least_ids(rows, keep + 1), "vectors")
    total = distinct.count()
    share = min(1.0, 1.2 * sample / max(total, 1))
    place = F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) / float(1 << 20)
    drawn = distinct.filter(place < share).select("vector").limit(sample).collect()
    points = np.array([r.vector for r in drawn], float) if drawn else np.empty((0, 2))
    half = points.shape[1] // 2
    k = max(1, min(MOST_CENTROIDS, round(CENTROIDS_PER_ROOT * total**0.5)))
    codebooks = (k_means(points[:, :half], k), k_means(points[:, half:], k))
    n_second = max(len(codebooks[1]), 1)
    schema = T.StructType([*distinct.schema.fields, T.StructField("cell", T.LongType())])
    shipped = df.sparkSession.sparkContext.broadcast((codebooks, points.shape[1]))

    def quantise(stream):
        books, width = shipped.value
        for batch in stream:
            if batch.num_rows:
                x = matrix(batch.column("vector"), width)
                cell = nearest(x[:, : width // 2], books[0]) * n_second + nearest(x[:, width // 2 :], books[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], schema.names)

    entries = materialize(distinct.mapInArrow(quantise, schema), "entries")
    sizes = np.zeros(max(len(codebooks[0]), 1) * n_second, np.int64)
    # At most one row per cell, of which there are at most MOST_CENTROIDS squared.
    for row in entries.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    return Index(entries, codebooks, sizes, keep)


def _with_least_ids(rows: DataFrame, n: int) -> DataFrame:
    """Distinct vectors with their ``n`` smallest ids, pre-combined so that a shared vector is never gathered."""
    # A hot vector is salted by id; a salt keeps its n smallest by rank (a window drops the rest as it
    # sorts, before and after the shuffle), and the few that are left of each salt are merged.
    by_salt = Window.partitionBy("vector", F.pmod("id", F.lit(SALTS))).orderBy("id")
    kept = rows.distinct().withColumn("_rank", F.row_number().over(by_salt)).filter(F.col("_rank") <= n)
    ids = F.slice(F.array_sort(F.collect_list("id")), 1, n)
    return kept.groupBy("vector").agg(ids.alias("ids"))


def cells_of(query: np.ndarray, codebooks: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, enough: int) -> list[int]:
    """Cells by summed distance to their two centroids, nearest first, until they hold ``enough`` entries."""
    half, n_second = len(query) // 2, len(codebooks[1])
    first, second = squared(query[None, :half], codebooks[0])[0], squared(query[None, half:], codebooks[1])[0]
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, taken, held = [(first[a[0]] + second[b[0]], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * n_second + int(b[j])
        if sizes[cell]:
            taken.append(cell)
            held += int(sizes[cell])
        # Pair (i, j) opens (i, j + 1), and the first of a row also opens the next row: each pair once.
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return taken


def search(index: Index, queries: DataFrame, n: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", share: float = ENTRY_SHARE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``n`` nearest entries found for each query row but its own id.

    ``score`` is the Euclidean distance of the given vectors in double precision; ties go to the
    smaller id. Queries that cannot take part, as for ``build``, return nothing; a repeated query row
    counts once. If the index holds no more than ``n`` others, all are returned.
    """
    if n > index.keep:
        raise ValueError("the index keeps too few ids of equal vectors")
    asked = usable(queries, id_col, vector_col).distinct()
    distinct = materialize(asked.groupBy("vector").agg(F.min("id").alias("q")), "queries")
    total = int(index.cell_sizes.sum())
    enough = max(LEAST_ENTRIES, int(share * total))
    shipped = queries.sparkSession.sparkContext.broadcast((index.codebooks, index.cell_sizes))
    n_second = max(len(index.codebooks[1]), 1)
    routed_schema = T.StructType([
        T.StructField("q", T.LongType()), distinct.schema["vector"],
        T.StructField("first", T.LongType()), T.StructField("seconds", T.ArrayType(T.IntegerType())),
    ])

    def route(stream):
        codebooks, sizes = shipped.value
        for batch in stream:
            if not batch.num_rows or not sizes.sum():
                continue
            width = codebooks[0].shape[1] + codebooks[1].shape[1]
            rows, firsts, seconds = [], [], []
            for i, x in enumerate(matrix(batch.column("vector"), width)):
                taken = np.sort(np.array(cells_of(x, codebooks, sizes, enough)))
                own, at = np.unique(taken // n_second, return_index=True)
                rows += [i] * len(own)
                firsts += own.tolist()
                seconds += np.split(taken % n_second, at[1:])
            rows = pa.array(rows, pa.int64())
            columns = [batch.column("q").take(rows), batch.column("vector").take(rows), pa.array(firsts, pa.int64()), pa.array(seconds, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, routed_schema.names)

    routed = materialize(distinct.select("q", "vector").mapInArrow(route, routed_schema), "routed")
    entries = index.entries.select(
        F.expr(f"cell div {n_second}").alias("first"), F.expr(f"cell % {n_second}").cast("int").alias("second"), "vector", "ids"
    )
    # Both sides are cut: every part of a centroid's entries meets every part of its queries once.
    parts = routed.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("query_parts")).join(
        entries.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("entry_parts")), "first"
    )
    spread = lambda other: F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    left = routed.join(parts, "first").select(
        "first", F.pmod(F.xxhash64("q"), F.col("query_parts")).cast("int").alias("qp"), spread("entry_parts").alias("ep"), "q", "vector", "seconds"
    )
    right = entries.join(parts, "first").select(
        "first", spread("query_parts").alias("qp"), F.pmod(F.xxhash64("vector"), F.col("entry_parts")).cast("int").alias("ep"), "second", "vector", "ids"
    )
    found_schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def rerank(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return found_schema_arrow.empty_table()
        width = len(asked.column("vector")[0])
        x, y = matrix(asked.column("vector"), width), matrix(held.column("vector"), width)
        second, ids = held.column("second").to_numpy(), held.column("ids").to_pylist()
        names, wanted = asked.column("q").to_pylist(), asked.column("seconds").to_pylist()
        out_q, out_id, out_score = [], [], []
        for q, own, cells in zip(names, x, wanted, strict=True):
            inside = np.flatnonzero(np.isin(second, cells))
            distances = np.sqrt(((y[inside] - own) ** 2).sum(1))
            near = np.arange(len(inside)) if len(inside) <= n + 1 else np.flatnonzero(distances <= np.partition(distances, n)[n])
            best = heapq.nsmallest(n + 1, ((distances[e], v) for e in near.tolist() for v in ids[inside[e]]))
            out_q += [q] * len(best)
            out_score += [float(s) for s, _ in best]
            out_id += [v for _, v in best]
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_score, pa.float64())], schema=found_schema_arrow)

    found_schema_arrow = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    keys = ["first", "qp", "ep"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rerank, found_schema)
    # One more than asked for, since one of them may be the query's own.
    ranked = _least(found, ["q"], n + 1)
    answers = asked.join(distinct, "vector").select(F.col("id").alias("query_id"), "q").join(ranked, "q").filter("vec_id <> query_id")
    return _least(answers, ["query_id"], n).select("query_id", "rank", "vec_id", "score")


def _least(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the least (score, vec_id) of each group, numbered by ``rank``."""
    window = Window.partitionBy(*by).orderBy("score", "vec_id")
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
