"""Row numbers and running totals over sorted data, without sorting in one task.

A window over a constant, or over a key that holds a large share of the rows, sends all of those
rows to one task. Here the rows are range-partitioned on (group, order) instead, so a group of any
size is spread over as many partitions as it needs. Each partition is then summarised by one row per
group, the few summary rows are accumulated, and the totals of the earlier partitions are added back.

The placement is written to the shared folder before it is summarised: range bounds are sampled, and
two evaluations of the same plan need not agree on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# monotonically_increasing_id() keeps the partition number above bit 33.
_PARTITION_SHIFT = 33


def _earlier(groups: Sequence[str], order_by: Sequence[str]):
    window = Window.partitionBy(*groups).orderBy(*order_by)
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _sized(offsets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Let the planner know how large the offsets are.

    Without groups there is at most one row per range partition, which is safe to broadcast. With
    groups there can be as many rows as groups, so they are stored, and the planner broadcasts the
    file or not by its size.
    """
    return materialize(offsets, "offsets") if groups else F.broadcast(offsets)


def _add_offsets(placed: DataFrame, offsets: DataFrame, groups: Sequence[str], part: Column) -> DataFrame:
    """Attach the offsets of each row's group and partition."""
    renamed = offsets.withColumnsRenamed({g: f"_offset_{g}" for g in groups} | {"_part": "_offset_part"})
    conditions = [F.col(g).eqNullSafe(F.col(f"_offset_{g}")) for g in groups]
    matches = reduce(and_, conditions, part == F.col("_offset_part"))
    return placed.join(renamed, matches)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "row_idx",
) -> DataFrame:
    """``row_number()`` over ``partition_by`` ordered by ``order_by``, as a bigint.

    The order should be total. Rows that agree on all of it stay in one partition, so a table that
    may hold many exact copies of a row should be de-duplicated first.
    """
    groups = list(partition_by)
    keys = [*groups, *order_by]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(placed.withColumn("_seq", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_seq", _PARTITION_SHIFT)
    spans = placed.groupBy(*groups, part.alias("_part")).agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = F.coalesce(F.sum("_rows").over(_earlier(groups, ["_part"])), F.lit(0))
    offsets = spans.select(*groups, "_part", (before - F.col("_first") + 1).alias("_shift"))
    joined = _add_offsets(placed, _sized(offsets, groups), groups, part)
    return joined.select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(out))


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    weights: Sequence[str],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add, for each weight ``w``, ``w_before`` (sum over the earlier rows) and ``w_total``."""
    groups = list(partition_by)
    keys = [*groups, *order_by]
    placed = materialize(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "placed")
    spans = placed.groupBy(*groups, "_part").agg(*[F.sum(w).alias(w) for w in weights])
    whole = Window.partitionBy(*groups)
    sums = []
    for w in weights:
        sums.append(F.coalesce(F.sum(w).over(_earlier(groups, ["_part"])), F.lit(0)).alias(f"_{w}_offset"))
        sums.append(F.sum(w).over(whole).alias(f"{w}_total"))
    offsets = _sized(spans.select(*groups, "_part", *sums), groups)
    joined = _add_offsets(placed, offsets, groups, F.col("_part"))
    local = _earlier([*groups, "_part"], order_by)
    totals = []
    for w in weights:
        inside = F.coalesce(F.sum(w).over(local), F.lit(0))
        totals.append((inside + F.col(f"_{w}_offset")).alias(f"{w}_before"))
        totals.append(F.col(f"{w}_total"))
    return joined.select(*df.columns, *totals)
