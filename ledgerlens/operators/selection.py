"""Exact quantiles of every group by repeated narrowing, without a sort.

Each pass cuts the stretch that holds a wanted rank at a few splitters, counts the rows of each piece, and keeps
the one piece that holds the rank. Splitters come from a sketch of the rows that are left, so a pass
keeps about the same small share of them however the values are spread; that the result is exact rests on
the counts alone. Values equal to a splitter are a piece of their own, so ties end a search
at once. When few rows are left for every rank, they are counted by value and the ranks read off.

Nothing is placed by range and no group is gathered: counts combine before the shuffle, and only the rows that are
left are written between passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PIECES = 16
# Rows of one stretch that are counted by value.
FEW = 10_000
MOST_PASSES = 40


def _name(p: float) -> str:
    return f"p{p * 100:g}"


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matches = reduce(and_, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, matches).drop(*[f"_right_{k}" for k in keys])


def _pieces(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the piece of their stretch: odd at a splitter, even between two."""
    asked = F.array(*[F.lit(i / PIECES) for i in range(PIECES + 1)])
    cuts = rows.groupBy(*keys).agg(F.kll_sketch_agg_double("_v").alias("_sketch"))
    cuts = cuts.select(*keys, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("_sketch", asked))).alias("_cuts"))
    # One short array per stretch, stored so that the planner knows how little it is.
    cut = _joined(rows, materialize(cuts, "splitters"), keys)
    below = F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(c < F.col("_v"), 2).when(c == F.col("_v"), 1).otherwise(0))
    return cut.withColumn("_piece", below).drop("_cuts")


def select_ranks(rows: DataFrame, ranks: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, rank, value)``: the value at each rank, counted from 0, of each group of ``(*by, value)`` rows.

    ``ranks`` holds ``(*by, rank)``, each once and within the group. A pass is two jobs over the rows that are left.
    """
    keys = [*by, "_at"]
    left = rows.select(*by, F.lit("").alias("_at"), F.col("value").cast("double").alias("_v"))
    # What is still looked for: the stretch a rank lies in and its place there.
    open_ranks = materialize(ranks.select(*by, F.lit("").alias("_at"), "rank", F.col("rank").alias("_place")), "ranks")
    found = []
    for _ in range(MOST_PASSES):
        cut = _pieces(left, keys)
        counts = cut.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        # A few dozen rows per stretch.
        before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        placed = materialize(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "pieces")
        hit = _joined(open_ranks, placed, keys).filter("_place >= _before AND _place < _before + _n")
        hit = materialize(hit.withColumn("_done", F.col("_least") == F.col("_most")), "hit")
        found.append(hit.filter("_done").select(*by, "rank", F.col("_least").alias("value")))
        state = hit.filter("NOT _done").agg(F.count(F.lit(1)), F.max("_n")).first()
        if not state[0]:
            return reduce(DataFrame.unionByName, found)
        kept = hit.filter("NOT _done").select(*keys, "_piece").distinct()
        onward = F.concat_ws(".", "_at", F.col("_piece").cast("string"))
        left = _joined(cut, kept, [*keys, "_piece"]).select(*by, onward.alias("_at"), "_v")
        left = materialize(left, "left")
        open_ranks = hit.filter("NOT _done").select(*by, onward.alias("_at"), "rank", (F.col("_place") - F.col("_before")).alias("_place"))
        open_ranks = materialize(open_ranks, "ranks")
        if state[1] <= FEW:
            break
    else:
        raise RuntimeError(f"ranks were not found in {MOST_PASSES} passes")
    # At most ``FEW`` rows in a window.
    values = left.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = _joined(open_ranks, values, keys).filter("_place >= _before AND _place < _before + _n")
    return reduce(DataFrame.unionByName, [*found, last.select(*by, "rank", F.col("_v").alias("value"))])


def quantiles_by(df: DataFrame, by: Sequence[str], columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``(*by, metric, n, p50, p95, ...)``: linearly interpolated quantiles of each column in each group.

    Null and NaN do not count; a group without values of a column has no row for it. ``by`` may be empty, and may hold
    nulls, which are a group. ``df`` is read three times: give one that is stored. The result is stored.
    """
    keys = [*by, "metric"]
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot(list(by), list(columns), "metric", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    sizes = materialize(values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    places = {p: F.lit(float(p)) * (F.col("n") - 1) for p in probabilities}
    wanted = F.array(*[f(place).cast("bigint") for place in places.values() for f in (F.floor, F.ceil)])
    ranks = sizes.select(*keys, F.explode(F.array_distinct(wanted)).alias("rank"))
    chosen = materialize(select_ranks(values, ranks, keys), "chosen")
    # A few values per group and column.
    held = chosen.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_values"))
    held = _joined(sizes, held, keys)

    def at(place: Column) -> Column:
        low, high = (F.element_at("_values", f(place).cast("bigint")) for f in (F.floor, F.ceil))
        return low + (high - low) * (place - F.floor(place))

    return materialize(held.select(*keys, "n", *[at(place).alias(_name(p)) for p, place in places.items()]), "quantiles")


def winsorize_by(df: DataFrame, by: Sequence[str], columns: Sequence[str], p: float = 0.95) -> DataFrame:
    """Cap each column at its ``p`` quantile within its group; nulls stay null."""
    caps = quantiles_by(df, by, columns, [p]).groupBy(*by).pivot("metric", list(columns)).agg(F.first(_name(p)))
    renamed = caps.withColumnsRenamed({c: f"_cap_{c}" for c in columns} | {k: f"_by_{k}" for k in by})
    same = reduce(and_, [df[k].eqNullSafe(renamed[f"_by_{k}"]) for k in by], F.lit(True))
    capped = {c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.col(f"_cap_{c}"))).alias(c) for c in columns}
    return df.join(renamed, same, "left").select(*[capped.get(c, df[c]) for c in df.columns])
