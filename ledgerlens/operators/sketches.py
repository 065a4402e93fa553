"""Stored sketches: distinct counts and quantiles of any subset, from one bounded summary per group.

A sketch is built once per group when rows arrive; a later question merges stored sketches and never goes back
to the rows. Sizes are bounded by the parameter alone, so the summary table grows with the number of groups,
not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import invoice_ts

LG_BUCKETS = 12
RANK_SKETCH_SIZE = 200
SKETCH = "sketch"
MONTH = "month"


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of a united distinct sketch."""
    return 1.04 / sqrt(1 << lg_buckets)


def distinct_sketch_bytes(lg_buckets: int = LG_BUCKETS) -> int:
    """What a distinct sketch can take up at most: a byte per bucket, and a header."""
    return (1 << lg_buckets) + 64


def rank_error(k: int = RANK_SKETCH_SIZE) -> float:
    """Error of a rank, as a share of the rows, that a quantile of a rank sketch keeps to in 99 cases of 100."""
    return 2.446 / k**0.9433


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """``(*by, column, sketch)``: a mergeable sketch of each column's distinct values per group. Nulls do not count.

    All columns are summarised in one pass, with partial sketches before the shuffle. An empty table gives no rows.
    """
    made = [F.hll_sketch_agg(F.col(c).cast("string"), lg_buckets).alias(f"s{i}") for i, c in enumerate(columns)]
    return _long(df.groupBy(*by).agg(*made), by, columns)


def _long(wide: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias(SKETCH)) for i, c in enumerate(columns)])
    return wide.select(*by, F.inline(pairs))


def customer_month_sketches(lines: DataFrame, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """Distinct invoices and articles of each customer and month; lines without a readable date have a null month."""
    dated = lines.withColumn(MONTH, month(invoice_ts()))
    return distinct_sketches(dated, ["CustomerID", MONTH], ["InvoiceNo", "StockCode"], lg_buckets)


def merged(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Distinct sketches of two tables of one layout as one; values that both have seen count once."""
    by = [c for c in stored.columns if c != SKETCH]
    return stored.unionByName(arrived).groupBy(*by).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def united(sketches: DataFrame, by: Sequence[str], out: str = "estimate") -> DataFrame:
    """``(*by, column, out)``: distinct values of each column, united over all groups that agree on ``by``.

    Any window over the groups is a filter on ``sketches`` before the call.
    """
    whole = sketches.groupBy(*by, "column").agg(F.hll_union_agg(SKETCH).alias(SKETCH))
    return whole.select(*by, "column", F.hll_sketch_estimate(SKETCH).alias(out))


def rolling(sketches: DataFrame, months: int, by: Sequence[str] = (), out: str = "estimate") -> DataFrame:
    """``(*by, month, column, out)``: distinct values in each month that has rows and the ``months - 1`` before it.

    Each stored sketch is sent to the windows it is part of; sketches of one month are united before that.
    """
    monthly = sketches.filter(F.col(MONTH).isNotNull()).groupBy(*by, MONTH, "column").agg(F.hll_union_agg(SKETCH).alias(SKETCH))
    start = F.to_date(F.concat(MONTH, F.lit("-01")))
    windows = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: month(F.add_months(start, k)))
    sent = monthly.withColumn("window", F.explode(windows)).groupBy(*by, "window", "column").agg(F.hll_union_agg(SKETCH).alias(SKETCH))
    there = monthly.select(F.col(MONTH).alias("window")).distinct()
    kept = sent.join(there, "window", "left_semi")
    return kept.select(*by, F.col("window").alias(MONTH), "column", F.hll_sketch_estimate(SKETCH).alias(out))


def rank_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], k: int = RANK_SKETCH_SIZE) -> DataFrame:
    """``(*by, column, sketch)``: a mergeable sketch of the order of each column's values. Null and NaN do not count."""
    made = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        made.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), k).alias(f"s{i}"))
    return _long(df.groupBy(*by).agg(*made), by, columns)


def merged_ranks(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank sketches united over all groups that agree on ``by``; which groups is a filter before the call."""
    return stored.groupBy(*by, "column").agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def sketched_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``(..., p, n, value)`` for each sketch: a value whose rank is ``p`` within ``rank_error``, and the rows it summarises.

    A sketch that has seen no value gives no row.
    """
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    kept = [c for c in sketches.columns if c != SKETCH]
    counted = sketches.withColumn("n", F.kll_sketch_get_n_double(SKETCH)).filter("n > 0")
    pairs = F.arrays_zip(asked.alias("p"), F.kll_sketch_get_quantile_double(SKETCH, asked).alias("value"))
    return counted.select(*kept, "n", F.explode(pairs).alias("q")).select(*kept, "q.p", "n", "q.value")
