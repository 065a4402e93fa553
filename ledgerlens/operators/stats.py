"""Summary statistics, exact quantiles, capping and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rounded_mean
from ..schemas import RFM_METRICS
from ..session import materialize
from .positions import running_totals


def rounded_means(df: DataFrame, digits: Mapping[str, int], prefix: str = "avg_") -> DataFrame:
    return df.agg(*[rounded_mean(c, n).alias(f"{prefix}{c.lower()}") for c, n in digits.items()])


def overview(silver: DataFrame) -> DataFrame:
    """Size and mean profile of the customer table."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_customers"),
        rounded_mean("age", 1).alias("avg_age"),
        rounded_mean("balance", 0).alias("avg_balance"),
        rounded_mean("duration", 0).alias("avg_call_duration"),
        rounded_mean("campaign", 1).alias("avg_campaign_contact"),
    )


def rfm_means(gold: DataFrame) -> DataFrame:
    return rounded_means(gold, {"Recency": 1, "Frequency": 1, "Monetary": 0})


def group_sizes(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def group_shares(df: DataFrame, by: str) -> DataFrame:
    """Group sizes with the percentage of all rows; the total is summed from the sizes."""
    sizes = group_sizes(df, by)
    total = sizes.agg(F.sum("count").alias("total")).scalar()
    return sizes.withColumn("percent", F.round(F.col("count") * 100.0 / total, 2))


def top_groups(df: DataFrame, by: str, k: int = 5) -> DataFrame:
    """The ``k`` largest groups; equal sizes go by name."""
    return group_sizes(df, by).orderBy(F.desc("count"), by).limit(k)


def _name(p: float) -> str:
    return f"p{p * 100:g}"


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles: one row per column, ``p50``, ``p95``, ... per probability.

    ``percentile`` gathers all distinct values of a column in one buffer. Here equal values are
    counted first and the counts accumulated over range partitions, so that each quantile is picked
    by its position and no task holds a whole column. The few result rows are stored, as callers
    look them up repeatedly.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot([], list(columns), "metric", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    counted = values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counted, ["value"], ["n"], ["metric"])

    def value_at(position: Column) -> Column:
        here = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    found = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        found.append(value_at(F.floor(position)).alias(f"{_name(p)}_low"))
        found.append(value_at(F.ceil(position)).alias(f"{_name(p)}_high"))
    picked = placed.groupBy("metric", "n_total").agg(*found)
    quantiles = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        low, high = F.col(f"{_name(p)}_low"), F.col(f"{_name(p)}_high")
        quantiles.append((low + (high - low) * (position - F.floor(position))).alias(_name(p)))
    return materialize(picked.select("metric", *quantiles), "quantiles")


def winsorize(
    df: DataFrame, columns: Sequence[str], p: float = 0.95, quantiles: DataFrame | None = None
) -> DataFrame:
    """Cap each column at its own ``p`` quantile over the whole frame; nulls stay null."""
    if quantiles is None:
        quantiles = exact_quantiles(df, columns, [p])
    found = [F.max(F.when(F.col("metric") == c, F.col(_name(p)))).alias(c) for c in columns]
    caps = quantiles.agg(F.struct(*found).alias("caps")).scalar()
    capped = {
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), caps.getField(c))).alias(c)
        for c in columns
    }
    return df.select(*[capped.get(c, F.col(c)) for c in df.columns])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width histogram of each column between its minimum and maximum.

    Bins are half open except for the last, which includes the maximum. A constant column gets a
    range of width one around its value. Empty bins are listed with count 0. The frame is read twice,
    for its range and for the counts, and only the counts per bin are shuffled.
    """
    ends = [
        F.struct(
            F.lit(c).alias("metric"), F.min(F.col(c).cast("double")).alias("least"), F.max(F.col(c).cast("double")).alias("most")
        )
        for c in columns
    ]
    ends = df.agg(F.array(*ends).alias("ends")).select(F.inline("ends")).dropna()
    pad = F.when(F.col("least") == F.col("most"), 0.5).otherwise(0.0)
    ranges = ends.select("metric", (F.col("least") - pad).alias("low"), (F.col("most") + pad).alias("high"))
    # One row per column of the frame, small enough to broadcast; both joins below share that broadcast.
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot([], list(columns), "metric", "value").filter(F.col("value").isNotNull())

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("high")).otherwise(F.col("low") + i * ((F.col("high") - F.col("low")) / bins))

    guess = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    guess = F.least(guess, F.lit(bins - 1))
    # The division can land a value that sits on an edge in the neighbouring bin.
    settled = (
        F.when(F.col("value") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("value") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    filled = (
        values.join(F.broadcast(ranges), "metric")
        .withColumn("guess", guess)
        .groupBy("metric", settled.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    every_bin = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    listed = every_bin.join(filled, ["metric", "bin"], "left")
    return listed.select(
        "metric",
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def rfm_histogram(features: DataFrame, p: float = 0.95, bins: int = 40) -> DataFrame:
    """Distribution of each RFM metric, capped at its ``p`` quantile."""
    return histogram(winsorize(features, RFM_METRICS, p), RFM_METRICS, bins)


def best_by(df: DataFrame, name: str, metric: str) -> DataFrame:
    """The name with the largest metric; the alphabetically first of equals."""
    return df.orderBy(F.desc(metric), name).limit(1).select(name, metric)
