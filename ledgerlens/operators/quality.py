"""Data-quality reports and previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import shorten
from ..session import materialize

DUPLICATES = "duplicate rows"
ROWS = "rows"


def _copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of times each occurs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of exact copies."""
    return _copies(df).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _digested(df: DataFrame) -> DataFrame:
    """Rows with a 128-bit digest of all columns; equal rows have equal digests."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Nulls do not enter a hash, so the second half is taken over marks of them as well, in reverse.
    marks = [c.isNull() for c in reversed(columns)]
    return df.select(F.xxhash64(*columns).alias("_d1"), F.xxhash64(*marks, *reversed(columns), F.lit(1)).alias("_d2"), F.struct(*columns).alias("_row"))


def _repeated_digests(digested: DataFrame) -> DataFrame:
    """Digests that occur more than once: 16 bytes a row are counted, and what repeats is stored."""
    counted = digested.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return materialize(counted.select("_d1", "_d2"), "repeated-digests")


def digest_copies(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, each with the number of times as ``_copies``.

    Digests are counted first, and whole rows are compared only where a digest repeats, so of a wide table
    little more than the repeated rows is shuffled. The repeated digests are stored: the planner broadcasts them if
    they are few, and otherwise joins on the digest.
    """
    digested = _digested(df)
    suspects = digested.join(_repeated_digests(digested), ["_d1", "_d2"], "left_semi").select("_row.*")
    return _copies(suspects).filter("_copies > 1")


def duplicate_count_by_digest(df: DataFrame) -> DataFrame:
    """``duplicate_count`` with digests first."""
    return digest_copies(df).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def distinct_by_digest(df: DataFrame) -> DataFrame:
    """``dropDuplicates()`` with digests first: rows whose digest is unique are not shuffled where repeats are few."""
    digested = _digested(df)
    repeated = _repeated_digests(digested)
    unique = digested.join(repeated, ["_d1", "_d2"], "left_anti").select("_row.*")
    return unique.unionByName(digested.join(repeated, ["_d1", "_d2"], "left_semi").select("_row.*").dropDuplicates())


def quality_report(df: DataFrame, checks: Mapping[str, Column], duplicates: bool = False) -> DataFrame:
    """One row ``(check, count)`` per named condition, from a single pass over the data.

    With ``duplicates`` the pass first folds exact copies together, so that the number of duplicate
    rows and all the conditions come out of the same aggregation.
    """
    if duplicates:
        weight = F.col("_copies")
        source = _copies(df)
    else:
        weight = F.lit(1).cast("bigint")
        source = df

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")

    counts = {ROWS: total(weight)}
    counts.update({name: total(F.when(condition, weight)) for name, condition in checks.items()})
    if duplicates:
        counts[DUPLICATES] = total(weight - 1)
    wide = source.agg(*[c.alias(name) for name, c in counts.items()])
    return wide.unpivot([], list(counts), "check", "count")


def retail_checks() -> dict[str, Column]:
    return {
        "null CustomerID": F.col("CustomerID").isNull(),
        "Quantity not positive": F.col("Quantity") <= 0,
        "Quantity negative": F.col("Quantity") < 0,
    }


def bank_checks() -> dict[str, Column]:
    return {"null balance": F.col("balance").isNull()}


def gold_checks() -> dict[str, Column]:
    return {
        "null balance": F.col("balance").isNull(),
        "negative balance": F.col("balance") < 0,
        "no retail purchase": F.col("Recency") == 999,
    }


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def preview(df: DataFrame, limit: int = 30) -> DataFrame:
    """Every column as text, long values shortened."""
    return df.select(*[shorten(c, limit).alias(c) for c in df.columns])


def vertical_preview(df: DataFrame, order_by: Sequence[str], n: int = 5, limit: int = 30) -> DataFrame:
    """The first ``n`` rows turned on their side: one output row per row number and column."""
    head = sample_rows(df, order_by, n)
    # The window sees at most n rows.
    numbered = head.withColumn("row_no", F.row_number().over(Window.orderBy(*order_by)))
    texts = numbered.select("row_no", *[shorten(c, limit).alias(c) for c in df.columns])
    return texts.unpivot(["row_no"], df.columns, "column", "value")
