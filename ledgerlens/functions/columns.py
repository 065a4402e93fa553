"""Derived columns. Everything here is a Catalyst expression; there are no UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import INVOICE_DATE_PATTERN


def revenue() -> Column:
    return F.col("Quantity").cast("double") * F.col("UnitPrice")


def invoice_ts(column: str = "InvoiceDate") -> Column:
    """The invoice time; text that is not a date becomes null instead of failing the job."""
    return F.try_to_timestamp(F.col(column), F.lit(INVOICE_DATE_PATTERN))


def yes_flag(column: str) -> Column:
    """1 for ``yes``, 0 for any other text, null for null."""
    return (F.col(column) == "yes").cast("int")


def subscribed_label(column: str = "y") -> Column:
    return F.when(F.trim(F.col(column)) == "yes", 1.0).otherwise(0.0)


def credit_label(default_column: str, balance: str = "balance") -> Column:
    """1.0 for customers in default or overdrawn."""
    # Fixed value: the rule.
    bad = (F.trim(F.col(default_column)) == "yes") | (F.col(balance) < 0)
    return F.when(bad, 1.0).otherwise(0.0)


def balance_ratio(balance: str = "balance") -> Column:
    """``b / (b + 1)`` for a positive balance, else 0.0; null counts as not positive."""
    b = F.col(balance)
    # Fixed value: the formula.
    return F.when(b > 0, (b / (b + 1)).cast("double")).otherwise(0.0)


def risk_score(default_column: str = "credit_default", balance: str = "balance") -> Column:
    # Fixed value: the rule.
    return F.when(F.col(default_column) == "yes", 1).when(F.col(balance) < 0, 1).otherwise(0)


def segment_band(recency: Column, monetary: Column) -> Column:
    """Name a segment by its mean recency and spend; the first matching band wins."""
    # Band thresholds.
    return (
        F.when((recency < 30) & (monetary > 2000), "VIP")
        .when((recency < 90) & (monetary > 500), "Active")
        .when(recency > 200, "At Risk")
        .otherwise("Regular")
    )


def mean(column: str) -> Column:
    """Plain average: any finite value counts as it is, and NaN or infinity shows in the result."""
    return F.avg(F.col(column).cast("double"))


def rounded_mean(column: str, digits: int) -> Column:
    """The average for print, with at most six digits.

    The last bits of a sum of doubles depend on the order of the rows. Rounding to six digits first
    takes them off, so that an average on a rounding tie prints the same in any order.
    """
    return F.round(F.round(mean(column), 6), digits)


def shorten(column: str, limit: int = 30) -> Column:
    """Text cut to ``limit`` characters with an ellipsis; shorter text is left alone."""
    text = F.col(column).cast("string")
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that the frame has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def wrap_rank(rank: Column, size: Column) -> Column:
    """Map rank 1, 2, 3, ... onto 1..size, starting at 2; null when there is nothing to map onto."""
    return F.try_mod(rank, size) + 1
