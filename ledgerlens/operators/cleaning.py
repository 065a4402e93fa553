"""Casting, cleaning and de-duplication of the two feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import present, revenue
from ..schemas import BANK_NUMERIC, BANK_REQUIRED, RETAIL_NUMERIC, RETAIL_REQUIRED


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast several columns in one projection; values that do not convert become null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns.

    The same rows as ``dropna`` drops, but as one filter per column, which the planner can push to
    the scan of whichever table a column comes from.
    """
    types = dict(df.dtypes)
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
        if types[c] in ("double", "float"):
            df = df.filter(~F.isnan(c))
    return df


def clean_retail(lines: DataFrame) -> DataFrame:
    """Keep sales: known customer and invoice, positive quantity and price; add ``Revenue``.

    Types are settled first, so that a feed read with inferred types, where one bad value makes a whole
    column text, keeps the same rows as one read with declared types.
    """
    kinds = dict(lines.dtypes)
    types = {c: t for c, t in RETAIL_NUMERIC.items() if kinds.get(c) != t}
    # Text such as "12345.0" is a number, but not yet a whole one.
    texts = {c: "double" for c in types if kinds.get(c) == "string"}
    sales = cast_columns(cast_columns(lines, texts), types) if types else lines
    sales = drop_missing(sales, present(sales, RETAIL_REQUIRED))
    sales = sales.filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    return sales.withColumn("Revenue", revenue())


def clean_bank(rows: DataFrame) -> DataFrame:
    """Numeric columns as doubles, required columns present, exact copies removed.

    Nulls go first: the two steps commute, and the hash aggregate then sees fewer rows.
    """
    typed = cast_columns(rows, {c: "double" for c in present(rows, BANK_NUMERIC)})
    return drop_missing(typed, BANK_REQUIRED).dropDuplicates()


def with_credit_default(df: DataFrame) -> DataFrame:
    """``default`` is a reserved word in SQL; use the name the later layers use."""
    return df.withColumnRenamed("default", "credit_default")
