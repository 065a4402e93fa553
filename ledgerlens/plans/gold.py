"""Gold: RFM and credit features on the customer 360 table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..functions.columns import balance_ratio, present, risk_score, yes_flag
from ..operators.cleaning import cast_columns
from ..operators.customers import (
    join_rfm,
    latest,
    link_customers,
    number_customers,
    rank_in_group,
    rfm_from_silver,
)
from ..schemas import GOLD_DOUBLE
from ..session import side_by_side


def add_credit_features(df: DataFrame) -> DataFrame:
    return df.select(
        *df.columns,
        balance_ratio().alias("debt_to_balance_ratio"),
        yes_flag("housing").alias("has_housing_loan"),
        yes_flag("loan").alias("has_personal_loan"),
        risk_score().alias("risk_score"),
    )


def _typed(df: DataFrame) -> DataFrame:
    return cast_columns(df, {**{c: "double" for c in present(df, GOLD_DOUBLE)}, "Frequency": "bigint"})


def gold_from_join(silver: DataFrame, features: DataFrame) -> DataFrame:
    """Gold from silver and a separate RFM table."""
    return add_credit_features(_typed(join_rfm(silver, features)))


def gold_master(silver: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Gold from silver alone: its rollup columns already hold what RFM needs."""
    return add_credit_features(_typed(rfm_from_silver(silver, as_of)))


def gold_in_one_go(bank: DataFrame, rollup: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Bank rows and a customer rollup straight to gold, without storing silver."""
    ranked, numbered = side_by_side(
        lambda: rank_in_group(bank, key=key), lambda: number_customers(rollup)
    )
    return gold_master(link_customers(ranked, numbered), latest(numbered, "last_purchase_date"))
