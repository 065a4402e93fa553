"""Per-customer rollups, RFM, and the link between bank rows and retail customers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import invoice_ts, wrap_rank
from ..schemas import RFM_DEFAULTS
from ..session import materialize, side_by_side
from .positions import number_rows


def customer_rollup(lines: DataFrame, stored: bool = False) -> DataFrame:
    """Invoices, revenue, last purchase and first country of every retail customer.

    The first country is that of the earliest dated line, and the alphabetically first one if several
    share that time. Keeping a text beside sums would turn every step into a sorting aggregate, so the
    text stays among the keys: lines are folded to invoice, country and date, invoices to customers by
    hash aggregates over numbers alone, and the earliest time is taken per customer and country. Only
    those few rows are then compared by name. Both branches start from the same folded rows.

    They need different columns of them, so one lazy plan of both reads and joins the lines for each.
    With ``stored`` the folded rows are written once and the lines are read once; this runs a job.
    """
    amount = F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("revenue")
    folded = lines.groupBy("CustomerID", "InvoiceNo", "Country", "InvoiceDate").agg(amount)
    dated = folded.select("CustomerID", "InvoiceNo", "Country", "revenue", invoice_ts().alias("ts"))
    if stored:
        dated = materialize(dated, "invoices")
    invoices = dated.groupBy("CustomerID", "InvoiceNo").agg(F.sum("revenue").alias("revenue"), F.max("ts").alias("ts"))
    sums = invoices.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("total_invoices"),
        F.sum("revenue").alias("total_revenue"),
        F.max("ts").alias("last_purchase_date"),
    )
    # A customer is in both branches, so an inner join loses none; a null one is matched as a value.
    firsts = first_countries(dated).withColumnRenamed("CustomerID", "_customer")
    return sums.join(firsts, sums["CustomerID"].eqNullSafe(firsts["_customer"])).drop("_customer")


def first_countries(dated: DataFrame) -> DataFrame:
    """The country of each customer's earliest dated row; undated rows count only if there are no others."""
    seen = dated.groupBy("CustomerID", "Country").agg(F.min("ts").alias("ts"))
    first = F.min(F.struct(F.col("ts").isNull(), "ts", "Country"))
    return seen.groupBy("CustomerID").agg(first["Country"].alias("country"))


def latest(df: DataFrame, column: str) -> Column:
    """The largest value of a column, as a scalar subquery."""
    return df.agg(F.max(column).alias("latest")).scalar()


def _reference(as_of: dt.datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def rfm_from_rollup(rollup: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Recency, frequency and monetary value, read off an existing rollup.

    ``as_of`` defaults to the latest purchase in the rollup. Give a rollup that is stored: the
    default reads it a second time.
    """
    reference = latest(rollup, "last_purchase_date") if as_of is None else _reference(as_of)
    return rollup.select(
        "CustomerID",
        F.datediff(reference, "last_purchase_date").alias("Recency"),
        F.col("total_invoices").alias("Frequency"),
        F.col("total_revenue").alias("Monetary"),
    ).fillna(RFM_DEFAULTS)


def rfm(lines: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """RFM straight from invoice lines.

    Without ``as_of`` the per-customer sums are stored once, so that finding the reference date does
    not scan the lines again; with it the result is one lazy plan.
    """
    invoices = lines.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("revenue"), F.max(invoice_ts()).alias("ts")
    )
    # One row per invoice, so counting rows with a number counts distinct invoices.
    sums = invoices.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("total_invoices"),
        F.sum("revenue").alias("total_revenue"),
        F.max("ts").alias("last_purchase_date"),
    )
    return rfm_from_rollup(materialize(sums, "rfm") if as_of is None else sums, as_of)


def rank_in_group(rows: DataFrame, group: str = "job", order_by: str = "age", key: Sequence[str] = ()) -> DataFrame:
    """Number the rows of each group by ``order_by``; ties follow the key, or all other columns."""
    others = [c for c in rows.columns if c not in (group, order_by)]
    return number_rows(rows, [order_by, *(key or others)], [group])


def number_customers(customers: DataFrame) -> DataFrame:
    """Number the distinct customers 1..N by ``CustomerID``; other columns come along, stored."""
    return number_rows(customers, ["CustomerID"])


def wrap_numbers(ranked: DataFrame, numbered: DataFrame) -> DataFrame:
    """Wrap ranks onto the customer numbers 1..N; every number is null if there are no customers."""
    size = numbered.agg(F.max("row_idx").alias("size")).scalar()
    return ranked.withColumn("row_idx", wrap_rank(F.col("row_idx"), size))


def synthetic_key(bank: DataFrame, numbered: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Give each bank row a customer number: its rank within its job, wrapped onto 1..N.

    There is no real key between the two feeds. Bank rows of different jobs share numbers.
    """
    return wrap_numbers(rank_in_group(bank, key=key), numbered)


def attach_customer_ids(keyed: DataFrame, numbered: DataFrame) -> DataFrame:
    """Left join of the key map on the shared customer number."""
    return keyed.join(numbered.select("row_idx", "CustomerID"), "row_idx", "left")


def attach_rollup(bank: DataFrame, rollup: DataFrame) -> DataFrame:
    """Left join of the per-customer rollup; the join column leads the result."""
    return bank.join(rollup, "CustomerID", "left")


def link_customers(ranked: DataFrame, numbered: DataFrame) -> DataFrame:
    """Bank rows with the retail customer linked to each, from rows and customers already numbered.

    The numbered rollup has one row per customer, so a single join brings in both the customer id
    and the sums.
    """
    linked = wrap_numbers(ranked, numbered).join(numbered, "row_idx", "left")
    bank = [c for c in ranked.columns if c != "row_idx"]
    sums = [c for c in numbered.columns if c not in ("row_idx", "CustomerID")]
    return linked.select("CustomerID", *bank, *sums)


def customer_360(bank: DataFrame, rollup: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Number bank rows and customers, which are independent, and link them."""
    ranked, numbered = side_by_side(
        lambda: rank_in_group(bank, key=key), lambda: number_customers(rollup)
    )
    return link_customers(ranked, numbered)


def join_rfm(silver: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of RFM features, with defaults for rows that have no retail customer."""
    return silver.join(features, "CustomerID", "left").fillna(RFM_DEFAULTS)


def rfm_from_silver(silver: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """The same columns as :func:`join_rfm`, from the sums that silver already carries: no join."""
    return silver.select(
        *silver.columns,
        F.datediff(_reference(as_of), "last_purchase_date").alias("Recency"),
        F.col("total_invoices").alias("Frequency"),
        F.col("total_revenue").alias("Monetary"),
    ).fillna(RFM_DEFAULTS)
