"""Retail lines and bank rows as projections of the star-schema tables.

A caller may name the columns it needs. All joins are planned all the same: they are inner joins, so
which rows there are must not depend on the columns asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BANK_SCHEMA, RETAIL_SCHEMA

RETAIL_COLUMNS = tuple(RETAIL_SCHEMA.fieldNames())
BANK_COLUMNS = ("c_custkey", *BANK_SCHEMA.fieldNames())

# Column types of the tables, declared so that opening one needs no look at its files.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def retail_raw(spark: SparkSession, sf_dir: str, columns: Sequence[str] = RETAIL_COLUMNS) -> DataFrame:
    """Invoice lines with returns (negative quantity), free items (price 0) and unknown customers."""
    # Attributes are gathered on the smaller tables first, so lines take part in two joins at most.
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(part, lines.l_partkey == part.p_partkey)
    # The date is written out per order, not per line.
    written = F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("o_date_text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", written)
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    orders = orders.join(places, orders.o_custkey == places.c_custkey)
    lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    quantity = F.col("l_quantity").cast("int")
    exprs = {
        "InvoiceNo": lambda: F.col("l_orderkey").cast("string"),
        "StockCode": lambda: F.col("l_partkey").cast("string"),
        "Description": lambda: F.col("p_name"),
        "Quantity": lambda: F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity),
        "InvoiceDate": lambda: F.col("o_date_text"),
        "UnitPrice": lambda: F.when(F.col("p_size") == 25, 0.0).otherwise(F.col("p_retailprice")),
        "CustomerID": lambda: F.when(F.col("l_linenumber") != 7, F.col("o_custkey")),
        "Country": lambda: F.col("n_name"),
    }
    return lines.select(*[exprs[c]().alias(c) for c in columns])


def bank_raw(spark: SparkSession, sf_dir: str, columns: Sequence[str] = BANK_COLUMNS) -> DataFrame:
    """One row per bank customer, an exact second copy of every tenth, some balances missing."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey)
    rows = rows.join(region, rows.n_regionkey == region.r_regionkey)
    bought = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    activity = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum("value").alias("sum_value"),
            F.count_if(F.col("event_type") == "signup").alias("n_signups"),
            F.count_if(bought).alias("n_bought"),
        )
    )
    rows = rows.join(activity, rows.c_custkey == activity.user_id, "left")
    copies = F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("copy", F.explode(copies))

    def yes_when(condition):
        return F.when(condition, "yes").otherwise("no")

    n_events = F.coalesce(F.col("n_events"), F.lit(0))
    exprs = {
        "c_custkey": lambda: key,
        "age": lambda: (18 + key % 60).cast("double"),
        "job": lambda: F.col("c_mktsegment"),
        "marital": lambda: F.when(key % 3 == 0, "single").when(key % 3 == 1, "married").otherwise("divorced"),
        "education": lambda: F.col("r_name"),
        "default": lambda: yes_when(key % 53 == 0),
        "balance": lambda: F.when(key % 20 != 0, F.col("c_acctbal")),
        "housing": lambda: yes_when(key % 2 == 0),
        "loan": lambda: yes_when(key % 5 == 0),
        "contact": lambda: F.when(key % 4 == 0, "telephone").when(key % 4 == 1, "unknown").otherwise("cellular"),
        "day": lambda: (1 + key % 31).cast("double"),
        "month": lambda: F.element_at(
            F.array(*[F.lit(m) for m in "jan feb mar apr may jun jul aug sep oct nov dec".split()]),
            (1 + key % 12).cast("int"),
        ),
        "duration": lambda: F.round(F.coalesce(F.col("sum_value"), F.lit(0.0)), 2),
        "campaign": lambda: n_events.cast("double"),
        "pdays": lambda: F.when(n_events == 0, -1.0).otherwise((key % 400).cast("double")),
        "previous": lambda: F.coalesce(F.col("n_signups"), F.lit(0)).cast("double"),
        "poutcome": lambda: F.when(key % 7 == 0, "success").when(key % 7 == 1, "failure").otherwise("unknown"),
        "y": lambda: yes_when(F.coalesce(F.col("n_bought"), F.lit(0)) > 0),
    }
    return rows.select(*[exprs[c]().alias(c) for c in columns])
