"""Declared schemas and the layout of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Source schemas of the two CSV feeds.
RETAIL_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

BANK_SCHEMA = T.StructType(
    [
        T.StructField("age", T.DoubleType()),
        T.StructField("job", T.StringType()),
        T.StructField("marital", T.StringType()),
        T.StructField("education", T.StringType()),
        T.StructField("default", T.StringType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("housing", T.StringType()),
        T.StructField("loan", T.StringType()),
        T.StructField("contact", T.StringType()),
        T.StructField("day", T.DoubleType()),
        T.StructField("month", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("campaign", T.DoubleType()),
        T.StructField("pdays", T.DoubleType()),
        T.StructField("previous", T.DoubleType()),
        T.StructField("poutcome", T.StringType()),
        T.StructField("y", T.StringType()),
    ]
)

# Column roles, defaults and formats the results depend on.
INVOICE_DATE_PATTERN = "M/d/yyyy H:mm"
RETAIL_REQUIRED = ("CustomerID", "InvoiceNo", "UnitPrice", "Quantity")
RETAIL_NUMERIC = {"Quantity": "int", "UnitPrice": "double", "CustomerID": "bigint"}
BANK_REQUIRED = ("balance", "age")
BANK_NUMERIC = ("age", "balance", "day", "duration", "campaign", "pdays", "previous")
GOLD_DOUBLE = (*BANK_NUMERIC, "Recency", "Monetary")
CATEGORICAL_FEATURES = (
    "job",
    "marital",
    "education",
    "credit_default",
    "housing",
    "loan",
    "contact",
    "month",
    "poutcome",
)
NUMERIC_FEATURES = (*BANK_NUMERIC, "Recency", "Frequency", "Monetary")
RFM_DEFAULTS = {"Recency": 999, "Frequency": 0, "Monetary": 0.0}
RFM_METRICS = ("Recency", "Frequency", "Monetary")

# Stored tables and the column each is partitioned by; a table's folder and view carry its name.
TABLES = {
    "bronze_retail": "Country",
    "bronze_bank": None,
    "retail_rollup": None,
    "silver": None,
    "gold": "job",
    "segments": None,
    "stream": None,
}
