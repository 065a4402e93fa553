"""One function per registered query, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import cleaning, customers, exact, features, metrics, model_tables, models, quality, segments, selection, sketches, stats
from ledgerlens.plans import gold as gold_plan
from ledgerlens.plans import pipeline, reports
from ledgerlens.schemas import BANK_SCHEMA, RETAIL_REQUIRED, RFM_METRICS
from ledgerlens.session import materialize, new_path
from ledgerlens.sources import csv, tables
from ledgerlens.sources.bindings import bank_raw, retail_raw, table
from ledgerlens.streaming import ingest

from .oracle import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEY = ["c_custkey"]
BANK_COLUMNS = BANK_SCHEMA.fieldNames()
PROBABILITIES = [0.5, 0.95, 0.99]
CLUSTERS_SQL = ", clustered AS (SELECT *, CAST(CustomerID % 4 AS INTEGER) AS segment_cluster FROM rfm)\n"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# Inputs shared by the queries ------------------------------------------------------------------


def sales(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    """Clean retail lines with the columns every customer figure needs, and any others named."""
    wanted = dict.fromkeys(["InvoiceNo", "Quantity", "UnitPrice", "CustomerID", *extra])
    return cleaning.clean_retail(retail_raw(spark, d, list(wanted)))


def dated_sales(spark: SparkSession, d: str) -> DataFrame:
    return sales(spark, d, "InvoiceDate")


def full_sales(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_retail(retail_raw(spark, d))


def bank(spark: SparkSession, d: str, *only: str) -> DataFrame:
    """Clean bank rows: whole rows are de-duplicated, then the named columns are taken."""
    rows = cleaning.clean_bank(bank_raw(spark, d))
    if only:
        rows = rows.select(*dict.fromkeys([*KEY, "age", "balance", *only]))
    return cleaning.with_credit_default(rows)


def rollup(spark: SparkSession, d: str) -> DataFrame:
    return materialize(customers.customer_rollup(sales(spark, d, "InvoiceDate", "Country"), stored=True), "rollup")


def rfm(spark: SparkSession, d: str) -> DataFrame:
    return customers.rfm(dated_sales(spark, d))


def silver(spark: SparkSession, d: str, *only: str) -> DataFrame:
    sums = customers.customer_rollup(sales(spark, d, "InvoiceDate", "Country"), stored=True)
    return customers.customer_360(bank(spark, d, *(["job", *only] if only else [])), sums, KEY)


def gold(spark: SparkSession, d: str) -> DataFrame:
    lines = sales(spark, d, "InvoiceDate", "Country")
    return gold_plan.gold_in_one_go(bank(spark, d), customers.customer_rollup(lines, stored=True), KEY)


def stored_gold(spark: SparkSession, d: str) -> DataFrame:
    """Training reads its table many times, so it starts from a stored copy, as the pipeline does."""
    return materialize(gold(spark, d), "gold")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def rounded(df: DataFrame, digits: int = 2, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


# Sources ---------------------------------------------------------------------------------------


@query("scan_csv", sql("SELECT * REPLACE (CAST(CustomerID AS DOUBLE) AS CustomerID) FROM retail", "retail"))
def scan_csv(spark, d):
    path = new_path(spark, "retail-csv")
    csv.write_csv(retail_raw(spark, d), path)
    return csv.read_retail(spark, path)


@query("scan_csv_sep", sql("SELECT * EXCLUDE (c_custkey) FROM bank", "bank"))
def scan_csv_sep(spark, d):
    path = new_path(spark, "bank-csv")
    csv.write_csv(bank_raw(spark, d, BANK_COLUMNS), path, sep=";")
    return csv.read_bank(spark, path)


@query("scan_table", sql("SELECT * FROM bank_clean", "bank_clean"))
def scan_table(spark, d):
    store = tables.Warehouse(spark, new_path(spark, "warehouse"))
    store.save("bronze_bank", bank(spark, d))
    return store.load("bronze_bank")


@query(
    "scan_csv_headers",
    sql(
        """
SELECT CAST(age AS DOUBLE) AS age, job, CASE WHEN c_custkey % 2 = 0 THEN balance END AS balance,
       CASE WHEN c_custkey % 2 = 1 THEN housing END AS housing, y
FROM bank
""",
        "bank",
    ),
)
def scan_csv_headers(spark, d):
    """One folder, two headers: columns in another order, one that is missing, one that is new."""
    path, rows = new_path(spark, "bank-csv"), bank_raw(spark, d)
    csv.write_csv(rows.filter("c_custkey % 2 = 0").select("job", "age", "balance", "y"), path, sep=";", mode="append")
    csv.write_csv(rows.filter("c_custkey % 2 = 1").select("y", "housing", "age", "job", "month"), path, sep=";", mode="append")
    return csv.read_mixed_csv(spark, path, "age double, job string, balance double, housing string, y string", sep=";")


@query(
    "optional_columns",
    sql(
        "SELECT job, education, credit_default, housing, age, balance, duration, campaign FROM bank_clean",
        "bank_clean",
    ),
)
def optional_columns(spark, d):
    rows = bank(spark, d, "job", "education", "default", "housing", "duration", "campaign")
    categorical, numeric = features.subscription_features(rows)
    return rows.select(*categorical, *numeric)


# Sinks -----------------------------------------------------------------------------------------


@query("sink_overwrite", sql("SELECT c_custkey, job, balance FROM bank_clean", "bank_clean"))
def sink_overwrite(spark, d):
    path = new_path(spark, "table")
    tables.overwrite_table(bank(spark, d, "marital"), path)
    tables.overwrite_table(bank(spark, d, "job").select("c_custkey", "job", "balance"), path)
    return tables.read_table(spark, path)


@query(
    "sink_partitioned",
    sql("SELECT InvoiceNo, Quantity, UnitPrice, CustomerID, Revenue, Country FROM clean", "clean"),
)
def sink_partitioned(spark, d):
    path = new_path(spark, "table")
    tables.overwrite_table(sales(spark, d, "Country"), path, partition_by="Country")
    return tables.read_table(spark, path)


@query(
    "sink_partition_rewrite",
    sql(
        """
SELECT InvoiceNo, Quantity, UnitPrice, CustomerID, Revenue, Country FROM clean
WHERE Country <> 'FRANCE' OR Quantity > 10
""",
        "clean",
    ),
)
def sink_partition_rewrite(spark, d):
    """One country is rewritten with some of its lines; the others stay as they are stored."""
    path, lines = new_path(spark, "table"), sales(spark, d, "Country")
    tables.overwrite_table(lines, path, partition_by="Country")
    tables.overwrite_partitions(lines.filter("Country = 'FRANCE' AND Quantity > 10"), path)
    return tables.read_table(spark, path)


@query("sink_replace_schema", sql("SELECT * FROM bank_clean", "bank_clean"))
def sink_replace_schema(spark, d):
    path = new_path(spark, "table")
    tables.overwrite_table(bank(spark, d, "job"), path)
    tables.overwrite_table(bank(spark, d), path, replace_schema=True)
    return tables.read_table(spark, path)


@query("sink_csv", sql("SELECT * REPLACE (round(Monetary, 2) AS Monetary) FROM rfm", "rfm"))
def sink_csv(spark, d):
    path = new_path(spark, "csv")
    csv.write_csv(rounded(rfm(spark, d), 2, "Monetary"), path)
    return csv.read_csv(spark, path, "CustomerID bigint, Recency int, Frequency bigint, Monetary double")


@query(
    "sample_rows",
    sql(
        """
SELECT CustomerID, age, job, balance, Recency, Frequency, round(Monetary, 2) AS Monetary, y
FROM gold ORDER BY c_custkey LIMIT 5
""",
        "gold",
    ),
)
def sample_rows(spark, d):
    head = quality.sample_rows(gold(spark, d), KEY, 5)
    return rounded(head.select("CustomerID", "age", "job", "balance", *RFM_METRICS, "y"), 2, "Monetary")


# Projections, filters, cleaning ----------------------------------------------------------------


@query("project", sql("SELECT c_custkey, age, job, balance, y FROM bank_clean", "bank_clean"))
def project(spark, d):
    return bank(spark, d, "job", "y").select("c_custkey", "age", "job", "balance", "y")


@query(
    "revenue_lines",
    sql("SELECT InvoiceNo, CustomerID, Quantity, UnitPrice, round(Revenue, 2) AS Revenue FROM clean", "clean"),
)
def revenue_lines(spark, d):
    lines = sales(spark, d).select("InvoiceNo", "CustomerID", "Quantity", "UnitPrice", "Revenue")
    return rounded(lines, 2, "Revenue")


@query("rename_default", sql('SELECT c_custkey, "default" AS credit_default FROM bank', "bank"))
def rename_default(spark, d):
    return cleaning.with_credit_default(bank_raw(spark, d, ["c_custkey", "default"]))


@query("drop_column", sql("SELECT * EXCLUDE (rank_in_job) FROM ranked", "ranked"))
def drop_column(spark, d):
    return customers.rank_in_group(bank(spark, d), key=KEY).drop("row_idx")


@query(
    "cast_numeric",
    sql(
        """
SELECT TRY_CAST(InvoiceNo AS BIGINT) AS InvoiceNo, TRY_CAST(Country AS DOUBLE) AS Country,
       CAST(Quantity AS DOUBLE) AS Quantity, CAST(UnitPrice AS INTEGER) AS UnitPrice
FROM (SELECT * REPLACE (trunc(UnitPrice) AS UnitPrice) FROM retail)
""",
        "retail",
    ),
)
def cast_numeric(spark, d):
    lines = retail_raw(spark, d, ["InvoiceNo", "Country", "Quantity", "UnitPrice"])
    types = {"InvoiceNo": "bigint", "Country": "double", "Quantity": "double", "UnitPrice": "int"}
    return cleaning.cast_columns(lines, types)


CLEAN_COLUMNS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"


@query("clean_retail", sql(f"SELECT {CLEAN_COLUMNS}, round(Revenue, 2) AS Revenue FROM clean", "clean"))
def clean_retail(spark, d):
    return rounded(full_sales(spark, d), 2, "Revenue")


@query(
    "drop_nulls",
    sql("SELECT InvoiceNo, UnitPrice, Quantity, CustomerID FROM retail WHERE CustomerID IS NOT NULL", "retail"),
)
def drop_nulls(spark, d):
    lines = retail_raw(spark, d, ["InvoiceNo", "UnitPrice", "Quantity", "CustomerID"])
    return cleaning.drop_missing(lines, RETAIL_REQUIRED)


@query("dedupe_rows", sql("SELECT DISTINCT * FROM bank", "bank"))
def dedupe_rows(spark, d):
    return bank_raw(spark, d).dropDuplicates()


@query("distinct_customers", sql("SELECT DISTINCT CustomerID FROM clean", "clean"))
def distinct_customers(spark, d):
    return sales(spark, d).select("CustomerID").distinct()


@query(
    "risk_score",
    sql(
        """
SELECT c_custkey, CASE WHEN "default" = 'yes' THEN 1 WHEN balance < 0 THEN 1 ELSE 0 END AS risk_score FROM bank
""",
        "bank",
    ),
)
def risk_score(spark, d):
    rows = cleaning.with_credit_default(bank_raw(spark, d, ["c_custkey", "default", "balance"]))
    return rows.select("c_custkey", C.risk_score().alias("risk_score"))


@query(
    "fill_defaults",
    sql(
        "SELECT c_custkey, coalesce(balance, 0.0) AS balance, coalesce(duration, 0.0) AS duration FROM bank", "bank"
    ),
)
def fill_defaults(spark, d):
    return bank_raw(spark, d, ["c_custkey", "balance", "duration"]).fillna({"balance": 0.0, "duration": 0.0})


@query(
    "loan_flags",
    sql(
        """
SELECT c_custkey, CAST(housing = 'yes' AS INTEGER) AS has_housing_loan, CAST(loan = 'yes' AS INTEGER) AS has_personal_loan
FROM bank
""",
        "bank",
    ),
)
def loan_flags(spark, d):
    return bank_raw(spark, d, ["c_custkey", "housing", "loan"]).select(
        "c_custkey",
        C.yes_flag("housing").alias("has_housing_loan"),
        C.yes_flag("loan").alias("has_personal_loan"),
    )


@query(
    "balance_ratio",
    sql(
        """
SELECT c_custkey, round(CASE WHEN balance > 0 THEN balance / (balance + 1) ELSE 0.0 END, 9) AS debt_to_balance_ratio
FROM bank
""",
        "bank",
    ),
)
def balance_ratio(spark, d):
    rows = bank_raw(spark, d, ["c_custkey", "balance"])
    return rows.select("c_custkey", F.round(C.balance_ratio(), 9).alias("debt_to_balance_ratio"))


@query("label_encode", sql("SELECT c_custkey, CAST(trim(y) = 'yes' AS DOUBLE) AS label FROM bank", "bank"))
def label_encode(spark, d):
    return bank_raw(spark, d, ["c_custkey", "y"]).select("c_custkey", C.subscribed_label().alias("label"))


@query(
    "credit_label",
    sql(
        """
SELECT c_custkey, CASE WHEN trim("default") = 'yes' OR balance < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS credit_label
FROM bank
""",
        "bank",
    ),
)
def credit_label(spark, d):
    rows = cleaning.with_credit_default(bank_raw(spark, d, ["c_custkey", "default", "balance"]))
    return features.credit_frame(rows).select("c_custkey", "credit_label")


@query(
    "text_preview",
    """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source,
       CASE WHEN length(text) > 30 THEN substring(text, 1, 30) || '...' ELSE text END AS text
FROM documents
""",
)
def text_preview(spark, d):
    return quality.preview(table(spark, d, "documents").select("doc_id", "lang", "source", "text"))


PREVIEW = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


@query(
    "vertical_preview",
    sql(
        f"""
, head AS (
  SELECT {CLEAN_COLUMNS}, round(Revenue, 2) AS Revenue, row_number() OVER (ORDER BY {CLEAN_COLUMNS}) AS n
  FROM clean ORDER BY {CLEAN_COLUMNS} LIMIT 5)
"""
        + "\nUNION ALL\n".join(
            f"SELECT CAST(n AS INTEGER) AS row_no, '{c}' AS \"column\", "
            f"CASE WHEN length(CAST({c} AS VARCHAR)) > 30 THEN CAST({c} AS VARCHAR)[1:30] || '...' "
            f'ELSE CAST({c} AS VARCHAR) END AS "value" FROM head'
            for c in [*PREVIEW, "Revenue"]
        ),
        "clean",
    ),
)
def vertical_preview(spark, d):
    return quality.vertical_preview(rounded(full_sales(spark, d), 2, "Revenue"), PREVIEW, 5)


# Joins and keys --------------------------------------------------------------------------------


@query(
    "rank_in_group",
    sql("SELECT c_custkey, job, age, rank_in_job AS row_idx FROM ranked", "ranked"),
)
def rank_in_group(spark, d):
    rows = bank(spark, d, "job").select("c_custkey", "job", "age")
    return customers.rank_in_group(rows, key=KEY)


@query("global_rank", sql("SELECT CustomerID, row_idx FROM numbered", "numbered"))
def global_rank(spark, d):
    return customers.number_customers(sales(spark, d).select("CustomerID").distinct())


@query("synthetic_key", sql("SELECT c_custkey, job, age, row_idx FROM keyed", "keyed"))
def synthetic_key(spark, d):
    rows = bank(spark, d, "job").select("c_custkey", "job", "age")
    return customers.synthetic_key(rows, global_rank(spark, d), KEY)


@query(
    "join_key_map",
    sql(
        "SELECT row_idx, c_custkey, job, age, CustomerID FROM keyed LEFT JOIN numbered USING (row_idx)", "keyed"
    ),
)
def join_key_map(spark, d):
    numbered = global_rank(spark, d)
    rows = bank(spark, d, "job").select("c_custkey", "job", "age")
    return customers.attach_customer_ids(customers.synthetic_key(rows, numbered, KEY), numbered)


@query(
    "customer_360",
    sql(
        """
SELECT CustomerID, c_custkey, job, age, total_invoices, round(total_revenue, 2) AS total_revenue,
       last_purchase_date, country
FROM silver
""",
        "silver",
    ),
)
def customer_360(spark, d):
    sums = rollup(spark, d)
    numbered = customers.number_customers(sums.select("CustomerID"))
    rows = bank(spark, d, "job").select("c_custkey", "job", "age")
    linked = customers.attach_customer_ids(customers.synthetic_key(rows, numbered, KEY), numbered)
    joined = customers.attach_rollup(linked.drop("row_idx"), sums)
    return ntz(rounded(joined, 2, "total_revenue"), "last_purchase_date")


@query(
    "gold_join_fill",
    sql(
        "SELECT CustomerID, c_custkey, Recency, Frequency, round(Monetary, 2) AS Monetary FROM joined", "joined"
    ),
)
def gold_join_fill(spark, d):
    sums = rollup(spark, d)
    rows = customers.customer_360(bank(spark, d, "job"), sums, KEY)
    joined = customers.join_rfm(rows, customers.rfm_from_rollup(sums))
    return rounded(joined.select("CustomerID", "c_custkey", *RFM_METRICS), 2, "Monetary")


# Aggregations ----------------------------------------------------------------------------------


@query(
    "retail_summary",
    sql("SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM rollup", "rollup"),
)
def retail_summary(spark, d):
    sums = customers.customer_rollup(sales(spark, d, "InvoiceDate", "Country"))
    return ntz(rounded(sums, 2, "total_revenue"), "last_purchase_date")


@query(
    "count_distinct",
    sql("SELECT CustomerID, count(DISTINCT InvoiceNo) AS invoices FROM clean GROUP BY CustomerID", "clean"),
)
def count_distinct(spark, d):
    return sales(spark, d).groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("invoices"))


@query(
    "exact_revenue",
    sql(
        """
SELECT Country, CAST(sum(CAST(Revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
       CAST(sum(CAST(UnitPrice AS DECIMAL(18, 2))) AS DOUBLE) AS prices
FROM clean GROUP BY Country
""",
        "clean",
    ),
)
def exact_revenue(spark, d):
    return exact.exact_sums(sales(spark, d, "Country"), ["Country"], {"revenue": "Revenue", "prices": "UnitPrice"})


@query(
    "exact_total",
    sql("SELECT CAST(sum(CAST(Revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM clean", "clean"),
)
def exact_total(spark, d):
    return exact.exact_sums(sales(spark, d), [], {"revenue": "Revenue"})


@query(
    "frequency_sketch",
    sql(
        """
, long AS (
  SELECT CustomerID, 'InvoiceNo' AS "column", InvoiceNo AS v FROM clean
  UNION ALL SELECT CustomerID, 'StockCode', StockCode FROM clean
)
SELECT CustomerID, "column", count(DISTINCT v) AS exact, true AS within, true AS bounded FROM long GROUP BY ALL
""",
        "clean",
    ),
)
def frequency_sketch(spark, d):
    """Distinct invoices and articles per customer from stored sketches per customer and month, beside the exact counts."""
    lines = sales(spark, d, "InvoiceDate", "StockCode")
    stored = materialize(sketches.customer_month_sketches(lines), "sketches")
    size = stored.groupBy("CustomerID", "column").agg(F.max(F.octet_length(sketches.SKETCH)).alias("size"))
    made = sketches.united(stored, ["CustomerID"])
    exact = _exact_distinct(lines, ["CustomerID"])
    joined = made.join(exact, ["CustomerID", "column"], "full").join(size, ["CustomerID", "column"], "left")
    bounded = (F.col("size") <= sketches.distinct_sketch_bytes()).alias("bounded")
    return joined.select("CustomerID", "column", "exact", _within(), bounded)


def _exact_distinct(lines: DataFrame, by: list[str]) -> DataFrame:
    long = lines.select(*by, "InvoiceNo", "StockCode").unpivot(by, ["InvoiceNo", "StockCode"], "column", "v")
    return long.groupBy(*by, "column").agg(F.count_distinct("v").alias("exact"))


def _exact_in_windows(lines: DataFrame, months: int) -> DataFrame:
    """``(month, column, exact)``; a value goes to the windows that its month before has not reached, so none has it twice.

    Stored lines are small and a task would read very many, hence the even parts; each holds a value once a month.
    """
    start = F.trunc(C.invoice_ts(), "month").alias("start")
    even = lines.select(start, "InvoiceNo", "StockCode").filter("start IS NOT NULL").hint("rebalance", "InvoiceNo")
    seen = even.unpivot("start", ["InvoiceNo", "StockCode"], "column", "v").distinct()
    before = F.lag("start").over(Window.partitionBy("column", "v").orderBy("start"))
    reached = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: F.add_months("start", k))
    first = F.filter(reached, lambda m: F.col("before").isNull() | (m >= F.add_months("before", months)))
    counted = seen.withColumn("before", before).select("column", "v", F.explode(first).alias("start")).groupBy("start", "column").agg(F.count("v").alias("exact"))
    return counted.select(sketches.month(F.col("start")).alias("month"), "column", "exact")


def _within(errors: int = 4):
    return F.coalesce(F.abs(F.col("estimate") - F.col("exact")) <= errors * sketches.distinct_error() * F.col("exact"), F.lit(False)).alias("within")


@query(
    "frequency_sketch_windows",
    sql(
        """
, months AS (SELECT DISTINCT date_trunc('month', InvoiceTs) AS m FROM clean WHERE InvoiceTs IS NOT NULL),
long AS (
  SELECT InvoiceTs, 'InvoiceNo' AS "column", InvoiceNo AS v FROM clean
  UNION ALL SELECT InvoiceTs, 'StockCode', StockCode FROM clean
)
SELECT strftime(m, '%Y-%m') AS month, "column", count(DISTINCT v) AS exact, true AS within
FROM months JOIN long ON InvoiceTs >= m - INTERVAL 2 MONTH AND InvoiceTs < m + INTERVAL 1 MONTH
GROUP BY ALL
""",
        "clean",
    ),
)
def frequency_sketch_windows(spark, d):
    """Three-month windows over the same stored sketches, half of which arrived later and were merged in."""
    lines = materialize(sales(spark, d, "InvoiceDate", "StockCode"), "lines")
    late = F.pmod(F.xxhash64("InvoiceNo", "StockCode"), F.lit(2)) == 1
    first, second = (materialize(sketches.customer_month_sketches(part), "sketches") for part in (lines.filter(~late), lines.filter(late)))
    stored = materialize(sketches.merged(first, second), "sketches")
    made = sketches.rolling(stored, 3)
    exact = _exact_in_windows(lines, 3)
    return made.join(exact, ["month", "column"], "left").select("month", "column", "exact", _within())


@query("rfm", sql("SELECT * REPLACE (round(Monetary, 2) AS Monetary) FROM rfm", "rfm"))
def rfm_features(spark, d):
    return rounded(rfm(spark, d), 2, "Monetary")


@query(
    "min_max_time",
    sql(
        "SELECT Country, min(InvoiceTs) AS first_ts, max(InvoiceTs) AS last_ts FROM clean GROUP BY Country", "clean"
    ),
)
def min_max_time(spark, d):
    ts = C.invoice_ts().cast("timestamp_ntz")
    lines = sales(spark, d, "InvoiceDate", "Country")
    return lines.groupBy("Country").agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


@query(
    "first_country",
    sql(
        """
SELECT StockCode, first(Country ORDER BY InvoiceTs, Country) AS country FROM clean GROUP BY StockCode
""",
        "clean",
    ),
)
def first_country(spark, d):
    # Products sell in many countries, customers in one, so products make the stronger check.
    lines = sales(spark, d, "InvoiceDate", "Country", "StockCode")
    sums = customers.customer_rollup(lines.withColumn("CustomerID", F.col("StockCode")))
    return sums.select(F.col("CustomerID").alias("StockCode"), "country")


@query(
    "row_counts",
    sql(
        """
SELECT 'retail' AS name, count(*) AS "rows" FROM retail
UNION ALL SELECT 'bronze_retail', count(*) FROM clean
UNION ALL SELECT 'bank', count(*) FROM bank
UNION ALL SELECT 'bronze_bank', count(*) FROM bank_clean
""",
        "clean",
        "bank_clean",
    ),
)
def row_counts(spark, d):
    frames = {
        "retail": retail_raw(spark, d, ["Quantity"]),
        "bronze_retail": sales(spark, d),
        "bank": bank_raw(spark, d, ["c_custkey"]),
        "bronze_bank": bank(spark, d, "age"),
    }
    counts = [quality.row_count(df).select(F.lit(name).alias("name"), "rows") for name, df in frames.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query("label_distribution", sql('SELECT y, count(*) AS "count" FROM gold GROUP BY y', "gold"))
def label_distribution(spark, d):
    return stats.group_sizes(silver(spark, d, "y"), "y")


@query(
    "label_share",
    sql(
        """
SELECT y, count(*) AS "count", round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM silver), 2) AS percent
FROM silver GROUP BY y
""",
        "silver",
    ),
)
def label_share(spark, d):
    return stats.group_shares(silver(spark, d, "y"), "y")


@query(
    "overview_stats",
    sql(
        """
SELECT count(*) AS total_customers, round(round(avg(age), 6), 1) AS avg_age, round(round(avg(balance), 6), 0) AS avg_balance,
       round(round(avg(duration), 6), 0) AS avg_call_duration, round(round(avg(campaign), 6), 1) AS avg_campaign_contact
FROM silver
""",
        "silver",
    ),
)
def overview_stats(spark, d):
    return stats.overview(silver(spark, d, "duration", "campaign"))


@query(
    "rfm_means",
    sql(
        """
SELECT round(round(avg(Recency), 6), 1) AS avg_recency, round(round(avg(Frequency), 6), 1) AS avg_frequency,
       round(round(avg(Monetary), 6), 0) AS avg_monetary
FROM gold
""",
        "gold",
    ),
)
def rfm_means(spark, d):
    return stats.rfm_means(gold(spark, d))


@query(
    "dq_report",
    sql(
        """
SELECT 'retail' AS layer, 'rows' AS "check", count(*) AS "count" FROM retail
UNION ALL SELECT 'retail', 'null CustomerID', count(*) FROM retail WHERE CustomerID IS NULL
UNION ALL SELECT 'retail', 'Quantity not positive', count(*) FROM retail WHERE Quantity <= 0
UNION ALL SELECT 'retail', 'Quantity negative', count(*) FROM retail WHERE Quantity < 0
UNION ALL SELECT 'bank', 'rows', count(*) FROM bank
UNION ALL SELECT 'bank', 'null balance', count(*) FROM bank WHERE balance IS NULL
UNION ALL SELECT 'bank', 'duplicate rows', (SELECT count(*) FROM bank) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bank))
UNION ALL SELECT 'gold', 'rows', count(*) FROM gold
UNION ALL SELECT 'gold', 'null balance', count(*) FROM gold WHERE balance IS NULL
UNION ALL SELECT 'gold', 'negative balance', count(*) FROM gold WHERE balance < 0
UNION ALL SELECT 'gold', 'no retail purchase', count(*) FROM gold WHERE Recency = 999
""",
        "gold",
    ),
)
def dq_report(spark, d):
    retail = quality.quality_report(retail_raw(spark, d, ["CustomerID", "Quantity"]), quality.retail_checks())
    rows = quality.quality_report(bank_raw(spark, d), quality.bank_checks(), duplicates=True)
    master = quality.quality_report(gold(spark, d), quality.gold_checks())
    named = [df.select(F.lit(n).alias("layer"), "check", "count") for n, df in
             (("retail", retail), ("bank", rows), ("gold", master))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "dq_duplicates",
    sql(
        "SELECT (SELECT count(*) FROM bank) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bank)) AS duplicate_rows",
        "bank",
    ),
)
def dq_duplicates(spark, d):
    return quality.duplicate_count(bank_raw(spark, d))


@query(
    "dq_duplicates_by_digest",
    sql(
        "SELECT (SELECT count(*) FROM bank) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bank)) AS duplicate_rows",
        "bank",
    ),
)
def dq_duplicates_by_digest(spark, d):
    return quality.duplicate_count_by_digest(bank_raw(spark, d))


@query("dedupe_rows_by_digest", sql("SELECT DISTINCT * FROM bank", "bank"))
def dedupe_rows_by_digest(spark, d):
    return quality.distinct_by_digest(bank_raw(spark, d))


def _per_metric(template: str) -> str:
    metric_columns = {"Recency": "CAST(Recency AS DOUBLE)", "Frequency": "CAST(Frequency AS DOUBLE)", "Monetary": "Monetary"}
    return "\nUNION ALL\n".join(template.format(name=n, value=v) for n, v in metric_columns.items())


@query(
    "quantiles",
    sql(
        _per_metric(
            "SELECT '{name}' AS metric, round(quantile_cont({value}, 0.5), 6) AS p50, "
            "round(quantile_cont({value}, 0.95), 6) AS p95, round(quantile_cont({value}, 0.97), 6) AS p97 FROM rfm"
        ),
        "rfm",
    ),
)
def quantiles(spark, d):
    found = stats.exact_quantiles(rfm(spark, d), RFM_METRICS, [0.5, 0.95, 0.97])
    return rounded(found, 6, "p50", "p95", "p97")


@query(
    "quantiles_sketch",
    sql(
        """
, parts AS (SELECT Country AS part, UnitPrice, Revenue FROM clean UNION ALL SELECT 'all', UnitPrice, Revenue FROM clean
            UNION ALL SELECT 'A-G', UnitPrice, Revenue FROM clean WHERE Country < 'H')
SELECT part, c AS "column", p, count(*) AS n, true AS within
FROM parts CROSS JOIN (VALUES ('UnitPrice'), ('Revenue')) AS cs(c)
CROSS JOIN (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) AS ps(p)
GROUP BY ALL
""",
        "clean",
    ),
)
def quantiles_sketch(spark, d):
    """Quantiles per country and of unions of countries, from stored sketches per country; ranks are counted in the rows."""
    lines = materialize(sales(spark, d, "Country").select("Country", "UnitPrice", "Revenue"), "lines")
    stored = materialize(sketches.rank_sketches(lines, ["Country"], ["UnitPrice", "Revenue"]), "sketches")
    subsets = {"all": F.lit(True), "A-G": F.col("Country") < "H"}
    made = sketches.sketched_quantiles(stored.withColumnRenamed("Country", "part"), PROBABILITIES)
    for name, chosen in subsets.items():
        whole = sketches.merged_ranks(stored.filter(chosen).withColumn("part", F.lit(name)), ["part"])
        made = made.unionByName(sketches.sketched_quantiles(whole, PROBABILITIES))
    made = materialize(made, "quantiles")
    parts = F.filter(F.array(F.col("Country"), *[F.when(c, F.lit(n)) for n, c in subsets.items()]), lambda x: x.isNotNull())
    long = lines.withColumn("part", F.explode(parts)).unpivot(["part"], ["UnitPrice", "Revenue"], "column", "v")
    below, upto = (F.sum(F.when(c, 1).otherwise(0)) / F.first("n") for c in (F.col("v") < F.col("value"), F.col("v") <= F.col("value")))
    # Twice the error of 99 cases in 100 leaves about one in ten million outside.
    error = 2 * sketches.rank_error()
    within = (below - error <= F.col("p")) & (F.col("p") <= upto + error)
    return long.join(made, ["part", "column"]).groupBy("part", "column", "p", "n").agg(within.alias("within"))


@query(
    "quantiles_by_cluster",
    sql(
        CLUSTERS_SQL
        + """
, long AS (
  SELECT segment_cluster, 'Recency' AS metric, CAST(Recency AS DOUBLE) AS v FROM clustered
  UNION ALL SELECT segment_cluster, 'Frequency', CAST(Frequency AS DOUBLE) FROM clustered
  UNION ALL SELECT segment_cluster, 'Monetary', Monetary FROM clustered
)
SELECT segment_cluster, metric, count(*) AS n, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95
FROM long GROUP BY ALL
""",
        "rfm",
    ),
)
def quantiles_by_cluster(spark, d):
    rows = materialize(_fixed_clusters(spark, d), "clusters")
    return rounded(selection.quantiles_by(rows, ["segment_cluster"], RFM_METRICS, [0.5, 0.95]), 6, "p50", "p95")


@query(
    "line_quantiles_by_country",
    sql(
        """
SELECT Country, 'Revenue' AS metric, count(*) AS n, round(quantile_cont(Revenue, 0.5), 6) AS p50,
       round(quantile_cont(Revenue, 0.95), 6) AS p95
FROM clean GROUP BY Country
""",
        "clean",
    ),
)
def line_quantiles_by_country(spark, d):
    lines = materialize(sales(spark, d, "Country").select("Country", "Revenue"), "lines")
    return rounded(selection.quantiles_by(lines, ["Country"], ["Revenue"], [0.5, 0.95]), 6, "p50", "p95")


@query(
    "winsorize_by_cluster",
    sql(
        CLUSTERS_SQL
        + """
, caps AS (SELECT segment_cluster, quantile_cont(CAST(Frequency AS DOUBLE), 0.95) AS f, quantile_cont(Monetary, 0.95) AS m
           FROM clustered GROUP BY segment_cluster)
SELECT CustomerID, segment_cluster, least(CAST(Frequency AS DOUBLE), f) AS Frequency, round(least(Monetary, m), 6) AS Monetary
FROM clustered JOIN caps USING (segment_cluster)
""",
        "rfm",
    ),
)
def winsorize_by_cluster(spark, d):
    rows = materialize(_fixed_clusters(spark, d), "clusters")
    capped = selection.winsorize_by(rows, ["segment_cluster"], ["Frequency", "Monetary"])
    return rounded(capped.select("CustomerID", "segment_cluster", "Frequency", "Monetary"), 6, "Monetary")


@query(
    "winsorize",
    sql(
        """
SELECT CustomerID, round(Recency, 6) AS Recency, round(Frequency, 6) AS Frequency, round(Monetary, 6) AS Monetary
FROM capped
""",
        "capped",
    ),
)
def winsorize(spark, d):
    stored = rfm(spark, d)
    return rounded(stats.winsorize(stored, RFM_METRICS, 0.95), 6, *RFM_METRICS)


@query(
    "rfm_histogram",
    sql(
        """
, long AS (
"""
        + _per_metric("SELECT '{name}' AS metric, {value} AS v FROM capped")
        + """
), ends AS (
  SELECT metric, min(v) - CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS lo,
         max(v) + CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS hi
  FROM long GROUP BY metric
), edges AS (
  SELECT metric, i AS bin, lo + i * ((hi - lo) / 40) AS bin_low,
         CASE WHEN i = 39 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 40) END AS bin_high
  FROM ends CROSS JOIN range(40) AS r(i)
)
SELECT edges.metric, bin, round(bin_low, 7) AS bin_low, round(bin_high, 7) AS bin_high, count(v) AS "count"
FROM edges LEFT JOIN long
  ON edges.metric = long.metric AND v >= bin_low AND (v < bin_high OR (bin = 39 AND v <= bin_high))
GROUP BY ALL
""",
        "capped",
    ),
)
def rfm_histogram(spark, d):
    stored = rfm(spark, d)
    return rounded(stats.rfm_histogram(stored), 7, "bin_low", "bin_high")


FIXED_SCORES = {"balance": "balance", "campaign": "campaign", "duration": "duration"}
AUC_SQL = """
, scored AS (SELECT y = 'yes' AS pos, {score} AS s FROM bank_clean),
placed AS (SELECT pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM scored),
sums AS (SELECT sum(r) FILTER (WHERE pos) AS rs, count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n
         FROM placed)
SELECT round(CAST((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n) AS DOUBLE), 9) AS auc FROM sums
"""


def _labelled(spark: SparkSession, d: str, *only: str) -> DataFrame:
    return features.subscription_frame(bank(spark, d, "y", *only))


@query(
    "best_by_metric",
    sql(
        ", all_scores AS (\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{n}' AS model, y = 'yes' AS pos, {s} AS s FROM bank_clean" for n, s in FIXED_SCORES.items()
        )
        + """
), placed AS (
  SELECT model, pos,
         rank() OVER (PARTITION BY model ORDER BY s) + (count(*) OVER (PARTITION BY model, s) - 1) / 2.0 AS r
  FROM all_scores
), sums AS (
  SELECT model, sum(r) FILTER (WHERE pos) AS rs, count(*) FILTER (WHERE pos) AS p,
         count(*) FILTER (WHERE NOT pos) AS n
  FROM placed GROUP BY model
)
SELECT model, round(CAST((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n) AS DOUBLE), 9) AS auc
FROM sums ORDER BY auc DESC, model LIMIT 1
""",
        "bank_clean",
    ),
)
def best_by_metric(spark, d):
    rows = materialize(_labelled(spark, d, *FIXED_SCORES), "labelled")
    scored = None
    for name, column in FIXED_SCORES.items():
        one = metrics.area_under_roc(rows, column).select(F.lit(name).alias("model"), F.round("auc", 9).alias("auc"))
        scored = one if scored is None else scored.unionByName(one)
    return stats.best_by(scored, "model", "auc")


def _fixed_predictions(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d, "campaign")
    return rows.withColumn("prediction", (F.col("campaign") > 0).cast("double"))


FIXED_SQL = ", fixed AS (SELECT CAST(y = 'yes' AS DOUBLE) AS label, CAST(campaign > 0 AS DOUBLE) AS prediction FROM bank_clean)\n"


@query(
    "confusion_matrix",
    sql(
        FIXED_SQL + 'SELECT label, prediction, count(*) AS "count" FROM fixed GROUP BY ALL ORDER BY ALL', "bank_clean"
    ),
)
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(_fixed_predictions(spark, d))


@query(
    "accuracy",
    sql(FIXED_SQL + "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 9) AS accuracy FROM fixed", "bank_clean"),
)
def accuracy(spark, d):
    return rounded(metrics.accuracy(_fixed_predictions(spark, d)), 9, "accuracy")


@query("auc", sql(AUC_SQL.format(score="duration"), "bank_clean"))
def auc(spark, d):
    return rounded(metrics.area_under_roc(_labelled(spark, d, "duration"), "duration"), 9, "auc")


# The oracle cannot run K-Means, so the reports over clusters are checked on a fixed assignment.
def _fixed_clusters(spark: SparkSession, d: str) -> DataFrame:
    return rfm(spark, d).withColumn("segment_cluster", (F.col("CustomerID") % 4).cast("int"))




@query(
    "cluster_profile",
    sql(
        CLUSTERS_SQL
        + """
SELECT segment_cluster, count(*) AS num_customers, round(round(avg(Recency), 6), 1) AS avg_recency,
       round(round(avg(Frequency), 6), 1) AS avg_frequency, round(round(avg(Monetary), 6), 0) AS avg_monetary
FROM clustered GROUP BY segment_cluster ORDER BY segment_cluster
""",
        "rfm",
    ),
)
def cluster_profile(spark, d):
    return segments.cluster_profile(_fixed_clusters(spark, d))


# Sorts and top-k -------------------------------------------------------------------------------


@query(
    "sorted_groups",
    sql(
        """
SELECT marital, education, count(*) AS "count" FROM bank_clean GROUP BY ALL ORDER BY marital, education
""",
        "bank_clean",
    ),
)
def sorted_groups(spark, d):
    return stats.group_sizes(bank(spark, d, "marital", "education"), "marital", "education").orderBy(
        "marital", "education"
    )


@query(
    "top_jobs",
    sql('SELECT job, count(*) AS "count" FROM silver GROUP BY job ORDER BY "count" DESC, job LIMIT 5', "silver"),
)
def top_jobs(spark, d):
    return stats.top_groups(silver(spark, d, "y"), "job", 5)


# Scalar functions ------------------------------------------------------------------------------


@query("parse_invoice_ts", sql("SELECT InvoiceNo, InvoiceDate, strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS InvoiceTs FROM retail", "retail"))
def parse_invoice_ts(spark, d):
    lines = retail_raw(spark, d, ["InvoiceNo", "InvoiceDate"])
    return lines.withColumn("InvoiceTs", C.invoice_ts().cast("timestamp_ntz"))


@query(
    "days_between",
    sql(
        """
SELECT InvoiceNo, CustomerID,
       CAST(date_diff('day', InvoiceTs, (SELECT max(InvoiceTs) FROM clean)) AS INTEGER) AS days
FROM clean
""",
        "clean",
    ),
)
def days_between(spark, d):
    lines = dated_sales(spark, d).select("InvoiceNo", "CustomerID", C.invoice_ts().alias("ts"))
    lines = materialize(lines, "dated")
    return lines.select("InvoiceNo", "CustomerID", F.datediff(customers.latest(lines, "ts"), "ts").alias("days"))


@query(
    "rounding",
    sql(
        """
SELECT c_custkey, CAST(round(CAST(balance AS DECIMAL(18, 2)), 0) AS DOUBLE) AS r0,
       CAST(round(CAST(balance AS DECIMAL(18, 2)), 1) AS DOUBLE) AS r1,
       CAST(round(CAST(balance AS DECIMAL(18, 2)), 2) AS DOUBLE) AS r2
FROM bank
""",
        "bank",
    ),
)
def rounding(spark, d):
    rows = bank_raw(spark, d, ["c_custkey", "balance"])
    return rows.select("c_custkey", *[F.round("balance", n).alias(f"r{n}") for n in range(3)])


@query(
    "arith",
    sql(
        """
SELECT InvoiceNo, Quantity + 1 AS plus, CASE WHEN UnitPrice = 0 THEN 0 ELSE round(Quantity * UnitPrice, 2) END AS times,
       CASE WHEN UnitPrice = 0 THEN 0 ELSE round(UnitPrice / Quantity, 6) END AS ratio, Quantity % 7 AS remainder,
       Quantity > 0 AND UnitPrice > 0 AS sold, Quantity < 0 OR UnitPrice = 0 AS unsold, 1 AS one
FROM retail
""",
        "retail",
    ),
)
def arith(spark, d):
    lines = retail_raw(spark, d, ["InvoiceNo", "Quantity", "UnitPrice"])
    q, p = F.col("Quantity"), F.col("UnitPrice")
    return lines.select(
        "InvoiceNo",
        (q + 1).alias("plus"),
        F.round(q * p, 2).alias("times"),
        F.round(F.try_divide(p, q), 6).alias("ratio"),
        F.try_mod(q, F.lit(7)).alias("remainder"),
        ((q > 0) & (p > 0)).alias("sold"),
        ((q < 0) | (p == 0)).alias("unsold"),
        F.lit(1).alias("one"),
    )


# Streaming -------------------------------------------------------------------------------------


def _feed(spark: SparkSession, lines: DataFrame) -> str:
    directory = new_path(spark, "feed")
    csv.write_csv(lines, directory)
    return directory


STREAMED = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CAST(CustomerID AS DOUBLE) AS CustomerID, Country"


@query("stream_csv_source", sql(f"SELECT {STREAMED} FROM retail", "retail"))
def stream_csv_source(spark, d):
    target = new_path(spark, "stream")
    ingest.drain(csv.stream_csv(spark, _feed(spark, retail_raw(spark, d))), target)
    return tables.read_table(spark, target)


@query(
    "stream_enrich",
    sql(
        """
-- a returned free item is 0, not -0
SELECT InvoiceNo, Quantity, UnitPrice,
       CASE WHEN UnitPrice = 0 THEN 0 ELSE round(Quantity * UnitPrice, 2) END AS Revenue, true AS stamped
FROM retail
""",
        "retail",
    ),
)
def stream_enrich(spark, d):
    rows = ingest.ingest_directory(spark, _feed(spark, retail_raw(spark, d)), new_path(spark, "stream"))
    return rows.select(
        "InvoiceNo",
        "Quantity",
        "UnitPrice",
        F.round("Revenue", 2).alias("Revenue"),
        F.col("processed_at").isNotNull().alias("stamped"),
    )


def _streamed_sales(spark: SparkSession, d: str) -> DataFrame:
    feed = _feed(spark, full_sales(spark, d).drop("Revenue"))
    return ingest.ingest_directory(spark, feed, new_path(spark, "stream"), max_files=2)


@query("stream_append", sql(f"SELECT {STREAMED}, round(Revenue, 2) AS Revenue FROM clean", "clean"))
def stream_append(spark, d):
    return rounded(_streamed_sales(spark, d).drop("processed_at"), 2, "Revenue")


@query(
    "stream_summary",
    sql(
        """
SELECT count(*) AS total_rows, round(sum(Revenue), 2) AS total_revenue, min(InvoiceTs) AS earliest,
       max(InvoiceTs) AS latest
FROM clean
""",
        "clean",
    ),
)
def stream_summary(spark, d):
    return ntz(ingest.stream_summary(_streamed_sales(spark, d)), "earliest", "latest")


@query("stream_replay", sql("SELECT count(*) AS rows_first, count(*) AS rows_second FROM retail", "retail"))
def stream_replay(spark, d):
    feed, target = _feed(spark, retail_raw(spark, d)), new_path(spark, "stream")
    first = materialize(quality.row_count(ingest.ingest_directory(spark, feed, target), "rows_first"), "count")
    second = quality.row_count(ingest.ingest_directory(spark, feed, target), "rows_second")
    return second.select(first.scalar().alias("rows_first"), "rows_second")


@query(
    "stream_replay_lost_checkpoint",
    sql(
        """
SELECT count(*) FILTER (WHERE Country < 'H') AS rows_first, count(*) AS rows_second, count(*) AS rows_third,
       round(sum(Quantity * UnitPrice), 2) AS revenue
FROM retail
""",
        "retail",
    ),
)
def stream_replay_lost_checkpoint(spark, d):
    """Three drains with a checkpoint of their own each: one feed, then other files beside it, then nothing new."""
    feed, target, lines = new_path(spark, "feed"), new_path(spark, "stream"), retail_raw(spark, d)
    counts = []
    for part in (lines.filter("Country < 'H'"), lines.filter("Country >= 'H'"), None):
        if part is not None:
            csv.write_csv(part, feed, mode="append")
        drained = ingest.ingest_once(spark, feed, target, checkpoint=new_path(spark, "checkpoint"))
        counts.append(materialize(quality.row_count(drained), "count"))
    first, second, third = (c.scalar() for c in counts)
    revenue = F.round(F.sum("Revenue"), 2).alias("revenue")
    return drained.agg(revenue).select(first.alias("rows_first"), second.alias("rows_second"), third.alias("rows_third"), "revenue")


@query(
    "stream_summary_kept",
    sql(
        """
SELECT count(*) AS total_rows, CAST(sum(CAST(Quantity * UnitPrice AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
       min(strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS earliest, max(strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS latest
FROM retail
""",
        "retail",
    ),
)
def stream_summary_kept(spark, d):
    """The summary after two drains, from the stream's own state; lines are not stored."""
    feed, target, lines = new_path(spark, "feed"), new_path(spark, "summary"), retail_raw(spark, d)
    for part in (lines.filter("Country < 'H'"), lines.filter("Country >= 'H'")):
        csv.write_csv(part, feed, mode="append")
        kept = ingest.follow_summary(spark, feed, target)
    return ntz(kept, "earliest", "latest")


# Features --------------------------------------------------------------------------------------


def _slots(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.posexplode(vector_to_array(vector)).alias("slot", "value"))


@query(
    "assemble",
    sql("SELECT c_custkey, age AS v0, balance AS v1, duration AS v2 FROM bank_clean", "bank_clean"),
)
def assemble(spark, d):
    rows = bank(spark, d, "duration")
    vectors = features.assembler(["age", "balance", "duration"]).transform(rows)
    values = vector_to_array("features")
    return vectors.select("c_custkey", *[values[i].alias(f"v{i}") for i in range(3)])


def _scaled(df: DataFrame, columns: list[str], center: bool) -> DataFrame:
    vectors = features.assembler(columns).transform(df)
    return features.standard_scaler("features", "scaled", center).fit(vectors).transform(vectors)


@query(
    "standardize",
    sql(
        "SELECT CustomerID, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS z_{c.lower()}" for c in RFM_METRICS
        )
        + " FROM rfm",
        "rfm",
    ),
)
def standardize(spark, d):
    scaled = _scaled(rfm(spark, d), list(RFM_METRICS), center=True)
    values = vector_to_array("scaled")
    return scaled.select(
        "CustomerID", *[F.round(values[i], 6).alias(f"z_{c.lower()}") for i, c in enumerate(RFM_METRICS)]
    )


@query(
    "scale_std",
    sql(
        "SELECT c_custkey, "
        + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}" for c in ("age", "balance", "duration"))
        + " FROM bank_clean",
        "bank_clean",
    ),
)
def scale_std(spark, d):
    names = ["age", "balance", "duration"]
    scaled = _scaled(bank(spark, d, "duration"), names, center=False)
    values = vector_to_array("scaled")
    return scaled.select("c_custkey", *[F.round(values[i], 6).alias(c) for i, c in enumerate(names)])


@query(
    "impute_mean",
    sql(
        "SELECT c_custkey, age, round(coalesce(balance, (SELECT avg(balance) FROM bank)), 6) AS balance FROM bank",
        "bank",
    ),
)
def impute_mean(spark, d):
    rows = bank_raw(spark, d, ["c_custkey", "age", "balance"])
    filled = features.mean_imputer(["age", "balance"]).fit(rows).transform(rows)
    return rounded(filled, 6, "balance")


JOB_INDEX_SQL = """
, jobs AS (
  SELECT job, row_number() OVER (ORDER BY count(*) DESC, job) - 1 AS i FROM bank_clean GROUP BY job)
"""


@query(
    "string_index",
    sql(JOB_INDEX_SQL + "SELECT c_custkey, job, CAST(i AS DOUBLE) AS job_idx FROM bank_clean JOIN jobs USING (job)", "bank_clean"),
)
def string_index(spark, d):
    rows = bank(spark, d, "job").select("c_custkey", "job")
    return features.category_indexer(["job"]).fit(rows).transform(rows)


@query(
    "category_index",
    sql(JOB_INDEX_SQL + "SELECT c_custkey, job, CAST(i AS DOUBLE) AS job_idx FROM bank_clean JOIN jobs USING (job)", "bank_clean"),
)
def category_index(spark, d):
    rows = bank(spark, d, "job").select("c_custkey", "job")
    return features.index_categories(rows, features.category_table(rows, ["job"]), ["job"])


@query(
    "article_index",
    sql(
        """
, sizes AS (SELECT StockCode, count(*) AS n FROM clean GROUP BY StockCode),
numbered AS (SELECT StockCode, row_number() OVER (ORDER BY n DESC, StockCode) - 1 AS i FROM sizes)
SELECT InvoiceNo, StockCode, CAST(coalesce(i, (SELECT count(*) FROM sizes)) AS DOUBLE) AS StockCode_idx
FROM retail LEFT JOIN numbered USING (StockCode)
""",
        "clean",
    ),
)
def article_index(spark, d):
    """Every article is a category: learned on clean lines, given to all, unseen ones kept apart."""
    table = features.category_table(sales(spark, d, "StockCode"), ["StockCode"])
    return features.index_categories(retail_raw(spark, d, ["InvoiceNo", "StockCode"]), table, ["StockCode"])


@query(
    "one_hot",
    sql(
        JOB_INDEX_SQL
        + """
SELECT c_custkey, CAST(slots.i AS INTEGER) AS slot, CAST(slots.i = jobs.i AS DOUBLE) AS "value"
FROM bank_clean JOIN jobs USING (job) CROSS JOIN (SELECT i FROM jobs) AS slots
""",
        "bank_clean",
    ),
)
def one_hot(spark, d):
    indexed = string_index(spark, d)
    encoded = features.one_hot_encoder(["job"]).fit(indexed).transform(indexed)
    return _slots(encoded, "c_custkey", "job_ohe")


@query(
    "split_counts",
    sql(
        """
SELECT CASE WHEN ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT < floor(0.8 * 4294967296)
            THEN 'train' ELSE 'test' END AS part,
       count(*) AS "count", CAST(sum(c_custkey) AS BIGINT) AS key_sum
FROM bank_clean GROUP BY 1
""",
        "bank_clean",
    ),
)
def split_counts(spark, d):
    part = F.when(features.split_flag(KEY), "train").otherwise("test").alias("part")
    return (
        bank(spark, d, "age")
        .groupBy(part)
        .agg(F.count(F.lit(1)).alias("count"), F.sum("c_custkey").alias("key_sum"))
    )


# Models ----------------------------------------------------------------------------------------


# A trained model has no counterpart in SQL, but what must hold of it has: which rows it is applied to,
# how its outputs hang together, and that its figures are those of its own predictions.


@query("kmeans_segments", sql("SELECT count(*) AS customers, 4::BIGINT AS clusters, true AS by_spend, true AS nearest, true AS centred FROM rfm", "rfm"))
def kmeans_segments(spark, d):
    stored = rfm(spark, d)
    model = segments.fit_segments(stored)
    return segments.check_segments(model, segments.assign_segments(model, stored))


def _subscription(spark: SparkSession, d: str):
    table_ = features.subscription_frame(stored_gold(spark, d))
    train, test = features.train_test_split(table_, KEY)
    return train, test, features.subscription_features(table_)


def _checked(scored: DataFrame, label: str) -> DataFrame:
    """Held-out rows with their label, and whether prediction and probability agree and are in range."""
    p = F.col("probability_1")
    return scored.select("c_custkey", label, (F.col("prediction") == (p > 0.5).cast("double")).alias("agrees"), p.between(0, 1).alias("in_range"))


TEST_SQL = """
, held AS (
  SELECT c_custkey, CAST(trim(y) = 'yes' AS DOUBLE) AS label,
         CASE WHEN trim(credit_default) = 'yes' OR balance < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS credit_label
  FROM bank_clean
  WHERE ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT >= floor(0.8 * 4294967296))
"""
LABELLED_SQL = sql(TEST_SQL + "SELECT c_custkey, label, true AS agrees, true AS in_range FROM held", "bank_clean")


@query("lr_predict", LABELLED_SQL)
def lr_predict(spark, d):
    train, test, columns = _subscription(spark, d)
    model = models.fit_classifier(models.logistic_regression(), train, *columns)
    return _checked(models.score(model, test, ["c_custkey", "label"]), "label")


@query(
    "lr_grid",
    "SELECT reg_param, max_iter, true AS in_range, true AS best_is_first_maximum, 1::BIGINT AS n_best FROM "
    "(VALUES (0.01::DOUBLE, 50), (0.01::DOUBLE, 100), (0.1::DOUBLE, 50), (0.1::DOUBLE, 100)) AS grid(reg_param, max_iter)",
)
def lr_grid(spark, d):
    train, _, columns = _subscription(spark, d)
    grid = models.tune_logistic_regression(train, *columns, key=KEY).metrics
    top = grid.agg(F.max("avg_auc").alias("top"), F.count_if("best").alias("n_best"))
    checked = grid.join(top).select(
        "reg_param", "max_iter", F.col("avg_auc").between(0, 1).alias("in_range"),
        (~F.col("best") | (F.col("avg_auc") == F.col("top"))).alias("best_is_first_maximum"), "n_best",
    )
    return checked


@query("rf_predict", LABELLED_SQL)
def rf_predict(spark, d):
    train, test, columns = _subscription(spark, d)
    model = models.fit_classifier(models.random_forest(), train, *columns)
    return _checked(models.score(model, test, ["c_custkey", "label"]), "label")


CATEGORIES = ("job", "marital", "education", "credit_default", "housing", "loan", "contact", "month", "poutcome")
NUMBERS = ("age", "balance", "day", "duration", "campaign", "pdays", "previous", "Recency", "Frequency", "Monetary")
SLOTS_SQL = (
    """
, train AS (
  SELECT * FROM bank_clean WHERE ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT < floor(0.8 * 4294967296)),
named AS (
"""
    + "\nUNION ALL\n".join(
        f"SELECT {i} AS part, row_number() OVER (ORDER BY count(*) DESC, {c}) AS n, '{c}_ohe_' || {c} AS feature FROM train GROUP BY {c}"
        for i, c in enumerate(CATEGORIES)
    )
    + "".join(f"\nUNION ALL SELECT 100 + {i}, 1, '{c}'" for i, c in enumerate(NUMBERS))
    + "),\nslots AS (SELECT feature, CAST(row_number() OVER (ORDER BY part, n) - 1 AS INTEGER) AS slot FROM named)\n"
)


def _forest_importances(spark: SparkSession, d: str) -> DataFrame:
    train, _, columns = _subscription(spark, d)
    model = models.fit_classifier(models.random_forest(), train, *columns)
    return models.feature_importances(model, train)


@query("rf_importance", sql(SLOTS_SQL + "SELECT slot, feature, true AS not_negative, 1.0::DOUBLE AS total FROM slots", "bank_clean"))
def rf_importance(spark, d):
    found = _forest_importances(spark, d)
    total = found.agg(F.round(F.sum("importance"), 9).alias("total"))
    return found.join(total).select("slot", "feature", (F.col("importance") >= 0).alias("not_negative"), "total")


# How far a figure stated again may be from the model's own.
AGAIN = 1e-9


def _same_probabilities(spark: SparkSession, model, test: DataFrame, again: DataFrame, label: str) -> DataFrame:
    scored = models.score(model, test, ["c_custkey", label])
    # Merged by key: the stored size of the rows says little about what the driver would have to send.
    both = scored.hint("merge").join(again.withColumnRenamed("probability_1", "again"), "c_custkey")
    return both.select("c_custkey", label, (F.abs(F.col("probability_1") - F.col("again")) <= AGAIN).alias("same"))


@query("rf_walk", sql(TEST_SQL + "SELECT c_custkey, label, true AS same FROM held", "bank_clean"))
def rf_walk(spark, d):
    train, test, columns = _subscription(spark, d)
    model = models.fit_classifier(models.random_forest(), train, *columns)
    return _same_probabilities(spark, model, test, model_tables.forest_probabilities(model, test, "c_custkey"), "label")


@query("gbt_walk", sql(TEST_SQL + "SELECT c_custkey, credit_label, true AS same FROM held", "bank_clean"))
def gbt_walk(spark, d):
    table_ = features.credit_frame(stored_gold(spark, d))
    train, test = features.train_test_split(table_, KEY)
    model = models.fit_classifier(models.boosted_trees(), train, *features.credit_features(table_))
    return _same_probabilities(spark, model, test, model_tables.boosted_probabilities(model, test, "c_custkey"), "credit_label")


@query("lr_probabilities", sql(TEST_SQL + "SELECT c_custkey, label, true AS same FROM held", "bank_clean"))
def lr_probabilities(spark, d):
    train, test, columns = _subscription(spark, d)
    model = models.fit_classifier(models.logistic_regression(), train, *columns)
    table_ = model_tables.coefficients(model, train)
    return _same_probabilities(spark, model, test, model_tables.logistic_probabilities(table_, model, test, "c_custkey"), "label")


@query(
    "lr_optimality",
    sql(
        SLOTS_SQL
        + "SELECT slot, feature, true AS optimal FROM slots UNION ALL SELECT -1, '(intercept)', true",
        "bank_clean",
    ),
)
def lr_optimality(spark, d):
    """Every coefficient is where the loss on the training rows has no slope."""
    train, _, columns = _subscription(spark, d)
    model = models.fit_classifier(models.logistic_regression(), train, *columns)
    found = model_tables.optimality(model, train)
    return found.select("slot", "feature", (F.abs(F.col("gradient")) <= 1e-4).alias("optimal"))


@query(
    "top_importances",
    sql(
        SLOTS_SQL
        + """
SELECT CAST(least(15, count(*)) AS BIGINT) AS n_listed, CAST(least(15, count(*)) AS BIGINT) AS n_known, true AS none_larger FROM slots
""",
        "bank_clean",
    ),
)
def top_importances(spark, d):
    every = materialize(_forest_importances(spark, d), "importances")
    top = models.top_importances(every, 15)
    left = every.join(top.select("feature"), "feature", "left_anti").agg(F.max("importance")).scalar()
    return top.join(every.select("feature").distinct(), "feature").agg(
        F.count(F.lit(1)).alias("n_listed"), F.count_distinct("feature").alias("n_known"),
        (F.min("importance") >= F.coalesce(left, F.lit(0.0))).alias("none_larger"),
    )


@query("gbt_predict", sql(TEST_SQL + "SELECT c_custkey, credit_label, true AS agrees, true AS in_range FROM held", "bank_clean"))
def gbt_predict(spark, d):
    table_ = features.credit_frame(stored_gold(spark, d))
    train, test = features.train_test_split(table_, KEY)
    model = models.fit_classifier(models.boosted_trees(), train, *features.credit_features(table_))
    return _checked(models.score(model, test, ["c_custkey", "credit_label"]), "credit_label")


@query(
    "model_comparison",
    "SELECT model, true AS accuracy_holds, true AS auc_holds, true AS best_holds FROM "
    "(VALUES ('Logistic Regression'), ('Random Forest'), ('GBT')) AS names(model)",
)
def model_comparison(spark, d):
    trained = pipeline.train_models(stored_gold(spark, d), KEY)
    # Both figures again, from the stored predictions and by other means than those that made them.
    again = None
    for name, predictions in trained.predictions.items():
        label = "credit_label" if "credit_label" in predictions.columns else "label"
        own = metrics.accuracy(predictions, label).join(metrics.area_under_roc(predictions, "probability_1", label))
        own = own.select(F.lit(name).alias("model"), F.col("accuracy").alias("accuracy_again"), F.col("auc").alias("auc_again"))
        again = own if again is None else again.unionByName(own)
    top = trained.comparison.agg(F.max("auc")).scalar()
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    return trained.comparison.join(again, "model").select(
        "model", close("accuracy", "accuracy_again").alias("accuracy_holds"), close("auc", "auc_again").alias("auc_holds"),
        (~F.col("best") | (F.col("auc") == top)).alias("best_holds"),
    )


# Reports ---------------------------------------------------------------------------------------


@query(
    "report_top_jobs",
    sql(
        """
SELECT job, count(*) AS total_customers, round(round(avg(balance), 6), 0) AS avg_balance,
       round(round(avg(Monetary), 6), 0) AS avg_monetary
FROM gold WHERE y = 'no' AND Recency <= 30
GROUP BY job ORDER BY avg_balance DESC, job LIMIT 5
""",
        "gold",
    ),
)
def report_top_jobs(spark, d):
    store = tables.Warehouse(spark, new_path(spark, "warehouse"))
    store.save("gold", gold(spark, d))
    store.register_views("gold")
    return reports.top_jobs_by_balance(spark.table("gold"))


@query(
    "report_credit_by_education",
    sql(
        """
SELECT education, count(*) FILTER (WHERE balance < 0) AS negative_balance_count, count(*) AS total,
       round(count(*) FILTER (WHERE balance < 0) * 100.0::DOUBLE / count(*), 2) AS risk_pct
FROM gold GROUP BY education ORDER BY risk_pct DESC, education
""",
        "gold",
    ),
)
def report_credit_by_education(spark, d):
    return reports.credit_risk_by_education(gold(spark, d))


@query(
    "report_segments",
    sql(
        CLUSTERS_SQL
        + """
SELECT segment_cluster, count(*) AS customers, round(round(avg(Recency), 6), 0) AS avg_recency_days,
       round(round(avg(Frequency), 6), 1) AS avg_orders, round(round(avg(Monetary), 6), 0) AS avg_spend_gbp,
       CASE WHEN avg(Recency) < 30 AND avg(Monetary) > 2000 THEN 'VIP'
            WHEN avg(Recency) < 90 AND avg(Monetary) > 500 THEN 'Active'
            WHEN avg(Recency) > 200 THEN 'At Risk' ELSE 'Regular' END AS segment_label
FROM clustered GROUP BY segment_cluster ORDER BY avg_spend_gbp DESC, segment_cluster
""",
        "rfm",
    ),
)
def report_segments(spark, d):
    return reports.segment_report(_fixed_clusters(spark, d))


# Layers ----------------------------------------------------------------------------------------


@query("bronze_retail", sql(f"SELECT {CLEAN_COLUMNS}, round(Revenue, 2) AS Revenue FROM clean", "clean"))
def bronze_retail(spark, d):
    store = tables.Warehouse(spark, new_path(spark, "warehouse"))
    stored = store.save("bronze_retail", full_sales(spark, d))
    return rounded(stored.select(*PREVIEW, "Revenue"), 2, "Revenue")


@query("bronze_bank", sql('SELECT * RENAME (credit_default AS "default") FROM bank_clean', "bank_clean"))
def bronze_bank(spark, d):
    store = tables.Warehouse(spark, new_path(spark, "warehouse"))
    return store.save("bronze_bank", cleaning.clean_bank(bank_raw(spark, d)))


@query(
    "silver_customer_360",
    sql("SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM silver", "silver"),
)
def silver_customer_360(spark, d):
    return ntz(rounded(silver(spark, d), 2, "total_revenue"), "last_purchase_date")


@query(
    "gold_master",
    sql(
        """
SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, round(Monetary, 2) AS Monetary,
                  round(debt_to_balance_ratio, 9) AS debt_to_balance_ratio)
FROM gold
""",
        "gold",
    ),
)
def gold_master(spark, d):
    rows = rounded(gold(spark, d), 2, "total_revenue", "Monetary")
    return ntz(rounded(rows, 9, "debt_to_balance_ratio"), "last_purchase_date")
