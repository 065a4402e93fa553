"""Hand-written rows with literal expected results."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import cleaning, customers, features, quality, segments, stats
from ledgerlens.plans import gold as gold_plan
from ledgerlens.plans import reports
from ledgerlens.schemas import RFM_METRICS

LINES = "InvoiceNo string, Quantity int, InvoiceDate string, UnitPrice double, CustomerID bigint, Country string"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_invoice_dates(spark):
    df = spark.createDataFrame(
        [("12/1/2010 8:26",), ("01/02/2011 08:05",), ("13/45/2010 1:00",), ("soon",), (None,)], "InvoiceDate string"
    )
    got = [r[0] for r in df.select(C.invoice_ts().cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2011, 1, 2, 8, 5), None, None, None]


def test_day_difference_counts_midnights(spark):
    df = spark.sql("SELECT timestamp'2011-01-02 00:01:00' AS a, timestamp'2011-01-01 23:59:00' AS b")
    assert df.select(F.datediff("a", "b")).first()[0] == 1


def test_clean_retail(spark):
    df = spark.createDataFrame(
        [
            ("1", 2, 1.5, 7.0),
            ("2", 0, 1.5, 7.0),
            ("3", -1, 1.5, 7.0),
            ("4", 1, 0.0, 7.0),
            ("5", 1, 1.0, None),
            (None, 1, 1.0, 7.0),
            ("6", None, 1.0, 7.0),
            ("7", 1, float("nan"), 7.0),
        ],
        "InvoiceNo string, Quantity int, UnitPrice double, CustomerID double",
    )
    got = cleaning.clean_retail(df)
    assert rows(got) == [("1", 2, 1.5, 7, 3.0)]
    assert got.schema["CustomerID"].dataType.simpleString() == "bigint"


def test_clean_bank_casts_text_and_drops_copies(spark):
    df = spark.createDataFrame(
        [("30", "10.5", "a"), ("30", "10.5", "a"), ("30", "10.5", "b"), ("x", "1", "a"), ("40", None, "a")],
        "age string, balance string, job string",
    )
    assert sorted(rows(cleaning.clean_bank(df))) == [(30.0, 10.5, "a"), (30.0, 10.5, "b")]


def test_duplicates_count_rows_beyond_the_first(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (1, "x"), (2, "x")], "a int, b string")
    assert quality.duplicate_count(df).first()[0] == 2
    report = dict(rows(quality.quality_report(df, {"b missing": F.col("b").isNull()}, duplicates=True)))
    assert report == {"rows": 5, "b missing": 3, "duplicate rows": 2}


def test_quality_report_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    report = dict(rows(quality.quality_report(empty, {"a missing": F.col("a").isNull()}, duplicates=True)))
    assert report == {"rows": 0, "a missing": 0, "duplicate rows": 0}


def test_flags_and_labels(spark):
    df = spark.createDataFrame([("yes",), ("no",), (" yes ",), (None,)], "y string")
    assert rows(df.select(C.yes_flag("y"), C.subscribed_label())) == [(1, 1.0), (0, 0.0), (0, 1.0), (None, 0.0)]


def test_balances(spark):
    df = spark.createDataFrame(
        [(-1.0, "no"), (0.0, "no"), (1.0, "no"), (None, "no"), (None, " yes"), (5.0, "yes")],
        "balance double, credit_default string",
    )
    got = rows(df.select(C.balance_ratio(), C.risk_score(), C.credit_label("credit_default")))
    assert got == [(0.0, 1, 1.0), (0.0, 0, 0.0), (0.5, 0, 0.0), (0.0, 0, 0.0), (0.0, 0, 1.0), (5 / 6, 1, 1.0)]


@pytest.mark.parametrize(
    ("recency", "spend", "band"),
    [
        (29.9, 2000.1, "VIP"),
        (30.0, 2000.1, "Active"),
        (29.9, 2000.0, "Active"),
        (89.9, 500.1, "Active"),
        (90.0, 501.0, "Regular"),
        (200.0, 9999.0, "Regular"),
        (200.1, 9999.0, "At Risk"),
        (10.0, 100.0, "Regular"),
    ],
)
def test_bands(spark, recency, spend, band):
    df = spark.createDataFrame([(0, recency, 1, spend)], "segment_cluster int, Recency double, Frequency int, Monetary double")
    assert segments.band_profile(df).first().segment_label == band


def test_shorten(spark):
    df = spark.createDataFrame([("abcdef",), ("abcde",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(C.shorten("t", 5)).collect()] == ["abcde...", "abcde", "", None]


def test_vertical_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    assert sorted(rows(quality.vertical_preview(df, ["k"], 2))) == [
        (1, "k", "1"), (1, "v", "a"), (2, "k", "2"), (2, "v", "b"),
    ]


def sales(spark, data):
    df = spark.createDataFrame(data, LINES)
    return df.withColumn("Revenue", C.revenue())


def test_rollup_and_rfm(spark):
    lines = sales(
        spark,
        [
            ("A1", 1, "9/9/2011 9:00", 2.0, 1, "UK"),
            ("A1", 2, "9/9/2011 9:00", 1.0, 1, "UK"),
            ("A2", 1, "12/9/2010 9:00", 5.0, 1, "FR"),
            ("B1", 1, "12/9/2011 0:01", 1.0, 2, "DE"),
            ("C1", 1, "not a date", 1.0, 3, "ES"),
            ("D1", 1, "1/1/2011 1:00", 1.0, 4, "IT"),
            ("D2", 1, "1/1/2011 1:00", 1.0, 4, "AT"),
            ("D3", 1, "bad", 1.0, 4, "AA"),
        ],
    )
    rollup = {r.CustomerID: r for r in customers.customer_rollup(lines).collect()}
    assert (rollup[1].total_invoices, rollup[1].total_revenue, rollup[1].country) == (2, 9.0, "FR")
    assert rollup[1].last_purchase_date == dt.datetime(2011, 9, 9, 9, 0)
    assert (rollup[3].last_purchase_date, rollup[3].country) == (None, "ES")
    assert (rollup[4].country, rollup[4].total_invoices) == ("AT", 3)
    want = [(1, 91, 2, 9.0), (2, 0, 1, 1.0), (3, 999, 1, 1.0), (4, 342, 3, 3.0)]
    assert sorted(rows(customers.rfm(lines))) == want
    assert sorted(rows(customers.rfm(lines, as_of=dt.datetime(2011, 12, 9, 12, 0)))) == want


def test_one_customer_with_invoices_in_two_countries_counts_once(spark):
    lines = sales(spark, [("A1", 1, "1/1/2011 1:00", 1.0, 1, "UK"), ("A1", 1, "1/1/2011 1:00", 1.0, 1, "FR")])
    assert customers.customer_rollup(lines).first().total_invoices == 1


def bank(spark, data):
    schema = "id int, age double, job string, balance double, housing string, loan string, credit_default string, y string"
    return spark.createDataFrame([(i, a, j, 10.0, "yes", "no", "no", "no") for i, a, j in data], schema)


def numbered_customers(spark, n):
    return spark.createDataFrame([(100 + i, i + 1) for i in range(n)], "CustomerID bigint, row_idx bigint")


def test_rank_breaks_ties_and_keeps_nulls(spark, many_partitions):
    df = bank(spark, [(1, 30.0, "a"), (2, 30.0, "a"), (3, None, "a"), (4, 50.0, "b"), (5, 20.0, None)])
    got = {r.id: r.row_idx for r in customers.rank_in_group(df, key=["id"]).collect()}
    assert got == {3: 1, 1: 2, 2: 3, 4: 1, 5: 1}


def test_ranks_wrap_onto_customers(spark, many_partitions):
    df = bank(spark, [(i, float(i), "a") for i in range(1, 6)])
    got = {r.id: r.row_idx for r in customers.synthetic_key(df, numbered_customers(spark, 2), ["id"]).collect()}
    assert got == {1: 2, 2: 1, 3: 2, 4: 1, 5: 2}


def test_no_customers_at_all(spark):
    lines = sales(spark, [])
    df = bank(spark, [(1, 30.0, "a"), (2, 31.0, "a")])
    rollup = customers.customer_rollup(lines)
    silver = customers.customer_360(df, rollup, ["id"])
    assert sorted(rows(silver.select("id", "CustomerID", "total_invoices"))) == [(1, None, None), (2, None, None)]
    gold = gold_plan.gold_master(silver, customers.latest(rollup, "last_purchase_date"))
    assert set(rows(gold.select(*RFM_METRICS))) == {(999.0, 0, 0.0)}


def test_gold_without_a_join_equals_gold_with_one(spark, many_partitions):
    lines = sales(
        spark,
        [(f"I{i}", i % 5 + 1, f"{i % 12 + 1}/{i % 28 + 1}/2011 1:00", 1.25, i % 7, f"C{i % 3}") for i in range(60)],
    )
    df = bank(spark, [(i, float(i % 9), f"j{i % 2}") for i in range(30)])
    rollup = customers.customer_rollup(lines)
    silver = customers.customer_360(df, rollup, ["id"])
    joined = gold_plan.gold_from_join(silver, customers.rfm(lines))
    direct = gold_plan.gold_master(silver, customers.latest(rollup, "last_purchase_date"))
    one_go = gold_plan.gold_in_one_go(df, rollup, ["id"])
    assert joined.columns == direct.columns == one_go.columns
    assert sorted(rows(joined), key=repr) == sorted(rows(direct), key=repr) == sorted(rows(one_go), key=repr)


def test_capping_keeps_nulls(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)] + [(100, None)], "k int, x double")
    got = dict(rows(stats.winsorize(df, ["x"], 0.95)))
    assert got[100] is None
    assert max(v for v in got.values() if v is not None) == pytest.approx(np.quantile(np.arange(100), 0.95))


@pytest.mark.parametrize("values", [[5.0, 5.0, 5.0], [0.0, 1.0], [i / 10 for i in range(400)], [0.1 * i for i in range(81)]])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = sorted(rows(stats.histogram(df, ["x"]).select("bin", "bin_low", "bin_high", "count")))
    counts, edges = np.histogram(values, bins=40)
    assert [r[3] for r in got] == counts.tolist()
    assert [r[1] for r in got] + [got[-1][2]] == pytest.approx(edges.tolist())


def test_shares_add_up(spark):
    df = spark.createDataFrame([("yes",)] * 1 + [("no",)] * 2 + [(None,)], "y string")
    assert {r.y: (r["count"], r.percent) for r in stats.group_shares(df, "y").collect()} == {
        "yes": (1, 25.0), "no": (2, 50.0), None: (1, 25.0),
    }


def test_top_groups_go_by_name_when_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "job string")
    assert rows(stats.top_groups(df, "job", 2)) == [("c", 2), ("a", 1)]


def test_optional_columns(spark):
    df = spark.createDataFrame([(1.0, "x", "no")], "age double, job string, default string")
    assert features.subscription_features(cleaning.with_credit_default(df)) == (["job", "credit_default"], ["age"])
    assert features.credit_features(cleaning.with_credit_default(df), ["age"]) == (["job"], [])


def test_reports_take_parameters(spark):
    df = spark.createDataFrame(
        [("a", "no", 10.0, 5.0, 1.0, "x"), ("b", "no", 10.0, 9.0, 1.0, "x"), ("c", "yes", 1.0, 99.0, 1.0, "y"), ("d", "no", 31.0, -1.0, 1.0, "y")],
        "job string, y string, Recency double, balance double, Monetary double, education string",
    )
    assert [r.job for r in reports.top_jobs_by_balance(df).collect()] == ["b", "a"]
    assert [r.job for r in reports.top_jobs_by_balance(df, k=1, active_days=9).collect()] == []
    assert rows(reports.credit_risk_by_education(df)) == [("y", 1, 2, 50.0), ("x", 0, 2, 0.0)]
