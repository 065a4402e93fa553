"""The physical plans are the ones wanted."""

import re

from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, customers, positions, quality, stats
from ledgerlens.operators.positions import number_rows
from ledgerlens.plans import reports
from ledgerlens.session import materialize
from ledgerlens.sources.bindings import retail_raw, table
from workload import queries

from .conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unused_dimensions_are_not_read(spark):
    text = plan(queries.sales(spark, SF_DIR))
    assert "n_name" not in text and "o_orderdate" not in text and "p_name" not in text
    assert re.search(r"PushedFilters: \[.*IsNotNull\(l_orderkey\)", text)


def test_filters_and_columns_reach_the_stored_layer(spark):
    stored = materialize(queries.gold(spark, SF_DIR), "gold")
    text = plan(reports.top_jobs_by_balance(stored))
    assert "TakeOrderedAndProject" in text
    assert re.search(r"PushedFilters: \[.*EqualTo\(y,no\).*LessThanOrEqual\(Recency,30", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"y", "Recency", "job", "balance", "Monetary"}


def test_rfm_combines_before_it_shuffles(spark):
    text = plan(customers.rfm(queries.dated_sales(spark, SF_DIR), as_of=F.current_timestamp()))
    assert text.count("Exchange hashpartitioning(CustomerID") == 2
    first_shuffle = text.rindex("Exchange hashpartitioning(CustomerID")
    assert "HashAggregate(keys=[CustomerID" in text[first_shuffle:]
    assert "SortAggregate" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_reference_date_is_a_scalar_subquery(spark):
    rollup = materialize(customers.customer_rollup(queries.sales(spark, SF_DIR, "InvoiceDate", "Country")), "rollup")
    text = plan(customers.rfm_from_rollup(rollup))
    assert "Subquery" in text and "NestedLoop" not in text


def test_rollup_folds_the_lines_once(spark, monkeypatch):
    written = []
    write = customers.materialize

    def record(df, label):
        written.append(plan(df))
        return write(df, label)

    monkeypatch.setattr(customers, "materialize", record)
    data = [("A1", "1/2/2011 9:00", 2, 1.5, 1, "UK"), ("A1", "1/2/2011 9:00", 1, 1.0, 1, "UK"), ("A2", None, 1, 4.0, 1, "FR"), ("B1", "bad", 1, 1.0, None, None)]
    lines = spark.createDataFrame(data, "InvoiceNo string, InvoiceDate string, Quantity int, UnitPrice double, CustomerID int, Country string")
    rollup = customers.customer_rollup(materialize(lines, "lines"), stored=True)
    assert len(written) == 1 and written[0].count("FileScan") == 1
    assert "UnitPrice" not in plan(rollup) and "InvoiceDate" not in plan(rollup)
    found = sorted((r.CustomerID or 0, r.total_invoices, r.total_revenue, r.country) for r in rollup.collect())
    assert found == [(0, 1, 1.0, None), (1, 2, 8.0, "UK")]


def test_share_of_total_uses_no_window(spark):
    text = plan(stats.group_shares(table(spark, SF_DIR, "customer"), "c_mktsegment"))
    assert "Window" not in text and "NestedLoop" not in text


def test_numbering_sends_no_table_to_one_task(spark, many_partitions, monkeypatch):
    written = []
    write = positions.materialize

    def record(df, label):
        written.append(plan(df))
        return write(df, label)

    monkeypatch.setattr(positions, "materialize", record)
    numbered = number_rows(table(spark, SF_DIR, "customer"), ["c_custkey"])
    assert "rangepartitioning" in written[0] and "SinglePartition" not in written[0]
    final = plan(numbered)
    # The only single-task step works on the partition offsets, after their aggregation.
    assert final.count("Exchange SinglePartition") == 1
    assert "HashAggregate" in final[final.index("Exchange SinglePartition"):]
    assert "BroadcastHashJoin" in final


def test_quality_report_is_one_pass(spark):
    df = retail_raw(spark, SF_DIR, ["CustomerID", "Quantity"])
    text = plan(quality.quality_report(df, quality.retail_checks()))
    assert len(re.findall(r"FileScan parquet .*l_orderkey", text)) == 1


def test_nulls_are_dropped_before_copies(spark):
    text = plan(cleaning.clean_bank(materialize(queries.bank_raw(spark, SF_DIR), "bank")))
    assert "IsNotNull" in text or "atleastnnonnulls" in text
    assert text.index("HashAggregate") < text.lower().index("filter")


def test_hot_partition_value_is_rebalanced(spark):
    text = table(spark, SF_DIR, "orders").hint("rebalance", "o_orderstatus")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text


def test_rollup_sorts_no_lines(spark):
    from workload.queries import QUERIES

    df = QUERIES["retail_summary"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")]
    # Only the choice of a country among a customer's few sorts.
    assert final.count("SortAggregate") == 2
    assert final.count("HashAggregate") == 8


def test_intermediates_are_stored_once(spark, tmp_path, monkeypatch):
    import os

    from ledgerlens import session
    from workload.queries import QUERIES

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    for name, most in (("winsorize", 4), ("rfm_histogram", 4), ("kmeans_segments", 1), ("standardize", 1)):
        before = set(os.listdir(tmp_path))
        QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert len(set(os.listdir(tmp_path)) - before) <= most, name
