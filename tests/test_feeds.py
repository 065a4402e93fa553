"""Feeds in other shapes, stored types, plain means and exact curves."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.columns import mean
from ledgerlens.operators import metrics, models, segments
from ledgerlens.operators.cleaning import clean_retail
from ledgerlens.sources import csv, tables
from ledgerlens.streaming import ingest

SWAPPED = "StockCode,InvoiceNo,Country,Quantity,InvoiceDate,UnitPrice,CustomerID,Description\n"


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path, "a.csv", SWAPPED + "S1,I1,UK,2,1/2/2020 3:04,1.5,7,thing\n")
    row = csv.read_retail(spark, path).first()
    assert (row.InvoiceNo, row.StockCode, row.Quantity, row.UnitPrice, row.CustomerID, row.Country) == ("I1", "S1", 2, 1.5, 7.0, "UK")
    stored = ingest.ingest_directory(spark, path, str(tmp_path / "out")).first()
    assert (stored.InvoiceNo, stored.StockCode, stored.Revenue) == ("I1", "S1", 3.0)


def test_file_with_another_header_fails(spark, tmp_path):
    write(tmp_path, "a.csv", "InvoiceNo,Quantity\nI1,2\n")
    path = write(tmp_path, "b.csv", "Quantity,InvoiceNo\n2,I1\n")
    with pytest.raises(Exception, match="header"):
        csv.read_retail(spark, path).collect()


def test_inferred_types_keep_the_rows_of_declared_ones(spark, tmp_path):
    lines = "I1,S,d,2,1/2/2020 3:04,1.5,7,UK\nI2,S,d,bad,1/2/2020 3:04,1.5,8,UK\nI3,S,d,1,1/2/2020 3:04,x,9.0,UK\nI4,S,d,1,1/2/2020 3:04,2,n/a,UK\n"
    path = write(tmp_path, "a.csv", "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n" + lines)
    declared, inferred = (clean_retail(csv.read_retail(spark, path, infer=i)) for i in (False, True))
    assert [tuple(r) for r in declared.collect()] == [tuple(r) for r in inferred.select(declared.columns).collect()]
    assert [r.InvoiceNo for r in declared.collect()] == ["I1"]
    assert declared.dtypes == inferred.dtypes


def test_first_drain_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = ingest.ingest_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert table.count() == 0 and "Revenue" in table.columns
    assert ingest.stream_summary(table).first().total_rows == 0


def test_partition_values_keep_their_type(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "02"), (3, None)], "n int, job string")
    tables.overwrite_table(df, str(tmp_path / "t"), partition_by="job")
    back = tables.read_table(spark, str(tmp_path / "t"))
    assert dict(back.dtypes) == {"n": "int", "job": "string"}
    assert sorted((r.n, r.job) for r in back.collect()) == [(1, "01"), (2, "02"), (3, None)]


@pytest.mark.parametrize(("values", "expected"), [([1e23, 1.0], 5e22), ([4e-7, 4e-7], 4e-7), ([math.nan, math.inf, 1.0], math.nan)])
def test_mean_is_plain(spark, values, expected):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(mean("x")).first()[0]
    assert math.isnan(got) if math.isnan(expected) else got == pytest.approx(expected, rel=1e-12)


def test_area_under_curve_counts_every_score(spark):
    rows = spark.range(5000).select(
        ((F.xxhash64("id") % 100 > 20) == (F.col("id") % 3 == 0)).cast("double").alias("label"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)) / 1e9).alias("rawPrediction")
    )
    exact = metrics.area_under_roc(rows, "rawPrediction", "label").first()[0]
    assert models.exact_auc("label").evaluate(rows) == pytest.approx(exact, abs=1e-12)


def test_segments_do_not_depend_on_the_session(spark):
    features = spark.range(600).select(
        F.col("id").alias("CustomerID"), (F.col("id") % 97).alias("Recency"), (F.col("id") % 13).alias("Frequency"), (F.xxhash64("id") % 1000 + 1000).cast("double").alias("Monetary")
    )
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, coalesce in (("5", "true"), ("8", "false"), ("64", "true"), ("64", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            found.append({r.CustomerID: r.segment_cluster for r in segments.segment_customers(features).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(f == found[0] for f in found)
