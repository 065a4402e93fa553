"""Incremental ingestion: each file once, streams equal batches."""

from pyspark.sql import functions as F

from ledgerlens.schemas import RETAIL_SCHEMA
from ledgerlens.session import new_path
from ledgerlens.sources import csv
from ledgerlens.streaming import ingest

FIRST = [("1", "a", "x, y", 2, "9/9/2011 9:00", 1.5, 7.0, "UK"), ("2", "b", None, -1, "1/2/2011 0:05", 2.0, None, "FR")]
LATER = [("3", "c", "z", 3, "12/9/2011 12:50", 0.5, 8.0, "UK")]


def add_file(spark, feed, rows):
    csv.write_csv(spark.createDataFrame(rows, RETAIL_SCHEMA).coalesce(1), feed, mode="append")


def stored(df):
    return sorted(tuple(r) for r in df.drop("processed_at").collect())


def test_each_file_is_appended_once(spark):
    feed, table = new_path(spark, "feed"), new_path(spark, "table")
    add_file(spark, feed, FIRST)
    first = ingest.ingest_directory(spark, feed, table)
    assert first.count() == 2
    assert ingest.ingest_directory(spark, feed, table).count() == 2
    add_file(spark, feed, LATER)
    both = ingest.ingest_directory(spark, feed, table, max_files=1)
    batch = ingest.enrich(csv.read_retail(spark, feed))
    assert stored(both) == stored(batch)
    assert both.filter(F.col("processed_at").isNull()).count() == 0
    assert both.schema["Revenue"].dataType == batch.schema["Revenue"].dataType


def test_summary_orders_by_time_not_text(spark):
    lines = ingest.enrich(spark.createDataFrame(FIRST + LATER, RETAIL_SCHEMA))
    got = ingest.stream_summary(lines).first()
    assert (got.total_rows, got.total_revenue) == (3, 2.5)
    assert (got.earliest.month, got.latest.month) == (1, 12)


def test_micro_batches_share_one_processing_time(spark):
    feed, table = new_path(spark, "feed"), new_path(spark, "table")
    add_file(spark, feed, FIRST + LATER)
    assert ingest.ingest_directory(spark, feed, table).select("processed_at").distinct().count() == 1
