"""Durable tables, single partitions, mixed headers, lost checkpoints and kept summaries."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.schemas import RETAIL_SCHEMA
from ledgerlens.session import new_path
from ledgerlens.sources import csv, tables
from ledgerlens.streaming import ingest

from workload import queries

from .conftest import SF_DIR
from .test_streaming import FIRST, LATER, add_file, stored


def test_a_failed_overwrite_leaves_the_old_table(spark):
    path = new_path(spark, "table")
    tables.overwrite_table(spark.range(5), path)
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 990, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        tables.overwrite_table(bad.select(F.col("id").cast("bigint").alias("id")), path)
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == list(range(5))


def test_a_table_may_be_computed_from_itself_and_read_while_replaced(spark):
    path = new_path(spark, "table")
    tables.overwrite_table(spark.range(3), path)
    opened = tables.read_table(spark, path)
    tables.overwrite_table(opened.selectExpr("id + 10 AS id"), path)
    assert sorted(r.id for r in opened.collect()) == [0, 1, 2]
    tables.overwrite_table(tables.read_table(spark, path).selectExpr("id + 10 AS id"), path)
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == [20, 21, 22]
    # Of three versions the first holds no rows any more.
    assert spark.read.parquet(f"{path}/v-*").count() == 6


def test_one_partition_is_rewritten(spark):
    path = new_path(spark, "table")
    rows = spark.createDataFrame([("UK", 1), ("UK", 2), ("FR", 3), ("DE", 4)], "Country string, n int")
    tables.overwrite_table(rows, path, partition_by="Country")
    files = lambda: {f: os.stat(f.removeprefix("file:").replace("///", "/")).st_mtime_ns for f in tables.read_table(spark, path).inputFiles()}
    before = files()
    tables.overwrite_partitions(spark.createDataFrame([(9, "UK"), (8, "IT")], "n int, Country string"), path)
    after = files()
    assert {tuple(r) for r in tables.read_table(spark, path).select("Country", "n").collect()} == {("UK", 9), ("IT", 8), ("FR", 3), ("DE", 4)}
    kept = {f: t for f, t in before.items() if "Country=UK" not in f}
    assert len(kept) == 2 and kept.items() <= after.items()
    with pytest.raises(ValueError, match="is stored with"):
        tables.overwrite_partitions(spark.createDataFrame([("9", "UK")], "n string, Country string"), path)
    plain = new_path(spark, "table")
    tables.overwrite_table(rows, plain)
    with pytest.raises(ValueError, match="no partitioned table"):
        tables.overwrite_partitions(rows, plain)


def test_files_of_one_folder_may_have_their_own_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,"c,d"\n1,x,p\n2,y,q\n')
    (tmp_path / "two words.csv").write_text("b,a\nz,3\n")
    (tmp_path / "three.csv").write_text("b,a\nw,bad\n")
    (tmp_path / "four.csv").write_text("b\nlonely\n")
    (tmp_path / "empty.csv").write_text("")
    got = csv.read_mixed_csv(spark, str(tmp_path), "a int, b string, `c,d` string, e double")
    assert {tuple(r) for r in got.collect()} == {(1, "x", "p", None), (2, "y", "q", None), (3, "z", None, None), (None, "w", None, None), (None, "lonely", None, None)}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3


def test_a_lost_checkpoint_loses_and_repeats_nothing(spark):
    feed, table = new_path(spark, "feed"), new_path(spark, "table")
    add_file(spark, feed, FIRST)
    assert ingest.ingest_once(spark, feed, table).count() == 2
    assert ingest.ingest_once(spark, feed, table, checkpoint=new_path(spark, "checkpoint")).count() == 2
    add_file(spark, feed, LATER)
    both = ingest.ingest_once(spark, feed, table, checkpoint=new_path(spark, "checkpoint"), max_files=1)
    assert stored(both.drop("source_file")) == stored(ingest.enrich(csv.read_retail(spark, feed)))
    assert both.select("source_file").distinct().count() == 2
    # The checkpoint in the table's folder has not seen the later file; the table has.
    assert ingest.ingest_once(spark, feed, table).count() == 3


def test_the_rows_of_one_file_are_not_one_tasks(spark):
    feed, table = new_path(spark, "feed"), new_path(spark, "table")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        add_file(spark, feed, FIRST)
        ingest.ingest_once(spark, feed, table)
        add_file(spark, feed, LATER * 1_000)
        both = ingest.ingest_once(spark, feed, table, checkpoint=new_path(spark, "checkpoint"))
        parts = both.groupBy("source_file").agg(F.count("*").alias("n"), F.count_distinct("_metadata.file_path").alias("files"))
        n, files = max(tuple(r) for r in parts.select("n", "files").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n == 1_000 * len(LATER) and files > 8 and both.count() == n + len(FIRST)


def test_feeds_are_written_by_many_tasks(spark, monkeypatch):
    plans, write = [], csv.write_csv

    def noted(df, path, sep=",", mode="overwrite"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, sep, mode)

    monkeypatch.setattr(csv, "write_csv", noted)
    queries.QUERIES["stream_replay_lost_checkpoint"](spark, SF_DIR)
    assert len(plans) == 2 and not any("Repartition" in p for p in plans)


def test_a_fresh_checkpoint_over_another_ones_table_is_refused(spark):
    feed, table = new_path(spark, "feed"), new_path(spark, "table")
    add_file(spark, feed, FIRST)
    ingest.ingest_directory(spark, feed, table)
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.ingest_directory(spark, feed, table, checkpoint=new_path(spark, "checkpoint"))
    assert ingest.ingest_directory(spark, feed, table).count() == 2


def test_the_kept_summary_is_that_of_all_lines(spark):
    feed, summary = new_path(spark, "feed"), new_path(spark, "summary")
    add_file(spark, feed, FIRST)
    ingest.follow_summary(spark, feed, summary)
    add_file(spark, feed, LATER)
    got = ingest.follow_summary(spark, feed, summary).first()
    want = ingest.stream_summary(spark.createDataFrame(FIRST + LATER, RETAIL_SCHEMA).transform(ingest.enrich)).first()
    assert tuple(got) == tuple(want)
    # Nothing new: the state stands.
    assert tuple(ingest.follow_summary(spark, feed, summary).first()) == tuple(want)
