"""CSV reading and stored tables."""

from ledgerlens.schemas import BANK_SCHEMA, RETAIL_SCHEMA
from ledgerlens.session import new_path, shared_folder
from ledgerlens.sources import csv
from ledgerlens.sources.tables import Warehouse, overwrite_table, read_table


def test_declared_types_turn_bad_text_into_null(spark):
    path = new_path(spark, "csv")
    text = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n1,a,,many,x,free,17850.0,UK\n"
    spark.createDataFrame([(line,) for line in text.splitlines()], "value string").coalesce(1).write.text(path)
    df = csv.read_retail(spark, path)
    assert df.schema == RETAIL_SCHEMA
    assert tuple(df.first()) == ("1", "a", None, None, "x", None, 17850.0, "UK")
    assert csv.read_retail(spark, path, infer=True).schema["CustomerID"].dataType.simpleString() == "double"


def test_semicolon_feed(spark):
    path = new_path(spark, "csv")
    row = (58.0, "management", "married", "tertiary", "no", 2143.0, "yes", "no", "unknown", 5.0, "may", 261.0, 1.0, -1.0, 0.0, "unknown", "no")
    csv.write_csv(spark.createDataFrame([row], BANK_SCHEMA), path, sep=";")
    assert tuple(csv.read_bank(spark, path).first()) == row


def test_overwrite_replaces_rows_and_schema(spark):
    path = new_path(spark, "table")
    overwrite_table(spark.range(5), path)
    overwrite_table(spark.range(2).selectExpr("id AS k", "'x' AS v"), path, replace_schema=True)
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(0, "x"), (1, "x")]


def test_partition_column_moves_last_and_prunes(spark):
    store = Warehouse(spark, new_path(spark, "warehouse"))
    df = spark.createDataFrame([("UK", 1), ("FR", 2), ("UK", 3)], "Country string, n int")
    stored = store.save("bronze_retail", df)
    assert stored.columns == ["n", "Country"]
    plan = stored.filter("Country = 'UK'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Country" in plan
    store.register_views("bronze_retail")
    assert spark.sql("SELECT sum(n) FROM bronze_retail WHERE Country = 'UK'").first()[0] == 4


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_a_value_with_most_of_the_rows_is_written_by_several_tasks(spark):
    path = new_path(spark, "table")
    rows = spark.range(200_000).selectExpr("id", "xxhash64(id) AS noise", "IF(id % 10 < 7, 'hot', 'cold') AS Country")
    # The target size of a task's share; the default suits larger tables.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        overwrite_table(rows.repartition(8), path, partition_by="Country")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = read_table(spark, path)
    files = stored.filter("Country = 'hot'").inputFiles()
    assert len([f for f in files if "Country=hot" in f]) > 2
    assert stored.count() == 200_000
