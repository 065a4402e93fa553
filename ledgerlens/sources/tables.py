"""Stored tables. The format is a parameter: parquet by default, delta where its jar is present."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import TABLES

DEFAULT_FORMAT = "parquet"


# Readers skip names that begin with an underscore.
VERSIONS = "_schema"


def _versions(spark: SparkSession, path: str) -> list[dict]:
    """What overwrites have recorded, oldest first: one short line each."""
    try:
        lines = [json.loads(r[0]) for r in spark.read.text(f"{path}/{VERSIONS}").collect()]
    except AnalysisException as e:  # written by something else, or not there
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(lines, key=lambda v: v["version"])


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A stored table with the types it was written with.

    File formats keep partition values as text in folder names, and would guess "01" to be a number; the
    schema stored beside the data says what they are. Folder names cannot hold an empty text: as a
    partition value it comes back null.
    """
    versions = [] if fmt == "delta" else _versions(spark, path)
    if not versions:
        return spark.read.format(fmt).load(path)
    last = versions[-1]
    return spark.read.format(fmt).schema(T.StructType.fromJson(last["schema"])).load(f"{path}/{last['folder']}")


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder at the path, in whatever file system."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _write(df: DataFrame, path: str, mode: str, partition_by: str | None, fmt: str, **options: str) -> None:
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    replace_schema: bool = False,
) -> None:
    """Replace the table at ``path``.

    Rows of a partitioned table are first rebalanced on the partition column. That keeps the number
    of files small, and AQE splits the partitions of a value that holds a large share of the rows
    over several tasks, which a plain ``repartition`` on the column would not.

    The rows go to a folder of their own, and a line beside the data, with the schema, makes it the current
    one once they are all there. A write that fails half-way changes nothing, and a table may be
    computed from itself. The version before stays, for readers that have opened it; older ones are emptied.
    """
    if fmt == "delta":
        _write(df, path, "overwrite", partition_by, fmt, **({"overwriteSchema": "true"} if replace_schema else {}))
        return
    spark = df.sparkSession
    versions = _versions(spark, path)
    folder = f"v-{uuid.uuid4().hex}"
    _write(df, f"{path}/{folder}", "errorifexists", partition_by, fmt)
    line = {"version": versions[-1]["version"] + 1 if versions else 0, "folder": folder, "partition_by": partition_by, "schema": json.loads(df.schema.json())}
    spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1).write.mode("append").text(f"{path}/{VERSIONS}")
    for old in versions[-2:-1]:
        nothing = spark.createDataFrame([], T.StructType.fromJson(old["schema"]))
        nothing.write.format(fmt).mode("overwrite").save(f"{path}/{old['folder']}")


def overwrite_partitions(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace those partition values of a stored table that ``df`` has rows of; the files of all others stay.

    ``df`` must have the columns and types the table was stored with, in any order. Spark writes the new folders in
    full before it exchanges them one by one.
    """
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
        return
    versions = _versions(df.sparkSession, path)
    if not versions or not versions[-1]["partition_by"]:
        raise ValueError(f"{path} holds no partitioned table")
    last = versions[-1]
    stored = T.StructType.fromJson(last["schema"])
    kinds = lambda schema: sorted((f.name, f.dataType.simpleString()) for f in schema)
    if kinds(stored) != kinds(df.schema):
        raise ValueError(f"{path} is stored with {stored.simpleString()}, not {df.schema.simpleString()}")
    rows = df.select(*stored.fieldNames())
    _write(rows, f"{path}/{last['folder']}", "overwrite", last["partition_by"], fmt, partitionOverwriteMode="dynamic")


class Warehouse:
    """The layered tables below one base folder."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = DEFAULT_FORMAT):
        self.spark = spark
        self.base = base.rstrip("/")
        self.fmt = fmt

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def save(self, table: str, df: DataFrame) -> DataFrame:
        """Write a layer once and hand back the stored copy, so later steps never recompute it."""
        partition_by = TABLES[table]
        overwrite_table(df, self.path(table), partition_by, self.fmt, replace_schema=True)
        return self.load(table)

    def load(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), self.fmt)

    def register_views(self, *tables: str) -> None:
        """Make stored tables visible to SQL users under their table names."""
        for table in tables:
            self.load(table).createOrReplaceTempView(table)
