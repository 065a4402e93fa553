"""CSV feeds, as batches and as streams. Columns are found by the name in the header, in whatever order."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BANK_SCHEMA, RETAIL_SCHEMA


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a schema from text columns of the same names; what does not convert or is missing is null."""
    names = {c.strip(): c for c in df.columns}
    columns = []
    for field in schema:
        text = F.col(f"`{names[field.name]}`") if field.name in names else F.lit(None).cast("string")
        columns.append(text.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Read a CSV with a header; without a schema the types are inferred in an extra pass.

    With a schema everything is read as text first, so one file's order of columns, given by its header,
    is as good as another's. Files of one folder must agree on it; one that does not fails the read.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return typed(_as_text(reader, _header(reader, path) or schema.fieldNames()).csv(path), schema)


def _header(reader, path: str) -> list[str]:
    """The columns that the files of a folder name; none if it has no file yet."""
    try:
        return reader.csv(path).columns
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return []
        raise


def read_mixed_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Read a folder whose files have headers of their own: other columns, or the same in another order.

    Files are grouped by header and each group is read by its own, in one scan; the groups are united by
    name. Columns of the schema that a file lacks are null in its rows, others are left out. The headers are read off
    the first lines in a job before that. A folder without files or with empty ones only gives no rows.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    groups = [
        typed(spark.read.option("header", True).option("sep", sep).option("enforceSchema", False).schema(_texts(spark, header, sep)).csv(files), schema)
        for header, files in sorted(_files_by_header(spark, path).items())
    ]
    return reduce(DataFrame.unionByName, groups) if groups else spark.createDataFrame([], schema)


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by their first line; as many names reach the driver as Spark lists there anyway."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # A task reads a stretch of a file from its first line on.
    firsts = lines.filter("file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    firsts = firsts.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found = firsts.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect()
    # The metadata column gives paths as they are in an address.
    return {r.header: [unquote(f) for f in r.files] for r in found}


def _texts(spark: SparkSession, header: str, sep: str) -> StructType:
    """The columns a header line names, as text, read as Spark reads a header."""
    line = spark.createDataFrame([(header,)], "value string")
    count = line.select(F.size(F.split("value", f"\\Q{sep}\\E")).alias("n")).first()["n"]
    parsed = line.select(F.from_csv("value", ", ".join(f"c{i} string" for i in range(count)), {"sep": sep}).alias("c")).first()["c"]
    return StructType([StructField(name, StringType()) for name in parsed if name is not None])


def _as_text(reader, columns: list[str]):
    """Read with exactly these columns, as text, and fail on a file whose header differs."""
    text = StructType([StructField(c, StringType()) for c in columns])
    return reader.schema(text).option("enforceSchema", False)


def read_retail(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_csv(spark, path, None if infer else RETAIL_SCHEMA)


def read_bank(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_csv(spark, path, None if infer else BANK_SCHEMA, sep=";")


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def stream_csv(
    spark: SparkSession,
    directory: str,
    schema: StructType = RETAIL_SCHEMA,
    max_files: int | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Follow a directory of CSV files; ``max_files`` bounds the size of a micro-batch.

    ``file_column`` adds what names the file of a row: its path, size and time of change.

    The order of columns is that of the files present when the stream starts, or the schema's if there
    are none yet.
    """
    header = _header(spark.read.option("header", True), directory)
    reader = _as_text(spark.readStream.option("header", True), header or schema.fieldNames())
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(directory)
    if file_column is None:
        return typed(rows, schema)
    changed = F.unix_millis("_metadata.file_modification_time").cast("string")
    name = F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_size").cast("string"), changed)
    named = rows.withColumn(file_column, name)
    return typed(named, StructType([*schema, StructField(file_column, StringType())]))
