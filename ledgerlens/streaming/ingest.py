"""Append a directory of retail CSV files to a stored table, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import invoice_ts, revenue
from ..sources.csv import stream_csv
from ..sources.tables import DEFAULT_FORMAT, folder_exists

# What names a file: the same path written anew is another file.
FILE = "source_file"


def enrich(lines: DataFrame) -> DataFrame:
    """Revenue and processing time; works on a stream and on a batch."""
    return lines.withColumns({"Revenue": revenue(), "processed_at": F.current_timestamp()})


def drain(
    enriched: DataFrame,
    table: str,
    checkpoint: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Append everything that has arrived since the last drain, then stop.

    By default the checkpoint lives inside the table's folder (readers skip names that start with an
    underscore). A checkpoint and the rows it accounts for can then not be separated, so running the
    drain again never appends the same file twice. A checkpoint elsewhere that knows nothing of a table with
    rows is refused: its batches would be taken for those already written, and their rows lost. Use
    ``ingest_once`` where checkpoints may be lost.
    """
    if checkpoint and fmt != "delta" and folder_exists(enriched.sparkSession, f"{table}/_spark_metadata"):
        if not folder_exists(enriched.sparkSession, f"{checkpoint}/offsets"):
            raise ValueError(f"{table} holds rows of another checkpoint than {checkpoint}")
    query = (
        enriched.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{table}/_checkpoint")
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


def ingest_directory(
    spark: SparkSession,
    directory: str,
    table: str,
    checkpoint: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    max_files: int | None = None,
) -> DataFrame:
    """Drain a directory and return the stored table."""
    lines = enrich(stream_csv(spark, directory, max_files=max_files))
    drain(lines, table, checkpoint, fmt)
    return _stored(spark, table, lines, fmt)


def ingest_once(
    spark: SparkSession,
    directory: str,
    table: str,
    checkpoint: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    max_files: int | None = None,
) -> DataFrame:
    """Drain a directory so that each file's rows are stored once, whether or not a checkpoint is left from before.

    The rows carry the identity of their file, its path, size and time of change, in ``source_file``. A batch leaves
    out the files whose identity the table holds, read from that one column; so a checkpoint, by default one
    inside the table's folder, saves reading files again, but may be lost or be another one. Drains of one table must
    not run at once, and where writers can die while they commit the format should commit atomically (delta).
    """
    lines = enrich(stream_csv(spark, directory, max_files=max_files, file_column=FILE))
    columns = lines.columns

    def append(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        if folder_exists(session, table):
            stored = _stored(session, table, batch, fmt).select(FILE)
            # Only the identities of this batch's files come out of the column scan. They are as many as the files
            # the driver has listed and are sent to the rows: dealt by file, a file's rows would be one task's.
            arrived = F.broadcast(batch.select(FILE).distinct())
            seen = F.broadcast(stored.join(arrived, FILE, "left_semi").distinct())
            batch = batch.join(seen, FILE, "left_anti").select(*columns)
        batch.write.format(fmt).mode("append").save(table)

    query = (
        lines.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint or f"{table}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored(spark, table, lines, fmt)


def _stored(spark: SparkSession, table: str, like: DataFrame, fmt: str) -> DataFrame:
    """The table's rows; the stream knows its columns even if nothing has arrived yet."""
    return spark.read.format(fmt).load(table) if fmt == "delta" else spark.read.format(fmt).schema(like.schema).load(table)


def follow_summary(
    spark: SparkSession, directory: str, summary: str, checkpoint: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Drain a directory into a one-row summary table and return it; the lines themselves are not stored.

    Counts, sums and extremes are kept as the stream's state in the checkpoint, by default inside the summary's
    folder, so a drain reads new files only. Amounts are added in whole cents, so the figures do not depend on which
    files came together.
    """
    enriched = enrich(stream_csv(spark, directory, max_files=max_files))

    def replace(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch: a batch that is run again overwrites its own, and readers take the last whole one.
        batch.coalesce(1).write.mode("overwrite").parquet(f"{summary}/batch={batch_id}")

    query = (
        _summed(enriched).writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint or f"{summary}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = spark.read.schema("batch bigint, total_rows bigint, total_revenue double, earliest timestamp, latest timestamp").parquet(summary)
    return stored.orderBy(F.desc("batch")).limit(1).drop("batch")


def _summed(lines: DataFrame) -> DataFrame:
    ts = invoice_ts()
    cents = F.sum(F.round(F.col("Revenue") * 100).cast("decimal(38,0)"))
    return lines.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (cents / 100).cast("double").alias("total_revenue"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )


def stream_summary(table: DataFrame) -> DataFrame:
    ts = invoice_ts()
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.round(F.sum("Revenue"), 2).alias("total_revenue"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )
