"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as Unicode defines it (fixed values).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NON_SPACE = re.compile(f"[^{WHITE_SPACE}]+")
SPACED_WORD = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``id`` and ``text``; whatever else the table has is left out."""
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D); a null text has none."""
    return text.encode().split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """``words_of`` with A-Z lowered and everything else unchanged."""
    return text.encode().lower().split() if text else []


def map_text(
    df: DataFrame,
    fields: list[tuple[str, T.DataType, pa.DataType]],
    rows: Callable[[list[str | None]], list[pa.Array]],
    batch_bytes: int = 8 << 20,
) -> DataFrame:
    """Compute columns from ``text`` batch by batch, next to ``id``. ``rows`` gets the texts of one batch."""
    schema = T.StructType([df.schema["id"], *[T.StructField(name, kind) for name, kind, _ in fields]])
    names = schema.names

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start, stop in slices_by_bytes(batch.column("text"), batch_bytes):
                part = batch.slice(start, stop - start)
                made = rows(part.column("text").to_pylist())
                columns = [part.column("id"), *[pa.array(c, kind) if isinstance(c, list) else c for c, (_, _, kind) in zip(made, fields, strict=True)]]
                yield pa.RecordBatch.from_arrays(columns, names)

    return df.select("id", "text").mapInArrow(batches, schema)


def filter_rows(df: DataFrame, text_col: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows, with all their columns, whose text ``keep`` is true of."""
    at = df.columns.index(text_col)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start, stop in slices_by_bytes(batch.column(at)):
                part = batch.slice(start, stop - start)
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(batches, df.schema)


def slices_by_bytes(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Cut a batch so that each piece holds about ``most`` bytes of text, or a single longer text."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def share_of(column: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the column's text, the split rule of the learning operators."""
    return F.crc32(F.encode(column.cast("string"), "UTF-8")) % parts


BLOCK_BYTES = 8 << 20


def blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int | None = None, rest: bool = False) -> tuple[DataFrame, int]:
    """``(block, id, text)``: rows dealt by hash to blocks of about ``block_bytes`` of text, and the number of blocks.

    Null texts become empty. With ``rest`` the other columns, of whatever names, go along in one struct.
    """
    rows = df.select(
        df[id_col].alias("id"),
        F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
        *([F.struct(*([df[c] for c in df.columns if c not in (id_col, text_col)] or [F.lit(True)])).alias("rest")] if rest else []),
    )
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, math.ceil(total / (block_bytes or BLOCK_BYTES)))
    return rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(count)).alias("block"), *rows.columns), count
