"""Compare registered queries with their SQL: ``python -m workload.check [sf_dir] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from ledgerlens.session import local_session

from .queries import ORACLES, QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        return v.item() if hasattr(v, "item") else v

    columns = sorted(df.columns)
    rows = [tuple(value(v) for v in row) for row in df[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


# The type DuckDB should report for each Spark type.
_SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = QUERIES[name](spark, sf_dir)
    got = df.toPandas()
    if name not in ORACLES:
        return None if len(got) else "no rows"
    want = con.execute(ORACLES[name]).df()
    types = {c: _SQL_TYPES.get(t, t) for c, t in df.dtypes}
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    if types != described:
        return f"types {sorted(types.items() ^ described.items())}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(_canonical(got), _canonical(want), strict=True):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
