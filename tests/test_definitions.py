"""Which rows a query has must not depend on the columns it returns."""

import os

import duckdb
import pytest

from workload.check import differences, oracle_connection

from .conftest import SF_DIR


@pytest.fixture(scope="module")
def odd_tables(tmp_path_factory):
    """The test tables with a line without a part, one without an order, and a customer listed in two nations."""
    folder = tmp_path_factory.mktemp("odd")
    for name in os.listdir(SF_DIR):
        if name not in ("lineitem.parquet", "customer.parquet"):
            os.symlink(f"{SF_DIR}/{name}", folder / name)
    lines, customers = f"{SF_DIR}/lineitem.parquet", f"{SF_DIR}/customer.parquet"
    duckdb.sql(
        f"SELECT * FROM '{lines}' UNION ALL (SELECT * REPLACE (-1::BIGINT AS l_partkey) FROM '{lines}' WHERE l_linenumber < 3 LIMIT 40) "
        f"UNION ALL (SELECT * REPLACE (-1::BIGINT AS l_orderkey) FROM '{lines}' WHERE l_linenumber < 3 LIMIT 40)"
    ).write_parquet(str(folder / "lineitem.parquet"))
    duckdb.sql(
        f"SELECT * FROM '{customers}' UNION ALL SELECT * REPLACE (CAST((c_nationkey + 1) % 25 AS INTEGER) AS c_nationkey) FROM '{customers}' WHERE c_custkey % 9 = 1"
    ).write_parquet(str(folder / "customer.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["row_counts", "dq_report", "rfm", "retail_summary", "distinct_customers", "project", "label_distribution", "dedupe_rows"])
def test_orphans_and_rows_that_differ_elsewhere(spark, odd_tables, name):
    assert differences(spark, oracle_connection(odd_tables), odd_tables, name) is None
