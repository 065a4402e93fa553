"""Registered queries against their SQL, on the smallest tables."""

import pytest

from ledgerlens.sources import bindings
from workload import queries
from workload.check import differences
from workload.queries import ORACLES, QUERIES

from .conftest import SF_DIR


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, name) is None


# Operators whose result could depend on how the rows are laid out.
LAYOUT_SENSITIVE = [
    "retail_summary", "first_country", "rfm", "silver_customer_360", "gold_master", "quantiles", "rfm_histogram",
    "auc", "split_counts", "string_index", "top_jobs", "vertical_preview", "dq_report",
]


@pytest.mark.parametrize("name", LAYOUT_SENSITIVE)
def test_independent_of_partitioning(spark, con, monkeypatch, many_partitions, name):
    opened = bindings.table
    spread = lambda *args: opened(*args).repartition(7)
    monkeypatch.setattr(bindings, "table", spread)
    monkeypatch.setattr(queries, "table", spread)
    assert differences(spark, con, SF_DIR, name) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["CustomerID", "Recency", "Frequency", "Monetary"]
    assert driver.queries().items() >= QUERIES.items()
    assert driver.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("missing", ["ledgerlens.llm", "ledgerlens.llm.queries", "corpus_pipeline"])
def test_entry_without_the_optional_part(monkeypatch, missing):
    import sys

    import __spark_entry__ as driver

    for name in [m for m in sys.modules if m.startswith(("ledgerlens.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert driver.queries().items() >= QUERIES.items() and "pipeline" not in driver.queries()
    assert driver.oracle_sql().items() >= ORACLES.items()
