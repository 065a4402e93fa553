"""Distributed numbering and running totals against plain windows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import positions
from ledgerlens.operators.metrics import area_under_roc
from ledgerlens.operators.positions import number_rows, running_totals
from ledgerlens.operators.stats import exact_quantiles


def skewed(spark, n=3000, seed=1):
    """Rows of which a third share one group, with null groups and null order values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, f"g{rng.randrange(40)}"])
        rows.append((i, group, rng.choice([None, rng.randrange(25)]), rng.randrange(5)))
    return spark.createDataFrame(rows, "id bigint, g string, v int, w bigint").repartition(5)


@pytest.mark.parametrize("groups", [["g"], []])
def test_number_rows_equals_window(spark, many_partitions, groups):
    df = skewed(spark)
    window = Window.partitionBy(*groups).orderBy("v", "id")
    want = df.withColumn("row_idx", F.row_number().over(window).cast("bigint"))
    got = number_rows(df, ["v", "id"], groups)
    assert got.schema["row_idx"].dataType.simpleString() == "bigint"
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("groups", [["g"], []])
def test_running_totals_equal_window(spark, many_partitions, groups):
    df = skewed(spark, seed=2)
    window = Window.partitionBy(*groups).orderBy("v", "id")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0)))
    want = want.withColumn("w_total", F.sum("w").over(Window.partitionBy(*groups)))
    got = running_totals(df, ["v", "id"], ["w"], groups)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_large_group_is_spread_over_partitions(spark, many_partitions, monkeypatch):
    stored = []
    write = positions.materialize
    monkeypatch.setattr(positions, "materialize", lambda df, label: stored.append(write(df, label)) or stored[-1])
    number_rows(skewed(spark), ["v", "id"], ["g"])
    parts = stored[0].groupBy("g", F.shiftright("_seq", 33).alias("part")).count().collect()
    hot = [r["count"] for r in parts if r.g == "hot"]
    assert len(hot) > 1 and max(hot) < 0.75 * sum(hot)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id bigint, g string")
    assert number_rows(empty, ["id"]).count() == 0
    assert number_rows(empty, ["id"], ["g"]).count() == 0
    assert exact_quantiles(empty, ["id"], [0.5]).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=60))
def test_quantiles_equal_percentile(spark, many_partitions, values):
    df = spark.createDataFrame([(v,) for v in values], "x int").repartition(3)
    got = exact_quantiles(df, ["x"], [0.0, 0.5, 0.95, 1.0]).collect()
    want = df.agg(*[F.percentile("x", q) for q in (0.0, 0.5, 0.95, 1.0)]).first()
    if all(v is None for v in values):
        assert got == []
    else:
        assert list(got[0])[1:] == pytest.approx(list(want))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.booleans()), min_size=1, max_size=40))
def test_auc_equals_pair_counting(spark, many_partitions, rows):
    df = spark.createDataFrame([(float(s), float(y)) for s, y in rows], "score double, label double")
    got = area_under_roc(df.repartition(3), "score").first().auc
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        assert got is None
    else:
        won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got == pytest.approx(won / (len(pos) * len(neg)))
