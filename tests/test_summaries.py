"""Sketches, selection, exact sums, duplicates by digest and category tables against plain definitions."""

import math
import random
import struct

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import exact, features, quality, selection, sketches
from workload import queries

from .conftest import SF_DIR


def test_sketches_merge_over_any_groups(spark):
    rows = spark.range(60_000).selectExpr("id % 3 AS g", "IF(id % 7 = 0, NULL, id % 20011) AS v", "CAST(id AS double) AS x")
    stored = sketches.distinct_sketches(rows, ["g"], ["v"])
    halves = [sketches.distinct_sketches(rows.filter(f"x % 2 = {k}"), ["g"], ["v"]) for k in (0, 1)]
    one, two = (sketches.united(s, []).first().estimate for s in (stored, sketches.merged(*halves)))
    true = rows.agg(F.count_distinct("v")).first()[0]
    assert one == two and abs(one - true) <= 4 * sketches.distinct_error() * true
    assert stored.agg(F.max(F.octet_length("sketch"))).first()[0] <= sketches.distinct_sketch_bytes()
    assert sketches.united(sketches.distinct_sketches(rows.filter("false"), ["g"], ["v"]), ["g"]).collect() == []


def test_windows_count_a_value_once(spark):
    lines = spark.createDataFrame(
        [(1, "a", "s", "1/5/2011 8:00"), (1, "a", "t", "2/5/2011 8:00"), (2, "b", "s", "4/5/2011 8:00"), (2, "c", "s", "rubbish")],
        "CustomerID int, InvoiceNo string, StockCode string, InvoiceDate string",
    )
    made = sketches.rolling(sketches.customer_month_sketches(lines), 3)
    got = {(r.month, r.column): r.estimate for r in made.collect()}
    assert got == {("2011-01", "InvoiceNo"): 1, ("2011-01", "StockCode"): 1, ("2011-02", "InvoiceNo"): 1, ("2011-02", "StockCode"): 2, ("2011-04", "InvoiceNo"): 2, ("2011-04", "StockCode"): 2}


def test_sketched_quantiles_have_their_rank(spark):
    random.seed(4)
    values = [(i % 5, random.choice([random.gauss(0, 1), random.expovariate(1) * 100, 7.0])) for i in range(40_000)]
    rows = spark.createDataFrame(values + [(0, None), (0, math.nan), (9, None)], "g int, v double").repartition(13)
    stored = sketches.rank_sketches(rows, ["g"], ["v"])
    merged = sketches.merged_ranks(stored.filter("g IN (1, 3)"), [])
    plain = pd.DataFrame(values, columns=["g", "v"])
    for chosen, made in (("true", sketches.merged_ranks(stored, [])), ("g IN (1, 3)", merged)):
        for r in sketches.sketched_quantiles(made, [0.0, 0.1, 0.5, 0.99, 1.0]).collect():
            n, low, high = duckdb.sql(f"SELECT count(*), count(*) FILTER (v < {r.value!r}), count(*) FILTER (v <= {r.value!r}) FROM plain WHERE {chosen}").fetchall()[0]
            assert r.n == n and low / n - 2 * sketches.rank_error() <= r.p <= high / n + 2 * sketches.rank_error()
    assert not [r for r in sketches.sketched_quantiles(stored, [0.5]).collect() if r.g == 9]
    assert len(plain)


@pytest.fixture
def narrow(monkeypatch):
    """Few pieces and few rows at the end, so that small groups take several passes."""
    monkeypatch.setattr(selection, "PIECES", 4)
    monkeypatch.setattr(selection, "FEW", 3)


def spread(n):
    rng = np.random.default_rng(8)
    rows = [("wide", float(10.0 ** rng.uniform(-300, 300)) * (-1) ** i) for i in range(n)]
    rows += [("ties", 5.0) for _ in range(n)] + [("ties", float(i)) for i in range(20)]
    rows += [(None, float(i)) for i in rng.integers(0, 50, n)] + [("one", 3.5), ("none", None), ("none", math.nan), ("signs", -0.0), ("signs", 0.0)]
    return rows


def test_quantiles_by_narrowing_are_exact(spark, narrow):
    rows = spread(600)
    got = {r.g: r for r in selection.quantiles_by(spark.createDataFrame(rows, "g string, v double").repartition(9), ["g"], ["v"], [0.0, 0.5, 0.95, 1.0]).collect()}
    assert set(got) == {"wide", "ties", None, "one", "signs"}
    for g, r in got.items():
        own = [v for k, v in rows if k == g and v is not None and v == v]
        assert r.n == len(own)
        assert [r.p0, r.p50, r.p95, r.p100] == pytest.approx(np.quantile(own, [0, 0.5, 0.95, 1]).tolist(), rel=1e-12)


def test_narrowing_takes_few_passes_and_places_nothing(spark, monkeypatch):
    steps, stored = [], selection.materialize

    def counted(df, label):
        steps.append(label)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "CartesianProduct" not in plan, label
        return stored(df, label)

    monkeypatch.setattr(selection, "materialize", counted)
    rows = spark.range(300_000).selectExpr("id % 2 AS g", "xxhash64(id) / 1e9 AS v")
    got = selection.quantiles_by(rows, ["g"], ["v"], [0.5])
    assert steps.count("left") <= 2
    want = rows.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("p50"))
    assert {r.g: r.p50 for r in got.collect()} == pytest.approx({r.g: r.p50 for r in want.collect()})


def test_capping_within_groups(spark, narrow):
    rows = [(g, float(i * (g + 1))) for g in range(3) for i in range(21)] + [(0, None), (None, 4.0)]
    got = selection.winsorize_by(spark.createDataFrame(rows, "g int, v double"), ["g"], ["v"], 0.9).collect()
    assert sorted(got, key=str) == sorted([(g, None if v is None else min(v, 18.0 * (g + 1)) if g is not None else v) for g, v in rows], key=str)


HARD = [1e300, 1.0, -1e300, 1e-300, 3.0, 0.1, -0.2, 1e16, 1.0, -1e16, 2.0**-1000, 123456.789, -5e-8, 0.0, -0.0]


def bits(x):
    return struct.pack("<d", x)


@pytest.mark.parametrize("seed", range(3))
def test_sums_have_the_same_bits_in_any_partitioning(spark, seed):
    rng = random.Random(seed)
    values = HARD + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(2_000)]
    rows = [(rng.randrange(3), v) for v in values] + [(5, None), (6, math.inf), (6, 1.0), (7, math.inf), (7, -math.inf), (8, -2.5), (None, 0.1), (None, 0.2)]
    df = spark.createDataFrame(rows, "g int, v double")
    want = {g: math.fsum(v for k, v in rows if k == g and v is not None) if g not in (5, 6, 7) else None for g in {k for k, _ in rows}}
    for parts in (1, 7, 50):
        got = {r.g: r.s for r in exact.exact_sums(df.repartition(parts), ["g"], {"s": "v"}).collect()}
        assert got[5] is None and got[6] == math.inf and math.isnan(got[7]) and set(got) == set(want)
        # The exact sum rounded once is what fsum gives.
        assert {g: bits(got[g]) for g in (0, 1, 2, 8, None)} == {g: bits(want[g]) for g in (0, 1, 2, 8, None)}
    whole = exact.exact_sums(df.filter("g < 3").repartition(11), [], {"s": "v", "t": "g"}).first()
    assert bits(whole.s) == bits(math.fsum(v for g, v in rows if g in (0, 1, 2))) and whole.t == sum(g for g, _ in rows if g in (0, 1, 2))


def test_duplicates_by_digest(spark):
    rows = [(1, None, "a"), (None, 1, "a"), (1, None, "a"), (None, None, None), (None, None, None), (2, 2, "b"), (1, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, `c d` string").repartition(3)
    assert quality.duplicate_count_by_digest(df).first()[0] == quality.duplicate_count(df).first()[0] == 2
    assert {tuple(r) for r in quality.digest_copies(df).collect()} == {(1, None, "a", 2), (None, None, None, 2)}
    assert sorted(quality.distinct_by_digest(df).collect(), key=str) == sorted(df.distinct().collect(), key=str)
    assert quality.duplicate_count_by_digest(df.filter("false")).first()[0] == 0


def test_unrepeated_rows_are_not_shuffled_whole(spark):
    wide = spark.range(1_000).selectExpr("id % 990 AS id", "repeat(string(id % 990), 50) AS text")
    plan = quality.digest_copies(wide)._jdf.queryExecution().executedPlan().toString()
    # The rows meet the repeated digests where they are; the only exchange of rows is that of the suspects.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_category_tables_number_as_the_indexer_does(spark):
    rows = [("b",), ("a",), ("b",), ("c",), ("a",), (None,), ("é",), ("",)]
    df = spark.createDataFrame(rows, "v string")
    table = features.category_table(df, ["v"])
    model = features.category_indexer(["v"]).fit(df)
    other = spark.createDataFrame([*rows, ("new",)], "v string")
    got, want = features.index_categories(other, table, ["v"]), model.transform(other)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_a_million_categories(spark):
    df = spark.range(1_500_000).selectExpr("concat('k', id % 1000000) AS v")
    table = features.category_table(df, ["v"])
    assert table.agg(F.count(F.lit(1)), F.min("position"), F.max("position"), F.count_distinct("position")).first() == (1_000_000, 0, 999_999, 1_000_000)
    first = table.filter("position IN (0, 500000)").orderBy("position").collect()
    # Half of the labels occur twice; of equals the alphabetically first comes first.
    assert [r.label for r in first] == ["k0", "k500000"]


def test_exact_windows_count_a_value_once(spark):
    random.seed(5)
    rows = [(random.choice("abcdef"), random.choice(["s", "t", None]), f"{random.randint(1, 12)}/7/{random.choice([2010, 2011])} 8:00") for _ in range(40)]
    rows += [(None, "u", "1/5/2011 8:00"), ("z", "z", "rubbish"), ("a", "s", None)]
    got = queries._exact_in_windows(spark.createDataFrame(rows, "InvoiceNo string, StockCode string, InvoiceDate string"), 3)
    want = {}
    for invoice, article, written in rows:
        if written and "/" in written:
            month = int(written.split("/")[2][:4]) * 12 + int(written.split("/")[0]) - 1
            for m in range(month, month + 3):
                for column, v in (("InvoiceNo", invoice), ("StockCode", article)):
                    want.setdefault((f"{m // 12}-{m % 12 + 1:02d}", column), set()).add(v)
    assert {(r.month, r.column): r.exact for r in got.collect()} == {k: len(v - {None}) for k, v in want.items()}


def test_windows_multiply_values_not_lines(spark):
    plan = queries.QUERIES["frequency_sketch_windows"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    # Below the exact counts lines are dealt evenly, and only what is distinct there reaches the windows.
    assert "RebalancePartitions [InvoiceNo" in plan and "Window [lag(start" in plan and "count(distinct" not in plan
