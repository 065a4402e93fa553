"""Invariants of segmentation and the classifiers, with small settings."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from ledgerlens.operators import features, metrics, model_tables, models, segments
from ledgerlens.plans import pipeline
from ledgerlens.session import materialize, new_path
from ledgerlens.sources import csv
from ledgerlens.sources.bindings import bank_raw, retail_raw
from ledgerlens.sources.tables import Warehouse
from workload import queries

from .conftest import SF_DIR

KEY = ["c_custkey"]


@pytest.fixture(scope="module")
def gold(spark):
    return materialize(queries.gold(spark, "/root/testdata/sf0.01"), "gold")


@pytest.fixture(scope="module")
def split(gold):
    frame = features.subscription_frame(gold)
    return (*features.train_test_split(frame, KEY), features.subscription_features(frame))


def test_segments_are_numbered_by_spend(spark):
    stored = materialize(queries.rfm(spark, SF_DIR), "rfm")
    assigned = segments.segment_customers(stored)
    assert assigned.count() == stored.count()
    profile = segments.cluster_profile(assigned).collect()
    assert [r.segment_cluster for r in profile] == list(range(len(profile))) and len(profile) <= 4
    assert [r.avg_monetary for r in profile] == sorted(r.avg_monetary for r in profile)
    again = segments.segment_customers(stored.repartition(7))
    assert assigned.exceptAll(again).count() == 0


def test_split_is_a_function_of_the_key(gold):
    train, test = features.train_test_split(gold, KEY)
    moved, _ = features.train_test_split(gold.repartition(7), KEY)
    assert train.exceptAll(moved).count() == 0
    assert train.count() + test.count() == gold.count()
    assert 0.75 < train.count() / gold.count() < 0.85


def test_folds_are_even_within_the_training_rows(gold):
    train, _ = features.train_test_split(gold, KEY)
    sizes = [r["count"] for r in train.groupBy(features.fold_number(KEY).alias("fold")).count().collect()]
    assert len(sizes) == 3 and min(sizes) > 0.25 * sum(sizes)


def test_logistic_regression(split):
    train, test, columns = split
    model = models.fit_classifier(models.logistic_regression(max_iter=10), train, *columns)
    scored = models.score(model, test, ["c_custkey", "label"])
    assert scored.count() == test.count()
    assert scored.filter(~F.col("probability_1").between(0, 1)).count() == 0
    accuracy, auc = models.evaluate(scored)
    counts = {(r.label, r.prediction): r["count"] for r in metrics.confusion_matrix(scored).collect()}
    right = counts.get((0.0, 0.0), 0) + counts.get((1.0, 1.0), 0)
    assert accuracy == pytest.approx(right / sum(counts.values()))
    assert metrics.accuracy(scored).first().accuracy == pytest.approx(accuracy)
    assert metrics.area_under_roc(scored, "probability_1").first().auc == pytest.approx(auc, abs=1e-9)


def test_grid_search(split):
    train, _, columns = split
    result = models.tune_logistic_regression(train, *columns, key=KEY, folds=2)
    table = result.metrics.collect()
    assert {(r.reg_param, r.max_iter) for r in table} == {(0.01, 50), (0.01, 100), (0.1, 50), (0.1, 100)}
    best = [r for r in table if r.best]
    assert len(best) == 1 and best[0].avg_auc == max(r.avg_auc for r in table)
    assert result.model.stages[-1].getRegParam() == best[0].reg_param


def test_grid_search_equals_a_cross_validator(split):
    train, _, columns = split
    lr = models.logistic_regression()
    validator = CrossValidator(
        estimator=Pipeline(stages=[*features.feature_stages(*columns), lr]),
        estimatorParamMaps=models.lr_grid(lr),
        evaluator=BinaryClassificationEvaluator(labelCol="label"),
        numFolds=2,
        foldCol="fold",
        parallelism=4,
    )
    want = validator.fit(train.withColumn("fold", features.fold_number(KEY, 2)).cache()).avgMetrics
    got = models.tune_logistic_regression(train, *columns, key=KEY, folds=2).metrics
    assert [r.avg_auc for r in got.collect()] == pytest.approx(list(want), abs=1e-9)


def test_importances_carry_slot_names(split):
    train, _, columns = split
    model = models.fit_classifier(models.random_forest(trees=5, depth=4), train, *columns)
    importances = models.feature_importances(model, train)
    values = {r.feature: r.importance for r in importances.collect()}
    assert sum(values.values()) == pytest.approx(1.0)
    assert len(values) == model.stages[-1].numFeatures
    assert "duration" in values and any(name.startswith("job_ohe_") for name in values)
    top = models.top_importances(importances, 5).collect()
    assert len(top) == 5 and top[0].importance == max(values.values())


def test_credit_model_can_leave_out_the_balance(gold):
    frame = features.credit_frame(gold)
    train, test = features.train_test_split(frame, KEY)
    columns = features.credit_features(frame, exclude=["balance"])
    assert "balance" not in columns[1] and "credit_default" not in columns[0]
    model = models.fit_classifier(models.boosted_trees(rounds=2, depth=3), train, *columns)
    accuracy, auc = models.evaluate(model.transform(test), models.CREDIT_LABEL)
    assert 0 <= accuracy <= 1 and 0 <= auc <= 1


def test_unseen_category_and_ties(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "job string")
    model = features.category_indexer(["job"]).fit(train)
    seen = spark.createDataFrame([("a",), ("b",), ("c",), ("zz",), (None,)], "job string")
    assert {r.job: r.job_idx for r in model.transform(seen).collect()} == {"c": 0, "a": 1, "b": 2, "zz": 3, None: 3}


def test_layers_from_csv_feeds(spark):
    feeds = new_path(spark, "retail"), new_path(spark, "bank")
    csv.write_csv(retail_raw(spark, SF_DIR), feeds[0])
    csv.write_csv(bank_raw(spark, SF_DIR).drop("c_custkey"), feeds[1], sep=";")
    store = Warehouse(spark, new_path(spark, "warehouse"))
    pipeline.build_layers(store, csv.read_retail(spark, feeds[0]), csv.read_bank(spark, feeds[1]))
    gold = store.load("gold")
    assert gold.count() == store.load("silver").count() == store.load("bronze_bank").count()
    assert gold.columns[-1] == "job"
    assert store.load("segments").count() == store.load("retail_rollup").count()


def test_one_training_gives_all_outputs(gold, monkeypatch):
    fitted = []
    fit = models._fit_on_features
    monkeypatch.setattr(models, "_fit_on_features", lambda estimator, *rest: fitted.append(estimator) or fit(estimator, *rest))
    trained = pipeline.train_models(gold, KEY, trees=3, rounds=2, exclude_from_credit=["balance"])
    assert len(fitted) == 3
    table = trained.comparison.collect()
    assert sorted(r.model for r in table) == ["GBT", "Logistic Regression", "Random Forest"]
    assert [r.auc for r in table if r.best] == [max(r.auc for r in table)]
    for r in table:
        predictions, matrix = trained.predictions[r.model], trained.confusion[r.model].collect()
        label = matrix[0].__fields__[0]
        rows = predictions.collect()
        assert sum(m["count"] for m in matrix) == len(rows)
        assert sum(m["count"] for m in matrix if m[label] == m.prediction) == pytest.approx(r.accuracy * len(rows))
    assert set(trained.importances) == {"Random Forest", "GBT"}
    assert trained.importances["GBT"].agg({"importance": "sum"}).first()[0] == pytest.approx(1)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.range(400).selectExpr(
        "id AS c_custkey", "IF(id % 3 = 0, 'x', 'y') AS job", "CAST(id % 11 AS double) AS age",
        "CAST(id % 11 > 5 AS double) AS label", "CAST((id % 11 > 5) = (id % 3 = 0) AS double) AS credit_label",
    )
    rows = materialize(rows, "rows")
    return rows, {
        "label": models.fit_classifier(models.random_forest(4, 3), rows, ["job"], ["age"]),
        "credit_label": models.fit_classifier(models.boosted_trees(3, 3), rows, ["job"], ["age"]),
    }


PROBABILITIES = {"label": model_tables.forest_probabilities, "credit_label": model_tables.boosted_probabilities}


@pytest.mark.parametrize("label", PROBABILITIES)
def test_walking_sends_nodes_and_never_rows(fitted, label):
    rows, found = fitted
    walked = PROBABILITIES[label](found[label], rows, "c_custkey")
    plan = walked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BuildLeft" not in plan
    scored = {r.c_custkey: r.probability_1 for r in models.score(found[label], rows, ["c_custkey"]).collect()}
    assert {r.c_custkey: r.probability_1 for r in walked.collect()} == pytest.approx(scored)


def test_scores_meet_without_passing_the_driver(spark, fitted):
    rows, found = fitted
    again = model_tables.forest_probabilities(found["label"], rows, "c_custkey")
    both = queries._same_probabilities(spark, found["label"], rows, again, "label")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [c_custkey" in plan and "BuildLeft" not in plan
    assert both.count() == 400 and both.filter("same").count() == 400


@pytest.mark.parametrize("limits, fits", [((50, 100), 2 * 2 + 1), ((1, 100), 4 * 2 + 1)])
def test_a_fit_that_ended_by_itself_serves_the_larger_limits(spark, monkeypatch, limits, fits):
    n = 240
    data = [(i, float((i * 37 % 100) + (i % 3) * 9 > 70), i * 37 % 100 / 7, i * 11 % 13 * 1.0, "ab"[i % 2]) for i in range(n)]
    rows = spark.createDataFrame(data, "k int, label double, x double, z double, c string")
    grid = [{"regParam": r, "maxIter": m} for r in (0.01, 0.1) for m in limits]
    monkeypatch.setattr(models, "lr_grid", lambda lr: [{getattr(lr, name): v for name, v in point.items()} for point in grid])
    fitted = []
    fit = models.LogisticRegression._fit
    monkeypatch.setattr(models.LogisticRegression, "_fit", lambda self, df: fitted.append(self.getMaxIter()) or fit(self, df))
    got = {(r.reg_param, r.max_iter): r.avg_auc for r in models.tune_logistic_regression(rows, ["c"], ["x", "z"], ["k"], folds=2).metrics.collect()}
    assert len(fitted) == fits
    # Every grid point by itself.
    folds = rows.withColumn("fold", features.fold_number(["k"], 2))
    for point in grid:
        own = []
        for fold in range(2):
            fitting, checking = folds.filter(F.col("fold") != fold), folds.filter(F.col("fold") == fold)
            model = models.fit_classifier(models.logistic_regression(point["maxIter"], point["regParam"]), fitting, ["c"], ["x", "z"])
            own.append(models.exact_auc("label").evaluate(model.transform(checking)))
        assert got[point["regParam"], point["maxIter"]] == pytest.approx(sum(own) / 2, abs=1e-9)
