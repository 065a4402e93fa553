"""The whole flow over a warehouse: every layer is written once and read back by the next."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators import metrics, models
from ..operators.cleaning import clean_bank, clean_retail, with_credit_default
from ..operators.customers import (
    customer_rollup,
    latest,
    link_customers,
    number_customers,
    rank_in_group,
    rfm_from_rollup,
)
from ..operators.features import (
    credit_features,
    credit_frame,
    subscription_features,
    subscription_frame,
    train_test_split,
)
from ..operators.segments import segment_customers
from ..session import materialize, side_by_side
from ..sources.tables import Warehouse
from .gold import gold_master


def build_bronze(store: Warehouse, retail: DataFrame, bank: DataFrame) -> None:
    side_by_side(
        lambda: store.save("bronze_retail", clean_retail(retail)),
        lambda: store.save("bronze_bank", clean_bank(bank)),
    )


def build_silver(store: Warehouse, key: Sequence[str] = ()) -> DataFrame:
    """Customer 360. The numbered rollup is stored as well: RFM and gold are read off it later."""
    bank = with_credit_default(store.load("bronze_bank"))
    rollup = customer_rollup(store.load("bronze_retail"), stored=True)
    ranked, numbered = side_by_side(
        lambda: rank_in_group(bank, key=key),
        lambda: store.save("retail_rollup", number_customers(rollup)),
    )
    return store.save("silver", link_customers(ranked, numbered))


def build_gold(store: Warehouse) -> DataFrame:
    as_of = latest(store.load("retail_rollup"), "last_purchase_date")
    return store.save("gold", gold_master(store.load("silver"), as_of))


def build_segments(store: Warehouse, k: int = 4, seed: int = 42, max_iter: int = 20) -> DataFrame:
    features = rfm_from_rollup(store.load("retail_rollup"))
    return store.save("segments", segment_customers(features, k, seed, max_iter))


def build_layers(store: Warehouse, retail: DataFrame, bank: DataFrame, key: Sequence[str] = ()) -> None:
    build_bronze(store, retail, bank)
    build_silver(store, key)
    side_by_side(lambda: build_gold(store), lambda: build_segments(store))


@dataclass
class TrainedModels:
    """What one training of the three classifiers gives. Predictions are stored frames of held-out rows."""

    models: dict[str, PipelineModel]
    predictions: dict[str, DataFrame]
    confusion: dict[str, DataFrame]
    importances: dict[str, DataFrame]
    comparison: DataFrame


def train_models(
    gold: DataFrame,
    key: Sequence[str] = (),
    trees: int = 100,
    rounds: int = 50,
    exclude_from_credit: Sequence[str] = (),
) -> TrainedModels:
    """Fit each of the three classifiers once, on the same split rule, and derive everything from those fits.

    The three trainings are independent and made of many short jobs, so they run at once.
    """
    key = key or gold.columns
    train, test = train_test_split(subscription_frame(gold), key)
    columns = subscription_features(gold)
    credit_train, credit_test = train_test_split(credit_frame(gold), key)
    credit_columns = credit_features(gold, exclude_from_credit)

    def finish(name, model, rows, label):
        kept = [c for c in dict.fromkeys([*key, label]) if c in rows.columns]
        predictions = materialize(models.score(model, rows, kept), "predictions")
        return name, model, predictions, models.evaluate(predictions, label), label

    def tuned_regression():
        return finish("Logistic Regression", models.tune_logistic_regression(train, *columns, key=key).model, test, models.LABEL)

    def forest():
        return finish("Random Forest", models.fit_classifier(models.random_forest(trees), train, *columns), test, models.LABEL)

    def boosted():
        model = models.fit_classifier(models.boosted_trees(rounds), credit_train, *credit_columns)
        return finish("GBT", model, credit_test, models.CREDIT_LABEL)

    done = side_by_side(tuned_regression, forest, boosted)
    return TrainedModels(
        models={name: model for name, model, *_ in done},
        predictions={name: predictions for name, _, predictions, *_ in done},
        confusion={name: metrics.confusion_matrix(predictions, label) for name, _, predictions, _, label in done},
        importances={
            name: models.feature_importances(model, credit_train if name == "GBT" else train)
            for name, model, *_ in done
            if hasattr(model.stages[-1], "featureImportances")
        },
        comparison=models.comparison(gold.sparkSession, {name: scores for name, _, _, scores, _ in done}),
    )


def compare_models(gold: DataFrame, key: Sequence[str] = (), **settings) -> DataFrame:
    """Accuracy and AUC of the three classifiers of :func:`train_models`, with the best marked."""
    return train_models(gold, key, **settings).comparison
