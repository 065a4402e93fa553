"""Scores of predictions, as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import running_totals


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    counts = predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(label, prediction)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hits = (F.col(label) == F.col(prediction)).cast("double")
    return predictions.agg(F.avg(hits).alias("accuracy"))


def area_under_roc(predictions: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs ranked rightly.

    Pairs are never formed. Labels are counted per distinct score, and each score's positives beat
    the negatives below it and half of those level with it.
    """
    positive = F.col(label) == 1.0
    by_score = predictions.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_totals(by_score, ["score"], ["pos", "neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))
