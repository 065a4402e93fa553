"""Feature preparation for the classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import credit_label, present, subscribed_label
from ..schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from ..session import materialize
from .positions import number_rows

SPLIT_SEED = 42


def assembler(columns: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep")


def standard_scaler(column: str, out: str, center: bool = False) -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=out, withStd=True, withMean=center)


def mean_imputer(columns: Sequence[str]) -> Imputer:
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy="mean")


def category_indexer(columns: Sequence[str]) -> StringIndexer:
    """One indexer for all columns: their categories are counted in the same job."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, label, position)``: the categories of each column by falling frequency, of equals by name, from 0.

    The same numbering as ``category_indexer`` gives, as a stored table: labels are counted with partial aggregates and
    numbered over range partitions, so any number of them is fine and none reaches the driver. Nulls are no category.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = texts.unpivot([], list(columns), "column", "label").filter("label IS NOT NULL").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    ranked = number_rows(counted.withColumn("less", -F.col("n")), ["less", "label"], ["column"], "position")
    return materialize(ranked.select("column", "label", (F.col("position") - 1).alias("position")), "categories")


def index_categories(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with ``<column>_idx``, a double; unseen labels and nulls get the number of categories, as with ``handleInvalid="keep"``."""
    for c in columns:
        own = table.filter(F.col("column") == c)
        unseen = own.agg(F.count(F.lit(1)).alias("n")).scalar()
        named = own.select(F.col("label").alias("_label"), F.col("position").alias("_position"))
        joined = df.join(named, df[c].cast("string") == named["_label"], "left")
        df = joined.select(*[df[x] for x in df.columns], F.coalesce("_position", unseen).cast("double").alias(f"{c}_idx"))
    return df


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns])


def feature_stages(categorical: Sequence[str], numeric: Sequence[str]) -> list[Estimator | Transformer]:
    """Index, encode, impute, assemble and scale; to be fitted on training rows only."""
    slots = [f"{c}_ohe" for c in categorical] + list(numeric)
    return [
        category_indexer(categorical),
        one_hot_encoder(categorical),
        mean_imputer(numeric),
        assembler(slots),
        standard_scaler("features", "scaled_features"),
    ]


def subscription_frame(gold: DataFrame) -> DataFrame:
    """The table with its label; a default flag under its old name takes the name the features have."""
    return _renamed(gold).withColumn("label", subscribed_label())


def _renamed(gold: DataFrame) -> DataFrame:
    return gold if "credit_default" in gold.columns else gold.withColumnRenamed("default", "credit_default")


def credit_frame(gold: DataFrame) -> DataFrame:
    """Label for credit risk; a table without the default flag falls back to ``y``."""
    gold = _renamed(gold)
    flag = "credit_default" if "credit_default" in gold.columns else "y"
    return gold.withColumn("credit_label", credit_label(flag))


def subscription_features(gold: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """The categorical and numeric features the table has, as ``subscription_frame`` names them."""
    gold = _renamed(gold)
    categorical = [c for c in present(gold, CATEGORICAL_FEATURES) if c not in exclude]
    return categorical, [c for c in present(gold, NUMERIC_FEATURES) if c not in exclude]


def credit_features(gold: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """As above without the default flag, which is part of the label.

    A negative balance is part of the label too; pass ``exclude=["balance"]`` for a model that does
    not see it.
    """
    return subscription_features(gold, ["credit_default", *exclude])


def _row_digest(key: Sequence[str], salt: str) -> Column:
    """32 bits of the MD5 of the row key: the same in every run, partitioning and engine."""
    text = F.concat_ws(":", F.lit(salt), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def split_flag(key: Sequence[str], train_share: float = 0.8, seed: int = SPLIT_SEED) -> Column:
    """True for training rows, decided by the row key alone."""
    return _row_digest(key, str(seed)) < F.lit(int(train_share * 2**32))


def train_test_split(
    df: DataFrame, key: Sequence[str] = (), train_share: float = 0.8, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Split by row key (all columns if none is named), so that reruns see the same rows."""
    flagged = split_flag(key or df.columns, train_share, seed)
    return df.filter(flagged), df.filter(~flagged)


def fold_number(key: Sequence[str], folds: int = 3, seed: int = SPLIT_SEED) -> Column:
    """The cross-validation fold of a row, from its key; independent of the train/test split."""
    return (_row_digest(key, f"fold{seed}") % folds).cast("int")
