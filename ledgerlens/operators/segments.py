"""Customer segmentation with K-Means on standardised RFM."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean, rounded_mean, segment_band
from ..schemas import RFM_METRICS
from .features import assembler, standard_scaler

CLUSTER = "segment_cluster"
FIT_PARTITIONS, FIT_ROWS = 8, 500_000


def fit_segments(features: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20) -> PipelineModel:
    """Fit on rows placed and sorted by customer.

    The seeded start draws per partition, so the number of partitions follows from the number of rows
    and nothing else: a count that is given is neither taken from the session nor coalesced.
    """
    parts = max(FIT_PARTITIONS, -(-features.count() // FIT_ROWS))
    rows = features.fillna(0).repartition(parts, "CustomerID").sortWithinPartitions("CustomerID")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    kmeans = KMeans(featuresCol="rfm_scaled", predictionCol=CLUSTER, k=k, seed=seed, maxIter=max_iter)
    stages = [assembler(RFM_METRICS, "rfm_raw"), standard_scaler("rfm_raw", "rfm_scaled", center=True), kmeans]
    try:
        return Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()


def assign_segments(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Customers with their cluster, numbered from the lowest-spending centre to the highest."""
    centers = model.stages[-1].clusterCenters()
    monetary = list(RFM_METRICS).index("Monetary")
    by_spend = sorted(range(len(centers)), key=lambda i: tuple(centers[i][[monetary, 0, 1]]))
    new_number = F.array(*[F.lit(by_spend.index(i)) for i in range(len(centers))])
    clustered = model.transform(features.fillna(0))
    return clustered.select(
        "CustomerID", *RFM_METRICS, F.get(new_number, F.col(CLUSTER)).alias(CLUSTER)
    )


def check_segments(model: PipelineModel, segments: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row on what must hold of a clustering.

    How many customers and clusters there are; whether clusters are numbered by mean spend; whether each
    row is nearest to its own centre; and whether each centre is the mean of its rows, within the step
    that the last iteration may still have taken, in units of standard deviations.
    """
    vectors = PipelineModel(model.stages[:-1]).transform(segments)
    centers = sorted((c.tolist() for c in model.stages[-1].clusterCenters()), key=lambda c: (c[2], c[0], c[1]))
    position = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    scaled = vector_to_array("rfm_scaled")
    distance = lambda c: F.aggregate(F.zip_with(scaled, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    own = F.get(position, F.col(CLUSTER))
    rows = vectors.select(
        CLUSTER, "Monetary", (distance(own) <= F.array_min(F.transform(position, distance)) + 1e-9).alias("nearest"),
        *[scaled[i].alias(f"x{i}") for i in range(3)], *[own[i].alias(f"c{i}") for i in range(3)],
    )
    off = F.greatest(*[F.abs(F.avg(f"x{i}") - F.first(f"c{i}")) for i in range(3)])
    groups = rows.groupBy(CLUSTER).agg(
        F.count(F.lit(1)).alias("n"), F.avg("Monetary").alias("spend"), F.bool_and("nearest").alias("nearest"), off.alias("off")
    )
    spends = F.transform(F.array_sort(F.collect_list(F.struct(CLUSTER, "spend"))), lambda s: s["spend"])
    return groups.agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("clusters"), (spends == F.array_sort(spends)).alias("by_spend"),
        F.bool_and("nearest").alias("nearest"), (F.max("off") <= tolerance).alias("centred"),
    )


def segment_customers(features: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20) -> DataFrame:
    return assign_segments(fit_segments(features, k, seed, max_iter), features)


def cluster_profile(segments: DataFrame, cluster: str = CLUSTER) -> DataFrame:
    """Size and mean RFM of each cluster."""
    return (
        segments.groupBy(cluster)
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            rounded_mean("Recency", 1).alias("avg_recency"),
            rounded_mean("Frequency", 1).alias("avg_frequency"),
            rounded_mean("Monetary", 0).alias("avg_monetary"),
        )
        .orderBy(cluster)
    )


def band_profile(segments: DataFrame, cluster: str = CLUSTER) -> DataFrame:
    """Cluster means with the band their unrounded values fall into, biggest spenders first."""
    return (
        segments.groupBy(cluster)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded_mean("Recency", 0).alias("avg_recency_days"),
            rounded_mean("Frequency", 1).alias("avg_orders"),
            rounded_mean("Monetary", 0).alias("avg_spend_gbp"),
            segment_band(mean("Recency"), mean("Monetary")).alias("segment_label"),
        )
        .orderBy(F.desc("avg_spend_gbp"), cluster)
    )
