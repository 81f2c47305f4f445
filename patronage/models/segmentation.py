"""K-means segments, segment profiles and segment names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from patronage.functions import constants as k
from patronage.functions.expr import ladder, map_values, mean
from patronage.models.density import density_segments, scaled_axes
from patronage.models.metrics import calinski_harabasz, silhouette
from patronage.operators.ranking import global_row_number


#: Fits that run at the same time, and bytes that their copies of the features may take together.
RESTARTS_AT_ONCE, COPIES_AT_ONCE = 5, 1 << 30


@dataclass
class Segmentation:
    model: PipelineModel
    metrics: dict[str, float] = field(default_factory=dict)
    #: Rows and cost of a single cluster; known after fitting, not stored.
    baseline: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.model.stages[0].getInputCols())


def _filled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.select(
        *keep,
        *[
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c)
            for c in features
        ],
    )


def train_kmeans(
    df: DataFrame, features: Sequence[str], n_clusters: int = 5, restarts: int = 10, max_iter: int = 300, seed: int = 42
) -> Segmentation:
    """Standardise, then K-means from several seeds; the lowest within-cluster cost wins."""
    used = list(dict.fromkeys(features))
    data = _filled(df, used, [])
    assemble = VectorAssembler(inputCols=used, outputCol="raw_features")
    raw = assemble.transform(data)
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True).fit(raw)
    # every round of every fit reads the stored rows: nothing but the features is kept of them
    scaled = scaler.transform(raw).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    copy = 8 * len(used) * max(scaled.count(), 1)
    at_once = max(1, min(restarts, RESTARTS_AT_ONCE, COPIES_AT_ONCE // copy))

    # the distances of a block of rows are one product of matrices; every fit has its own copy of the blocks
    def fit(i: int):
        return KMeans(k=n_clusters, seed=seed + i, maxIter=max_iter, predictionCol="segment", solver="block").fit(scaled)

    # a fit is many short jobs, which leave cores idle one after the other
    with ThreadPool(at_once) as pool:
        fits = pool.map(inheritable_thread_target(scaled.sparkSession)(fit), range(restarts), chunksize=1)
    best = min(fits, key=lambda fitted: fitted.summary.trainingCost)  # the first of equal ones
    labelled = best.transform(scaled)
    axes = vector_to_array("features")
    scores = labelled.select("segment", *[axes[i].alias(f"f{i}") for i in range(len(used))])
    metrics = {
        "silhouette_score": ClusteringEvaluator(predictionCol="segment").evaluate(labelled),
        "calinski_harabasz_score": calinski_harabasz(scores, scores.columns[1:], "segment").first()[0],
        "training_cost": best.summary.trainingCost,
        "n_clusters": n_clusters,
    }
    squares = sum((F.col(c) * F.col(c) for c in scores.columns[1:]), F.lit(0.0))
    rows, cost = scores.agg(F.count(F.lit(1)), F.sum(squares)).first()  # the mean is 0 on every axis
    scaled.unpersist()
    return Segmentation(PipelineModel(stages=[assemble, scaler, best]), metrics, {"n_train": rows, "baseline_cost": cost})


def density_metrics(df: DataFrame, features: Sequence[str], **options) -> dict[str, float]:
    """Segments found, rows in none, and, with two segments or more, their mean silhouette on the
    standardised features; noise is no segment."""
    if df.isEmpty():
        return {"n_clusters": 0, "n_noise": 0}
    used = list(dict.fromkeys(features))
    placed = density_segments(df, used, **options)
    inside, outside = F.when(F.col("segment") >= 0, F.col("segment")), F.count_if(F.col("segment") < 0)
    found, noise = placed.agg(F.count_distinct(inside), outside).first()
    metrics: dict[str, float] = {"n_clusters": found, "n_noise": noise}
    if found >= 2:
        axes = scaled_axes(df, used, "customer_id")
        inside = axes.join(placed.filter(F.col("segment") >= 0), "customer_id")
        metrics["silhouette_score"] = silhouette(inside, [c for c in axes.columns if c != "customer_id"], "segment")
    return metrics


def assign_segments(segmentation: Segmentation, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns plus ``segment``."""
    data = _filled(df, segmentation.features, [F.col(c).alias(f"keep_{c}") for c in keep])
    scored = segmentation.model.transform(data)
    return scored.select(*[F.col(f"keep_{c}").alias(c) for c in keep], "segment")


def segment_type(monetary: Column, frequency: Column, recency: Column, engagement: Column) -> Column:
    return ladder(
        [
            ((monetary > 2000) & (frequency > 10), "High-Value Loyal"),
            ((monetary > 1000) & (recency < 30), "High-Value Recent"),
            ((frequency > 5) & (engagement > 70), "Engaged Regular"),
            ((recency < 60) & (engagement > 50), "Recent Engaged"),
            (recency > 180, "At Risk"),
        ],
        "Standard",
    )


def segment_profile(df: DataFrame, segment: str, measures: Sequence[str] = k.SEGMENT_MEASURES) -> DataFrame:
    """Mean and sample standard deviation of each measure, and the size, per segment."""
    out = []
    for m in measures:
        v = F.col(m).cast("double")
        out += [F.round(F.avg(v), 2).alias(f"{m}_mean"), F.round(F.stddev_samp(v), 2).alias(f"{m}_std")]
    return df.groupBy(segment).agg(*out, F.count(measures[0]).alias(f"{measures[0]}_count"))


def segment_summary(df: DataFrame, segment: str) -> DataFrame:
    """Size, averages and descriptive type per segment."""
    return (
        df.groupBy(F.col(segment).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            mean("monetary_value").alias("avg_monetary_value"),
            mean("frequency").alias("avg_frequency"),
            mean("recency_days").alias("avg_recency_days"),
            mean("engagement_score").alias("avg_engagement_score"),
        )
        .withColumn(
            "segment_type",
            segment_type(
                F.col("avg_monetary_value"),
                F.col("avg_frequency"),
                F.col("avg_recency_days"),
                F.col("avg_engagement_score"),
            ),
        )
    )


def segment_stats(df: DataFrame, segment: str) -> DataFrame:
    """Rounded means and size per segment of the scored customers."""
    return df.groupBy(segment).agg(
        F.round(mean("monetary_value"), 2).alias("monetary_value_mean"),
        F.count("monetary_value").alias("monetary_value_count"),
        F.round(mean("frequency"), 2).alias("frequency_mean"),
        F.round(mean("engagement_score"), 2).alias("engagement_score_mean"),
    )


def attach_segment_profile(scores: DataFrame, stats: DataFrame, segment: str, prefix: str) -> DataFrame:
    """Profile columns of its segment for every scored customer. The profile has one row per
    segment, so joining it does not move the scores unless there are very many segments."""
    return scores.join(stats, segment, "left").select(
        *scores.columns,
        F.concat(F.lit("Segment_"), F.col(segment).cast("string")).alias(f"{prefix}_segment_type"),
        F.coalesce("monetary_value_mean", F.lit(0.0)).alias(f"{prefix}_avg_monetary"),
        F.coalesce("frequency_mean", F.lit(0.0)).alias(f"{prefix}_avg_frequency"),
        F.coalesce("monetary_value_count", F.lit(0)).alias(f"{prefix}_segment_size"),
    )


def kmeans_names(segment: str) -> Column:
    """Fixed names of the five-cluster model."""
    return map_values(segment, k.KMEANS_SEGMENT_NAMES)


def segment_names(df: DataFrame, segment: str, noise: int = -1, name: str = "segment_type") -> DataFrame:
    """Names of density segments: 'Noise', else 'Segment_' and the position among the sorted
    ids, which counts the noise id."""
    ids = df.select(segment).distinct()
    placed = global_row_number(ids, [F.asc(segment)], "_position")
    label = F.when(F.col(segment) == noise, F.lit("Noise")).otherwise(
        F.concat(F.lit("Segment_"), (F.col("_position") - 1).cast("string"))
    )
    names = placed.withColumn(name, label).select(segment, name)
    return df.join(names, segment, "left").select(*df.columns, name)


def radar_means(df: DataFrame, segment: str, measures: Sequence[str] = k.RADAR_MEASURES) -> DataFrame:
    return df.groupBy(segment).agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in measures])

