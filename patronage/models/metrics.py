"""Model metrics as aggregates over a prediction table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.expr import ratio


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mae, mse, rmse, r2 (NULL where the label does not vary)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = df.filter(y.isNotNull() & p.isNotNull())
    error = y - p
    # sum of squares around the mean is n times the population variance
    return (
        both.agg(
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.var_pop(y).alias("variance"),
        )
        .withColumns({"rmse": F.sqrt("mse"), "r2": F.lit(1.0) - ratio("mse", "variance")})
        .select("mae", "mse", "rmse", "r2")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy and precision, recall and F1 weighted by label frequency. A class
    that is never predicted has precision 0. Works on the table of (label, prediction)
    counts, which is as small as the number of classes allows."""
    confusion = (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    actual = confusion.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    predicted = confusion.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    precision = F.coalesce(ratio("hits", "predicted"), F.lit(0.0))
    recall = ratio("hits", "support")
    per_class = actual.join(predicted, "c", "left").select(
        "support",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(ratio(precision * recall * 2, precision + recall), F.lit(0.0)).alias("f1"),
    )

    def weighted(name: str) -> Column:
        return ratio(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(name)

    return per_class.agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )


def silhouette(df: DataFrame, features: Sequence[str], cluster: str) -> float:
    """Mean silhouette with squared Euclidean distance. One cluster gives 0."""
    if df.select(cluster).distinct().limit(2).count() < 2:
        return 0.0
    points = VectorAssembler(inputCols=list(features), outputCol="_features").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(cluster).cast("double").alias("_cluster"))
    )
    return ClusteringEvaluator(featuresCol="_features", predictionCol="_cluster").evaluate(points)


def calinski_harabasz(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """One row: spread between clusters over spread within, each per degree of freedom.

    Per-cluster counts, sums and sums of squares are enough, so points are read once and
    combined on the map side.
    """
    v = {c: F.col(c).cast("double") for c in features}
    per_cluster = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(v[c]).alias(f"s{i}") for i, c in enumerate(features)],
        *[F.sum(v[c] * v[c]).alias(f"q{i}") for i, c in enumerate(features)],
    )
    axes = range(len(features))
    in_cluster = reduce(lambda a, b: a + b, [F.col(f"s{i}") * F.col(f"s{i}") / F.col("n") for i in axes])
    total = per_cluster.withColumn("m", in_cluster).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum("m").alias("m"),
        *[F.sum(f"{kind}{i}").alias(f"{kind}{i}") for kind in "sq" for i in axes],
    )
    grand = reduce(lambda a, b: a + b, [F.col(f"s{i}") * F.col(f"s{i}") / F.col("n") for i in axes])
    squares = reduce(lambda a, b: a + b, [F.col(f"q{i}") for i in axes])
    between = ratio(F.col("m") - grand, F.col("k") - 1)
    within = ratio(squares - F.col("m"), F.col("n") - F.col("k"))
    return total.select(F.coalesce(ratio(between, within), F.lit(0.0)).alias("calinski_harabasz"))


def cluster_stats(df: DataFrame, cluster: str, noise: int = -1) -> DataFrame:
    """One row: clusters, noise rows and noise share."""
    per = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    is_noise = F.col(cluster) == noise
    return per.agg(
        F.count_if(~is_noise).alias("n_clusters"),
        F.coalesce(F.sum(F.when(is_noise, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.sum("n").alias("n_rows"),
    ).select("n_clusters", "n_noise", ratio("n_noise", "n_rows").alias("noise_ratio"))
