"""Score tables: model output, confidence, category and derived values per customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import cut, cut_ordinal
from patronage.models.density import density_segments
from patronage.models.forests import Forest, apply_forest, class_probability, top_probability
from patronage.models.segmentation import (
    Segmentation,
    assign_segments,
    attach_segment_profile,
    kmeans_names,
    segment_names,
    segment_stats,
)
from patronage.models.training import forecasting_inputs, journey_inputs
from patronage.operators.features import cut_equal, default_missing, expected_value, roi_estimate, with_purchases


def binned(df: DataFrame, column: str, bins: tuple[list, list], name: str) -> DataFrame:
    """A bin label and its ordinal."""
    edges, labels = bins
    return df.withColumn(name, cut(column, edges, labels)).withColumn(f"{name}_order", cut_ordinal(name, labels))


_PROFILED = ["monetary_value", "frequency", "engagement_score"]


def score_segments(segmentation: Segmentation, df: DataFrame, name: str = "kmeans") -> DataFrame:
    """Segment, confidence 1.0, and the profile of the segment among the scored customers."""
    buyers = with_purchases(df)
    column = f"{name}_segment"
    placed = assign_segments(segmentation, buyers, ["customer_id", *_PROFILED]).withColumnRenamed("segment", column)
    scores = placed.select("customer_id", column).withColumn(f"{name}_confidence", F.lit(1.0))
    return attach_segment_profile(scores, segment_stats(placed, column), column, name)


def score_segments_named(segmentation: Segmentation, df: DataFrame) -> DataFrame:
    """K-means segments with the fixed names of the five-cluster model."""
    placed = assign_segments(segmentation, df, ["customer_id"]).withColumnRenamed("segment", "kmeans_segment")
    return placed.withColumn("kmeans_segment_type", kmeans_names("kmeans_segment"))


def score_segment_requests(segmentation: Segmentation, profile: DataFrame, df: DataFrame, as_of: date) -> DataFrame:
    """Segment of each requested customer with the profile the segment had in training.

    ``profile`` is a :func:`segment_summary` of the training rows. Absent features count as
    0; a segment without a profile is 'Unknown'.
    """
    placed = assign_segments(segmentation, df, ["customer_id"])
    joined = placed.join(profile, "segment", "left")
    return joined.select(
        "customer_id",
        "segment",
        F.coalesce("segment_type", F.lit("Unknown")).alias("segment_type"),
        F.lit(0.8).alias("confidence_score"),
        F.lit(as_of).alias("inference_date"),
        *[c for c in profile.columns if c not in ("segment", "segment_type")],
    )


def score_density(df: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """Density segments are found anew among the scored customers."""
    buyers = with_purchases(df)
    placed = density_segments(buyers, features, **options).withColumnRenamed("segment", "density_segment")
    return segment_names(placed, "density_segment", name="density_segment_type")


def score_revenue(forest: Forest, df: DataFrame, as_of: date) -> DataFrame:
    return apply_forest(forest, df).select(
        "customer_id",
        F.col("prediction").alias("predicted_revenue"),
        F.lit(0.85).alias("forecast_confidence"),
        F.lit("next_month").alias("forecast_period"),
        F.lit(as_of).alias("forecast_date"),
    )


def score_ctr(forest: Forest, df: DataFrame, as_of: date) -> DataFrame:
    return apply_forest(forest, df).select(
        "customer_id",
        F.col("prediction").alias("predicted_ctr"),
        F.lit(0.80).alias("forecast_confidence"),
        F.lit("next_campaign").alias("forecast_period"),
        F.lit(as_of).alias("forecast_date"),
    )


def with_levels(scores: DataFrame, column: str, name: str) -> DataFrame:
    """Five equal-width levels over the range of a prediction."""
    return cut_equal(scores, column, k.FIVE_LEVELS, name)


def score_stage(forest: Forest, df: DataFrame, bins: tuple[list, list] = k.STAGE_BINS) -> DataFrame:
    scored = apply_forest(forest, df).select(
        "customer_id",
        F.col("predicted").alias("predicted_journey_stage"),
        top_probability().alias("stage_confidence"),
    )
    return binned(scored, "stage_confidence", bins, "stage_category")


def score_conversion(forest: Forest, df: DataFrame) -> DataFrame:
    """Regression variant: probability, category and expected value."""
    scored = apply_forest(forest, df).select(
        "customer_id",
        F.col("prediction").alias("predicted_conversion_probability"),
        F.lit(0.85).alias("conversion_confidence"),
    )
    return binned(scored, "predicted_conversion_probability", k.CONVERSION_BINS, "conversion_category").withColumn(
        "expected_value", expected_value("predicted_conversion_probability")
    )


def score_conversion_class(forest: Forest, df: DataFrame, positive: str = "1") -> DataFrame:
    """Classifier variant: probability of the positive label and a decision at one half."""
    scored = apply_forest(forest, df).select(
        "customer_id", class_probability(forest, positive).alias("conversion_probability")
    )
    decided = scored.withColumn("conversion_prediction", (F.col("conversion_probability") > 0.5).cast("int"))
    return binned(decided, "conversion_probability", k.PROBABILITY_BINS_COARSE, "conversion_category")


def score_success(forest: Forest, df: DataFrame, success: str = "high") -> DataFrame:
    """Predicted class, probability of the class that means success, confidence, category."""
    scored = apply_forest(forest, default_missing(df, forest.features)).select(
        "customer_id",
        F.col("predicted").alias("predicted_campaign_success"),
        class_probability(forest, success).alias("success_probability"),
    )
    p = F.col("success_probability")
    confident = scored.withColumn("success_confidence", F.greatest(p, F.lit(1.0) - p))
    return binned(confident, "success_probability", k.SUCCESS_BINS, "success_category")


def score_success_class(forest: Forest, df: DataFrame, positive: str = "1") -> DataFrame:
    """Two-class variant: probability of the positive label and a decision at one half."""
    scored = apply_forest(forest, default_missing(df, forest.features)).select(
        "customer_id", class_probability(forest, positive).alias("success_probability")
    )
    decided = scored.withColumn("success_prediction", (F.col("success_probability") > 0.5).cast("int"))
    return binned(decided, "success_probability", k.PROBABILITY_BINS_COARSE, "success_category")


def score_budget(forest: Forest, df: DataFrame) -> DataFrame:
    scored = apply_forest(forest, default_missing(df, forest.features)).select(
        "customer_id",
        F.col("prediction").alias("predicted_optimal_budget"),
        F.lit(0.85).alias("budget_confidence"),
    )
    with_roi = binned(scored, "predicted_optimal_budget", k.BUDGET_BINS, "budget_category").withColumn(
        "estimated_roi", roi_estimate("predicted_optimal_budget")
    )
    return binned(with_roi, "estimated_roi", k.ROI_BINS, "roi_category")


def score_all(
    models: Mapping[str, object],
    df: DataFrame,
    as_of: date,
    density_features: Sequence[str],
    lags: DataFrame | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """Score tables by (family, model). ``df`` should be a stored or checkpointed feature
    table: each score reads it once. A model that is not there is left out. ``lags`` are those of the
    scored rows, if the forecasting models were trained with lags from the data."""
    forecasting, journey = forecasting_inputs(df, lags), journey_inputs(df, as_of)
    scorers = {
        ("customer_segmentation", "kmeans"): ("kmeans", lambda m: score_segments(m, df)),
        ("forecasting", "revenue"): ("revenue", lambda m: score_revenue(m, forecasting, as_of)),
        ("forecasting", "ctr"): ("ctr", lambda m: score_ctr(m, forecasting, as_of)),
        ("journey_simulation", "journey_stage"): ("journey_stage", lambda m: score_stage(m, journey)),
        ("journey_simulation", "conversion_prediction"): ("conversion", lambda m: score_conversion(m, journey)),
        ("campaign_optimization", "campaign_success"): ("campaign_success", lambda m: score_success(m, df)),
        ("campaign_optimization", "budget_optimization"): ("budget", lambda m: score_budget(m, df)),
    }
    out = {label: score(models[name]) for label, (name, score) in scorers.items() if name in models}
    out["customer_segmentation", "density"] = score_density(df, density_features)
    return out
