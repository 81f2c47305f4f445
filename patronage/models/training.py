"""Fit all models of all families on one feature table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.models import forests, segmentation
from patronage.operators import features as ft


def forecasting_inputs(df: DataFrame, lags: DataFrame | None = None) -> DataFrame:
    """Calendar parts of the registration date, and lags from :func:`features.forecast_lags`;
    without such a table the simulated ones."""
    dated = ft.calendar_features(df, "registration_date")
    if lags is None:
        return ft.simulated_lags(dated)
    found = lags.drop("label_day")
    taken = [c for c in found.columns if c != "customer_id"]
    return dated.drop(*taken).join(found, "customer_id", "left").withColumn("ctr", F.col("avg_ctr"))


def journey_inputs(df: DataFrame, as_of: date) -> DataFrame:
    return ft.journey_features(df, as_of)


def campaign_inputs(df: DataFrame, features) -> DataFrame:
    """Labels from the raw values; features imputed and clipped."""
    labelled = ft.label_optimal_budget(ft.label_campaign_success(df))
    return ft.prepare_matrix(labelled, [c for c in features if c in df.columns])


def history_inputs(df: DataFrame) -> DataFrame:
    """Labels and the prepared order-history matrix of the second model variant."""
    return ft.prepare_matrix(ft.label_history(df), [c for c in k.ORDER_HISTORY_FEATURES if c in df.columns])


#: (rows, day, lags of the rows or None, options of the forest)
Trainer = Callable[..., object]

TRAINERS: dict[str, Trainer] = {
    "kmeans": lambda df, as_of, lags=None, **o: segmentation.train_kmeans(ft.with_purchases(df), k.SEGMENTATION_FEATURES),
    "revenue": lambda df, as_of, lags=None, **o: forests.train_revenue(forecasting_inputs(df, lags), **o),
    "ctr": lambda df, as_of, lags=None, **o: forests.train_ctr(forecasting_inputs(df, lags), **o),
    "journey_stage": lambda df, as_of, lags=None, **o: forests.train_stage(journey_inputs(df, as_of), **o),
    "conversion": lambda df, as_of, lags=None, **o: forests.train_conversion(journey_inputs(df, as_of), **o),
    "campaign_success": lambda df, as_of, lags=None, **o: forests.train_success(campaign_inputs(df, k.SUCCESS_FEATURES), **o),
    "budget": lambda df, as_of, lags=None, **o: forests.train_budget(campaign_inputs(df, k.BUDGET_FEATURES), **o),
}

_HISTORY_TARGETS = {
    "revenue": (forests.REGRESSION, "label_revenue"),
    "ctr": (forests.REGRESSION, "label_ctr"),
    "journey_stage": (forests.CLASSIFICATION, "label_stage"),
    "conversion": (forests.CLASSIFICATION, "label_conversion"),
    "campaign_success": (forests.CLASSIFICATION, "label_success"),
    "budget": (forests.REGRESSION, "label_budget"),
}


def train_all(df: DataFrame, as_of: date, lags: DataFrame | None = None, **options) -> dict[str, object]:
    """The seven fitted models (density segments are not a model: they are found when
    scoring). A forest without enough rows is left out."""
    fitted = {name: train(df, as_of, lags, **options) for name, train in TRAINERS.items()}
    return {name: model for name, model in fitted.items() if model is not None}


def further_metrics(
    df: DataFrame, folds: int = 5, eps: float = 0.1, min_samples: int = 10, min_cluster_size: int = 50, **options
) -> dict[str, dict[str, float]]:
    """What training reports beside its models: cross-validation of the campaign models (none for
    fewer than ``min_rows`` rows), and the density segments of the training rows."""
    least = options.pop("min_rows", 100)
    out: dict[str, dict[str, float]] = {}
    for name, features, target, kind in (
        ("campaign_success", k.SUCCESS_FEATURES, "campaign_success", forests.CLASSIFICATION),
        ("budget", k.BUDGET_FEATURES, "optimal_budget", forests.REGRESSION),
    ):
        rows = campaign_inputs(df, features)
        known = rows.filter(F.col(target).isNotNull()).count()
        if known >= least:
            out[name] = {**forests.cross_validate(rows, features, target, kind, folds, **options), "n_rows": known}
    out["density"] = segmentation.density_metrics(
        ft.with_purchases(df), k.SEGMENTATION_FEATURES, eps=eps, min_samples=min_samples, min_cluster_size=min_cluster_size
    )
    return out


def train_history(name: str, prepared: DataFrame, **options) -> object:
    """One model of the order-history variant, from :func:`history_inputs`."""
    if name == "kmeans":
        return segmentation.train_kmeans(prepared, k.ORDER_HISTORY_FEATURES)
    kind, target = _HISTORY_TARGETS[name]
    return forests.train_forest(prepared, k.ORDER_HISTORY_FEATURES, target, kind, **options)
