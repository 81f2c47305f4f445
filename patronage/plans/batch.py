"""Train, store, score and report: the two runs a scheduler starts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from patronage.functions.constants import SEGMENTATION_FEATURES
from patronage.models import scoring, store, training
from patronage.plans import reports
from patronage.session import released
from patronage.sources.tables import write_csv, write_report, write_snapshot

# Model name to (family, name in the score tables)
FAMILIES = {
    "kmeans": ("customer_segmentation", "kmeans"),
    "revenue": ("forecasting", "revenue"),
    "ctr": ("forecasting", "ctr"),
    "journey_stage": ("journey_simulation", "journey_stage"),
    "conversion": ("journey_simulation", "conversion_prediction"),
    "campaign_success": ("campaign_optimization", "campaign_success"),
    "budget": ("campaign_optimization", "budget_optimization"),
}


def metrics_table(
    spark: SparkSession, fitted: Mapping[str, object], further: Mapping[str, Mapping[str, float]] | None = None
) -> DataFrame:
    """model, metric, value; ``further`` metrics by model come after those of the models."""
    tables = [(name, model.metrics) for name, model in fitted.items()] + list((further or {}).items())
    rows = [
        (name, metric, float(value)) for name, values in tables for metric, value in values.items() if value is not None
    ]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def _stored_report(report: DataFrame, folder: str, run_ts: datetime) -> DataFrame:
    """Keep a report under its run's label and read it back."""
    path = f"{folder}/run_ts={run_ts:%Y%m%d_%H%M%S}"
    write_report(report, path)
    return report.sparkSession.read.schema(report.schema).json(path)


def run_training(
    spark: SparkSession,
    train: DataFrame,
    as_of: date,
    base: str,
    run_ts: datetime,
    lags: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Fit and store every model with its feature list; returns the training report, stored
    under the run label. ``lags`` is the table ``training_forecast_lags``; a scoring run needs
    ``recent_forecast_lags`` then. Checkpoints of the run are deleted."""
    with released(spark):
        fitted = training.train_all(train, as_of, lags, **options)
        for name, model in fitted.items():
            family, label = FAMILIES[name]
            store.save_model(spark, model, base, family, label, run_ts)
            write_csv(store.feature_list(spark, model), f"{base}/{family}/{label}/features")
        further = training.further_metrics(train, **options)
        report = reports.training_report(metrics_table(spark, fitted, further))
        return _stored_report(report, f"{base}/training_report", run_ts)


def report_of(family: str, model: str, scores: DataFrame) -> DataFrame:
    if family == "customer_segmentation":
        return reports.segment_report(scores, model)
    if family == "forecasting":
        return reports.forecast_report(scores, f"predicted_{model}")
    if family == "journey_simulation":
        return reports.journey_report(scores, model)
    return reports.campaign_report(scores, model)


def run_scoring(
    spark: SparkSession,
    recent: DataFrame,
    as_of: date,
    models: str,
    base: str,
    run_ts: datetime,
    density_features: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    lags: DataFrame | None = None,
) -> DataFrame:
    """Score with the newest stored models, keep score tables and reports under the run
    label, and return the master report. Checkpoints of the run are deleted."""
    with released(spark):
        loaded = {name: store.load_latest_model(spark, models, *label) for name, label in FAMILIES.items()}
        score_tables = scoring.score_all(loaded, recent, as_of, density_features, lags)
        kept = {}
        for (family, model), scores in score_tables.items():
            folder = f"{base}/{family}/{model}"
            write_snapshot(scores, f"{folder}/scores", run_ts)
            kept[family, model] = spark.read.parquet(f"{folder}/scores/run_ts={run_ts:%Y%m%d_%H%M%S}")
            _stored_report(report_of(family, model, kept[family, model]), f"{folder}/report", run_ts)
        return _stored_report(reports.master_report(kept), f"{base}/master_report", run_ts)
