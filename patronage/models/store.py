"""Saved models with metadata, newest version first."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from patronage.models.forests import Forest
from patronage.models.segmentation import Segmentation
from patronage.sources.tables import read_latest_snapshot, run_label, write_snapshot

META_SCHEMA = "family string, name string, kind string, target string, features array<string>, metrics string, path string"


def save_model(
    spark: SparkSession, fitted: Forest | Segmentation, base: str, family: str, name: str, run_ts: datetime,
    extra: Mapping[str, object] | None = None,
) -> str:
    """Store the fitted stages and one metadata row under a run label."""
    path = f"{base}/{family}/{name}/model_{run_label(run_ts)}"
    fitted.model.write().overwrite().save(path)
    kind = fitted.kind if isinstance(fitted, Forest) else "clustering"
    target = fitted.target if isinstance(fitted, Forest) else "segment"
    metrics = json.dumps({**fitted.metrics, **(extra or {})}, sort_keys=True, default=str)
    meta = spark.createDataFrame(
        [(family, name, kind, target, fitted.features, metrics, path)], META_SCHEMA
    )
    write_snapshot(meta, f"{base}/{family}/{name}/metadata", run_ts)
    return path


def model_metadata(spark: SparkSession, base: str, family: str, name: str) -> DataFrame:
    return read_latest_snapshot(spark, f"{base}/{family}/{name}/metadata")


def load_latest_model(spark: SparkSession, base: str, family: str, name: str) -> Forest | Segmentation:
    row = model_metadata(spark, base, family, name).first()
    model = PipelineModel.load(row["path"])
    metrics = json.loads(row["metrics"])
    if row["kind"] == "clustering":
        return Segmentation(model, metrics)
    return Forest(row["kind"], row["target"], model, metrics)


def feature_list(spark: SparkSession, fitted: Forest | Segmentation) -> DataFrame:
    """The feature names as a table, in model order, for a CSV sink."""
    rows = [(name, position) for position, name in enumerate(fitted.features)]
    return spark.createDataFrame(rows, "feature string, position int")
