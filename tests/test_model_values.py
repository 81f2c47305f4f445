"""Companions of the model and score queries: every value, without SQL."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from patronage.functions import constants as k
from patronage.models import forests, training
from patronage.operators.splits import train_test
from patronage.registry.oracle import ORACLES

from .conftest import SAMPLE


def test_every_query_that_publishes_a_flag_has_a_companion_with_the_values():
    hidden = {n for n, sql in ORACLES.items() if "true as sound" in sql or "true as consistent" in sql} | {"l22_score_all"}
    assert len(hidden) >= 29
    assert {f"{n}_values" for n in hidden} <= set(queries())


@pytest.mark.parametrize("kind, target", [(forests.REGRESSION, "optimal_budget"), (forests.CLASSIFICATION, "rfm_segment")])
def test_the_constant_guess_is_that_of_the_same_split(warehouse, kind, target):
    data = training.campaign_inputs(warehouse.train_part, k.BUDGET_FEATURES)
    data = data.withColumn("optimal_budget", F.col("recency_days") * 1.5)
    data = data.withColumn("rfm_segment", (F.col("recency_days") % 3).cast("string"))
    model = forests.train_forest(data, k.BUDGET_FEATURES, target, kind, trees=3, depth=3)
    rows = data.select("customer_id", F.col(target).cast("double" if kind == forests.REGRESSION else "string").alias(target))
    train, test = ([r[1] for r in part.collect()] for part in train_test(rows, 0.2, 42, "customer_id", None))
    got = model.baseline
    assert (got["n_train"], got["n_test"]) == (len(train), len(test))
    if kind == forests.REGRESSION:
        mean = sum(train) / len(train)
        assert got["baseline_rmse"] == pytest.approx((sum((y - mean) ** 2 for y in test) / len(test)) ** 0.5)
        assert (got["label_min"], got["label_max"]) == (min(train), max(train))
    else:
        major = min(set(train), key=lambda c: (-train.count(c), c))
        assert got["baseline_accuracy"] == pytest.approx(test.count(major) / len(test))


def test_values_are_published(spark):
    metrics = {r["metric"]: r["value"] for r in queries()["l7_budget_regressor_values"](spark, SAMPLE).collect()}
    assert {"mae", "mse", "rmse", "r2", "n_train", "n_test", "baseline_rmse", "beats_baseline"} <= set(metrics)
    assert (metrics["rmse"] < metrics["baseline_rmse"]) == bool(metrics["beats_baseline"])
    metrics = {r["metric"]: r["value"] for r in queries()["l1_kmeans_values"](spark, SAMPLE).collect()}
    assert metrics["beats_baseline"] == 1 and metrics["training_cost"] < metrics["baseline_cost"]
    scores = queries()["l16_score_revenue_values"](spark, SAMPLE)
    flags = queries()["l16_score_revenue"](spark, SAMPLE)
    assert scores.count() == flags.count() and flags.filter("not consistent").isEmpty()
    assert scores.select("predicted_revenue").distinct().count() > 5
    stages = queries()["l18_score_stage_values"](spark, SAMPLE)
    assert {"predicted_journey_stage", "stage_confidence", "stage_category"} <= set(stages.columns)
    every = queries()["l22_score_all_values"](spark, SAMPLE)
    assert {"predicted_revenue", "success_category", "kmeans_segment", "density_segment"} <= {
        r[0] for r in every.select("measure").distinct().collect()
    }
    cv = {r["metric"]: r["value"] for r in queries()["l14_cross_validation_accuracy_values"](spark, SAMPLE).collect()}
    assert {"cv_accuracy_mean", "n_rows", "baseline_cv_accuracy", "beats_baseline"} <= set(cv)
