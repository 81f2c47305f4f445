from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.models import density, forests, metrics, scoring, segmentation, store, training
from patronage.operators import splits
from patronage.operators import features as ft

from .conftest import AS_OF

FAST = {"trees": 10, "depth": 5}


def brute_density(x, eps, samples, size, ids):
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= samples
    label, seen, groups = -np.ones(len(x), int), set(), []
    for i in range(len(x)):
        if core[i] and i not in seen:
            stack, group = [i], []
            seen.add(i)
            while stack:
                u = stack.pop()
                group.append(u)
                for v in np.nonzero(near[u] & core)[0]:
                    if v not in seen:
                        seen.add(v)
                        stack.append(v)
            groups.append(group)
    groups = sorted((g for g in groups if len(g) >= size), key=lambda g: min(ids[i] for i in g))
    for n, g in enumerate(groups):
        label[g] = n
    return label


@pytest.mark.parametrize("dims,eps,samples,size", [(1, 0.3, 10, 50), (2, 0.15, 5, 10), (3, 0.3, 10, 20), (7, 0.6, 8, 15)])
def test_density_clusters_match_brute_force(spark, dims, eps, samples, size):
    rng = np.random.default_rng(dims)
    x = np.concatenate([
        rng.normal(0, 0.3, (200, dims)), rng.normal(2, 0.1, (80, dims)), rng.uniform(-3, 4, (120, dims)),
        rng.normal(-2, 0.01, (10, dims)), np.full((60, dims), 3.5),
    ])
    if dims == 2:  # two full strips facing each other at about the radius
        x = np.concatenate([
            x, np.c_[rng.uniform(5, 5.02, 150), rng.uniform(0, 0.5, 150)],
            np.c_[rng.uniform(5.16, 5.18, 150), rng.uniform(0, 0.5, 150)],
        ])
    ids = [f"p{i:04d}" for i in range(len(x))]
    axes = ", ".join(f"x{i} double" for i in range(dims))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, x)], f"k string, {axes}")
    got = {r["k"]: r["segment"] for r in density.density_clusters(df, "k", dims, eps, samples, size).collect()}
    assert [got[i] for i in ids] == brute_density(x, eps, samples, size, ids).tolist()


def test_connected_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)] + [("z1", "z2")], "u string, v string")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).union(spark.createDataFrame([("alone",)], "node string")).distinct()
    roots = {r["node"]: r["root"] for r in density.connected_components(nodes, edges).collect()}
    assert {roots[f"n{i:03d}"] for i in range(121)} == {"n000"}
    assert roots["z2"] == "z1" and roots["alone"] == "alone"


def test_many_points_at_one_position_are_paired_once(spark):
    """A third of the rows share a position beside loose points."""
    rng = np.random.default_rng(9)
    x = np.concatenate([np.zeros((400, 5)), rng.normal(0, 0.4, (300, 5)), rng.uniform(-2, 2, (300, 5))])
    ids = [f"p{i:04d}" for i in range(len(x))]
    axes = ", ".join(f"x{i} double" for i in range(5))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, x)], f"k string, {axes}")
    got = {r["k"]: r["segment"] for r in density.density_clusters(df, "k", 5, 0.5, 12, 20).collect()}
    assert [got[i] for i in ids] == brute_density(x, 0.5, 12, 20, ids).tolist()
    assert len(set(got.values())) > 1


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0), (None, 1.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["mse"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert row["r2"] == pytest.approx(1 - 2 / 8)
    labels = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    row = metrics.classification_metrics(labels, "y", "p").first()
    assert row["accuracy"] == 0.5 and row["recall"] == 0.5
    assert row["precision"] == pytest.approx((1.0 * 2 + 1 / 3) / 4)
    assert row["f1"] == pytest.approx((2 / 3 * 2 + 0.5) / 4)


def test_cluster_metrics(spark):
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, (40, 2)), rng.normal(8, 1, (60, 2))]
    c = np.r_[np.zeros(40), np.ones(60)].astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(g)) for (a, b), g in zip(x, c)], "a double, b double, c int")
    mean = x.mean(0)
    between = sum((c == g).sum() * ((x[c == g].mean(0) - mean) ** 2).sum() for g in (0, 1))
    within = sum(((x[c == g] - x[c == g].mean(0)) ** 2).sum() for g in (0, 1))
    assert metrics.calinski_harabasz(df, ["a", "b"], "c").first()[0] == pytest.approx(between / (within / 98))
    assert metrics.silhouette(df, ["a", "b"], "c") > 0.9
    assert metrics.silhouette(df.filter("c = 0"), ["a", "b"], "c") == 0.0
    stats = metrics.cluster_stats(df.withColumn("c", F.col("c") - 1), "c").first()
    assert (stats["n_clusters"], stats["n_noise"], stats["noise_ratio"]) == (1, 40, 0.4)


@pytest.fixture(scope="module")
def kmeans(warehouse):
    return segmentation.train_kmeans(ft.with_purchases(warehouse.train_part), k.SEGMENTATION_FEATURES, restarts=2)


def test_kmeans(warehouse, kmeans):
    scores = scoring.score_segments(kmeans, warehouse.infer_part)
    assert scores.count() == warehouse.infer_part.filter("monetary_value > 0").count()
    assert scores.select("kmeans_segment").distinct().count() <= 5
    assert kmeans.metrics["silhouette_score"] > 0 and len(kmeans.features) == len(set(k.SEGMENTATION_FEATURES))
    sizes = scores.groupBy("kmeans_segment").agg(F.count("*").alias("n"), F.max("kmeans_segment_size").alias("m"))
    assert sizes.filter("n != m").isEmpty()


def test_revenue_model_beats_the_mean_and_reloads(spark, warehouse, tmp_path):
    data = training.forecasting_inputs(warehouse.train_part)
    model = forests.train_revenue(data, **FAST)
    assert model.metrics["r2"] > 0.8 and model.features == k.REVENUE_FEATURES
    scoring_rows = training.forecasting_inputs(warehouse.infer_part)
    before = scoring.score_revenue(model, scoring_rows, AS_OF)
    store.save_model(spark, model, str(tmp_path), "forecasting", "revenue", datetime(2001, 1, 1))
    store.save_model(spark, model, str(tmp_path), "forecasting", "revenue", datetime(2001, 1, 2), {"version": "1.0"})
    loaded = store.load_latest_model(spark, str(tmp_path), "forecasting", "revenue")
    assert loaded.metrics["version"] == "1.0" and loaded.features == model.features
    assert scoring.score_revenue(loaded, scoring_rows, AS_OF).exceptAll(before).isEmpty()


def test_same_seed_gives_the_same_model(warehouse):
    data = training.campaign_inputs(warehouse.train_part, k.BUDGET_FEATURES)
    a, b = (forests.train_budget(data, trees=3, depth=3) for _ in range(2))
    assert a.metrics == b.metrics


def test_classifier_scores(warehouse):
    model = forests.train_stage(training.journey_inputs(warehouse.train_part, AS_OF), **FAST)
    assert model.metrics["accuracy"] > 0.8 and model.labels == sorted(model.labels)
    scores = scoring.score_stage(model, training.journey_inputs(warehouse.infer_part, AS_OF))
    low, high = scores.agg(F.min("stage_confidence"), F.max("stage_confidence")).first()
    assert 0 < low <= high <= 1
    assert set(r[0] for r in scores.select("predicted_journey_stage").distinct().collect()) <= set(model.labels)


def test_success_probability_is_that_of_the_named_class(warehouse):
    data = training.campaign_inputs(warehouse.train_part, k.SUCCESS_FEATURES).withColumn(
        "campaign_success", F.when(F.col("rfm_score") > 400, "high").when(F.col("rfm_score") > 200, "medium").otherwise("low")
    )
    model = forests.train_success(data, **FAST)
    scores = scoring.score_success(model, data)
    means = {r[0]: r[1] for r in scores.groupBy("predicted_campaign_success").agg(F.avg("success_probability")).collect()}
    assert means["high"] > 0.5 > means["low"]
    missing = forests.Forest(model.kind, model.target, model.model)
    assert scoring.score_success(missing, data, "no such label").agg(F.max("success_probability")).first()[0] == 0.0


def test_too_few_rows_train_nothing(warehouse):
    assert forests.train_revenue(training.forecasting_inputs(warehouse.train_part.limit(50))) is None


def test_cross_validation(warehouse):
    data = training.campaign_inputs(warehouse.train_part, k.BUDGET_FEATURES)
    got = forests.cross_validate(data, k.BUDGET_FEATURES, "optimal_budget", forests.REGRESSION, folds=3, trees=3, depth=3)
    assert set(got) == {"cv_r2_mean", "cv_r2_std"}


def test_segment_names_count_noise(spark):
    df = spark.createDataFrame([("a", -1), ("b", 0), ("c", 3), ("d", 3)], "customer_id string, s int")
    got = {r["customer_id"]: r["segment_type"] for r in segmentation.segment_names(df, "s").collect()}
    assert got == {"a": "Noise", "b": "Segment_1", "c": "Segment_2", "d": "Segment_2"}


def test_a_rare_class_is_in_every_fold(spark):
    rows = [(f"c{i:03d}", "rare" if i % 29 == 0 else None if i % 31 == 0 else "often") for i in range(203)]
    dealt = splits.stratified_folds(spark.createDataFrame(rows, "customer_id string, label string"), "label", 5)
    counts = dealt.groupBy("label", "fold").count().collect()
    for label in ("rare", "often", None):
        sizes = [r["count"] for r in counts if r["label"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert dealt.count() == len(rows) and dealt.columns == ["customer_id", "label", "fold"]


def test_absent_features_get_the_default_of_their_name(warehouse):
    forest = warehouse.model("campaign_success")
    known = warehouse.stored.limit(40)
    absent = [c for c in ("avg_roas", "rfm_score") if c in forest.features]
    assert absent
    filled = known.withColumns({c: F.lit({"avg_roas": 1.0, "rfm_score": 50.0}[c]) for c in absent})
    rows = lambda df: sorted(map(str, scoring.score_success(forest, df).collect()))
    assert rows(known.drop(*absent)) == rows(filled)


def test_density_row_of_the_training_report(spark):
    rows = [(f"{c}{i}", float(10 * c + i % 5 * 0.01), float(i % 3 * 0.01)) for c in range(2) for i in range(60)]
    df = spark.createDataFrame([*rows, ("far", 500.0, 0.0)], "customer_id string, a double, b double")
    got = segmentation.density_metrics(df, ["a", "b", "a"], eps=0.9, min_cluster_size=20)
    # the far row squeezes the first axis; the three values of the second one are 1.2 deviations apart
    assert got["n_noise"] == 1 and got["n_clusters"] == 3 and 0 < got["silhouette_score"] <= 1
    apart = spark.createDataFrame(rows, "customer_id string, a double, b double")
    got = segmentation.density_metrics(apart, ["a"], eps=0.3, min_cluster_size=20)
    assert got["n_clusters"] == 2 and got["n_noise"] == 0 and got["silhouette_score"] > 0.99
    none = segmentation.density_metrics(df.limit(0), ["a"], eps=0.3)
    assert none == {"n_clusters": 0, "n_noise": 0}
