"""How often models are fitted, and on what."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from patronage.models import forests, segmentation


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [(f"c{i:04d}", float(a), float(b), float(3 * a + b)) for i, (a, b) in enumerate(rng.normal(0, 1, (300, 2)))]
    return spark.createDataFrame(data, "customer_id string, a double, b double, y double").repartition(3, "customer_id")


def test_cross_validation_fits_the_folds_and_nothing_else(rows, monkeypatch):
    fits, plain = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: (fits.append(df.count()), plain(self, df))[1])
    got = forests.cross_validate(rows, ["a", "b"], "y", forests.REGRESSION, folds=4, trees=5, depth=4)
    assert len(fits) == 4 and sum(fits) == 3 * 300
    assert 0.5 < got["cv_r2_mean"] <= 1 and got["cv_r2_std"] >= 0


def test_cross_validation_needs_rows_in_every_fold(rows):
    with pytest.raises(ValueError, match="fold"):
        forests.cross_validate(rows.limit(1), ["a", "b"], "y", forests.REGRESSION, folds=4, trees=2, depth=2)


def test_restarts_share_the_features_alone_and_the_lowest_cost_wins(rows, monkeypatch):
    seen, plain = [], KMeans.fit

    def fit(self, df):
        model = plain(self, df)
        seen.append((df.columns, self.getSeed(), model.summary.trainingCost))
        return model

    monkeypatch.setattr(KMeans, "fit", fit)
    got = segmentation.train_kmeans(rows.withColumn("more", F.lit("x")), ["a", "b"], n_clusters=3, restarts=6)
    assert [c for c, _, _ in seen] == [["features"]] * 6 and {s for _, s, _ in seen} == set(range(42, 48))
    assert got.metrics["training_cost"] == min(cost for _, _, cost in seen)
    assert got.baseline["n_train"] == 300


def test_a_forest_reads_rows_at_hand_in_a_part_for_every_core(spark, rows, monkeypatch):
    seen, plain = [], Pipeline.fit

    def fit(self, df):
        seen.append((df.rdd.getNumPartitions(), df.is_cached, df.count()))
        return plain(self, df)

    monkeypatch.setattr(Pipeline, "fit", fit)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    few = rows.withColumn("c", F.when(F.col("a") > 0, "p").otherwise("q")).coalesce(1)
    got = forests.train_forest(few, ["a", "b"], "c", forests.CLASSIFICATION, trees=5, depth=4, stratify=True)
    assert seen == [(spark.sparkContext.defaultParallelism, True, got.baseline["n_train"])]
    assert got.baseline["n_train"] + got.baseline["n_test"] == 300 and got.metrics["accuracy"] > 0.9
    forests.cross_validate(few, ["a", "b"], "y", forests.REGRESSION, folds=4, trees=2, depth=2)
    assert [parts for parts, _, _ in seen[1:]] == [spark.sparkContext.defaultParallelism] * 4
    assert forests.train_forest(few, ["a", "b"], "y", forests.REGRESSION, min_rows=301) is None
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_restarts_meet_blocks_of_rows_and_large_ones_one_at_a_time(rows, monkeypatch):
    seen, running, plain = [], [], KMeans.fit

    def fit(self, df):
        running.append(self)
        seen.append((self.getSolver(), len(running)))
        model = plain(self, df)
        running.remove(self)
        return model

    monkeypatch.setattr(KMeans, "fit", fit)
    monkeypatch.setattr(segmentation, "COPIES_AT_ONCE", 300 * 2 * 8)
    segmentation.train_kmeans(rows, ["a", "b"], n_clusters=3, restarts=4)
    assert seen == [("block", 1)] * 4
