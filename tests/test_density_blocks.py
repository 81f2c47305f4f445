"""Density clusters of many features: blocks, reach and links between blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.models import blocks, density

from .test_models import brute_density


def table(spark, x):
    axes = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame([(f"p{i:05d}", *map(float, r)) for i, r in enumerate(x)], f"k string, {axes}")


@pytest.fixture(scope="module")
def spread():
    """Tight groups, loose rows and a chain, on 33 axes of which most repeat a few."""
    rng = np.random.default_rng(5)
    base = np.concatenate([
        rng.normal(0, 1.0, (500, 6)), rng.normal(4, 0.2, (150, 6)), rng.uniform(-6, 6, (100, 6)),
        np.linspace(0, 1, 150)[:, None] * 9 - 5 + rng.normal(0, 0.02, (150, 6)),
    ])
    return np.repeat(base, 6, axis=1)[:, :33] + rng.normal(0, 0.05, (len(base), 33))


@pytest.mark.parametrize("eps", [0.1, 1.0, 2.5])
def test_many_features_in_small_blocks(spark, spread, monkeypatch, eps):
    monkeypatch.setattr(blocks.build, "__defaults__", (40,))
    monkeypatch.setattr(density, "AROUND", 2)
    got = {r["k"]: r["segment"] for r in density.density_clusters(table(spark, spread), "k", 33, eps, 5, 10).collect()}
    assert [got[f"p{i:05d}"] for i in range(len(spread))] == brute_density(spread, eps, 5, 10, np.array(sorted(got))).tolist()


def test_blocks_are_bounded_and_points_meet_only_those_in_reach(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 3, (4000, 2)), np.full((1, 2), 50.0)])
    x = np.repeat(x, 10, axis=1)
    points = table(spark, x).select(F.monotonically_increasing_id().alias("id"), F.lit(1).cast("long").alias("n"), F.array(*[f"x{i}" for i in range(20)]).alias("x"))
    index = blocks.build(points.persist(), 20, block=50)
    assert index.points.groupBy("block").count().agg(F.max("count")).first()[0] <= 400
    assert index.points.count() == len(x)
    row, _ = index.boxes.reached(x, 0.1)
    assert set(row) == set(range(len(x)))  # the own block at least
    assert len(row) < 4 * len(x)  # on three axes of the most values, which all say the same, all would meet along them


def test_points_at_exactly_the_radius_are_near():
    a = np.array([[0.1, 0.2], [0.4, 0.6], [1e6, 0.0]])
    b = np.array([[0.4, 0.6], [0.1, 0.2], [1e6 + 0.5, 0.0]])
    gap = a[0] - b[0]
    total = 0.0 + gap[0] * gap[0]
    total += gap[1] * gap[1]
    radius = float(np.sqrt(total))
    near = blocks.near(a, b, radius)
    assert near[0, 0] == (total <= radius * radius) and near[0, 1] and not near[2, :2].any()


def test_no_rows_and_no_core_points(spark, spread):
    few = table(spark, spread[:3])
    assert {r["segment"] for r in density.density_clusters(few, "k", 33, 0.1, 5, 5).collect()} == {-1}
    assert density.density_clusters(few.limit(0), "k", 33, 0.1, 5, 5).count() == 0
