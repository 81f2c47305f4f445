"""Operators that replace single-task forms must give the same results as those forms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators import quantiles, ranking, splits
from patronage.session import cut_lineage, released


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key and one value."""
    rng = np.random.default_rng(1)
    n = 3000
    value = np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(0, 50, n).round(1))
    pdf = pd.DataFrame({"id": [f"r{i:05d}" for i in range(n)], "v": value, "w": rng.pareto(1.0, n)})
    pdf["g"] = np.where(np.arange(n) % 3 == 0, "hot", pd.Series(rng.integers(0, 20, n)).astype(str))
    return pdf, spark.createDataFrame(pdf).repartition(6)


@pytest.mark.parametrize("pick_rows", [10, 100, 1_000_000])
def test_exact_quantiles(skewed, pick_rows):
    pdf, df = skewed
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.6, 0.8, 0.99, 1.0]
    got = quantiles.exact_quantiles(df, ["v", "w"], probs, pick_rows)
    assert got == quantiles.exact_quantiles(df, ["v", "w"], probs, 50)
    for c in ("v", "w"):
        np.testing.assert_allclose(got[c], np.quantile(pdf[c], probs), rtol=1e-12)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]) == {"v": [2.0]}
    assert quantiles.exact_quantiles(df.filter("v is null"), ["v"], [0.5]) == {"v": [None]}


def test_global_row_number(skewed):
    pdf, df = skewed
    order = pdf.sort_values(["v", "id"], ascending=[False, True])["id"].tolist()
    got = ranking.global_row_number(df, [F.desc("v"), F.asc("id")], "rank").select("id", "rank").toPandas()
    assert got.sort_values("rank")["id"].tolist() == order
    assert sorted(got["rank"]) == list(range(1, len(pdf) + 1))


def test_rank_within(skewed):
    _, df = skewed
    order = [F.desc("v"), F.asc("id")]
    got = ranking.rank_within(df, ["g"], order, "rank").select("id", "rank")
    want = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint").alias("rank"))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_first_per_key(skewed):
    pdf, df = skewed
    got = {r["g"]: r["id"] for r in ranking.first_per_key(df, ["g"], ["v", "id"]).collect()}
    assert got == pdf.sort_values(["v", "id"]).groupby("g")["id"].first().to_dict()


@pytest.mark.parametrize("strata", [None, "g"])
def test_exact_split_has_the_exact_size(skewed, strata):
    pdf, df = skewed
    got = splits.exact_split_flag(df, 0.8, 42, "id", strata)
    again = splits.exact_split_flag(df.repartition(3), 0.8, 42, "id", strata)
    assert got.count() == len(pdf) and got.exceptAll(again).isEmpty()
    groups = {None: len(pdf)} if strata is None else pdf.groupby(strata).size().to_dict()
    key = F.lit(None) if strata is None else F.col(strata)
    sizes = {r["k"]: r["n"] for r in got.filter("in_first").groupBy(key.alias("k")).agg(F.count("*").alias("n")).collect()}
    assert sizes == {g: int(n * 0.8 + 0.5) for g, n in groups.items()}


def test_random_split_is_a_partition(skewed):
    pdf, df = skewed
    a, b = splits.random_split(df, 0.7, 42, "id")
    assert a.count() + b.count() == len(pdf)
    assert a.join(b, "id").isEmpty()
    assert abs(a.count() / len(pdf) - 0.7) < 0.05


def test_checkpoints_of_a_released_block_are_deleted(spark):
    import os

    with released(spark):
        kept = cut_lineage(spark.range(10))
        folder = kept._jdf.queryExecution().logical().rdd().getCheckpointFile().get().removeprefix("file:")
        assert os.path.isdir(folder) and kept.count() == 10
    assert not os.path.exists(folder)
    assert cut_lineage(spark.range(3)).count() == 3


def test_any_number_of_rule_segments(spark):
    from datetime import date

    from patronage.operators import rules

    customers = spark.createDataFrame([("a", 5.0), ("b", 1200.0)], "customer_id string, spent double")
    rows = [(f"s{i:04d}", "", "", f'{{"spent": ">{i}"}}') for i in range(1203)]
    segments = spark.createDataFrame(rows, "segment_id string, segment_name string, segment_description string, criteria string")
    found = rules.assign_rule_segments(customers, segments, date(2001, 8, 2))
    assert sorted(tuple(r) for r in found.groupBy("customer_id").count().collect()) == [("a", 5), ("b", 1200)]
    assert rules.assign_rule_segments(customers, segments.limit(0), date(2001, 8, 2)).count() == 0


def test_timeline_split_counts(warehouse):
    from datetime import date

    train, infer = splits.timeline_split(warehouse.customers, date(2001, 8, 2))
    assert (train.count(), infer.count()) == (1138, 292)


def test_timeline_split_fallbacks(spark):
    from datetime import date

    df = spark.createDataFrame([(f"c{i}", None, date(2001, 8, 1)) for i in range(50)], "customer_id string, registration_date date, dataset_created_at date")
    train, infer = splits.timeline_split(df, date(2001, 8, 2))
    assert (train.count(), infer.count()) == (0, 50)
    train, infer = splits.timeline_split(df.drop("registration_date", "dataset_created_at"), date(2001, 8, 2))
    assert train.count() + infer.count() == 50 and train.count() > infer.count()
