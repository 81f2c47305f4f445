from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions import expr as e

ALL_BINS = [
    k.SUCCESS_BINS, k.BUDGET_BINS, k.ROI_BINS, k.STAGE_BINS, k.CONVERSION_BINS, k.STAGE_BINS_COARSE,
    k.PROBABILITY_BINS_COARSE,
]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("edges,labels", ALL_BINS)
def test_cut_is_right_closed_like_pandas(spark, edges, labels):
    finite = [v for v in edges if v != float("inf")]
    values = sorted({v + d for v in finite for d in (-0.001, 0.0, 0.001)} | {finite[-1] * 10 + 7})
    want = pd.cut(pd.Series(values), bins=edges, labels=labels).astype(object)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = {r["v"]: r["b"] for r in df.select("v", e.cut("v", edges, labels).alias("b")).collect() if r["v"] == r["v"]}
    assert got.pop(None) is None
    assert [got[float(v)] for v in values] == [None if pd.isna(w) else w for w in want]


def test_cut_ordinal_follows_label_order(spark):
    df = spark.createDataFrame([("Low",), ("Premium",), (None,)], "b string")
    assert [r[0] for r in df.select(e.cut_ordinal("b", k.BUDGET_BINS[1])).collect()] == [0, 3, None]


def test_ratio0(spark):
    rows = [(1, 2, 0.5), (1, 0, 0.0), (1, None, 0.0), (None, 2, None), (3, -1, 0.0)]
    df = spark.createDataFrame([r[:2] for r in rows], "n int, d int")
    assert [r[0] for r in df.select(e.ratio0("n", "d")).collect()] == [r[2] for r in rows]


def test_whole_months_and_days(spark):
    cases = [
        ("2001-01-30", "2001-02-28", 0), ("2001-01-31", "2001-03-31", 2), ("2001-08-02", "2001-08-02", 0),
        ("2000-08-03", "2001-08-02", 11), ("2000-08-02", "2001-08-02", 12),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b")
    )
    assert [r[0] for r in df.select(e.months_between_whole("a", "b")).collect()] == [c[2] for c in cases]
    assert [r[0] for r in df.select(e.days_between("a", "b")).collect()][:3] == [29, 59, 0]


def test_age_group_edges(spark):
    as_of = date(2001, 8, 2)
    ages = [(25 * 365 - 1, "18-24"), (25 * 365, "25-34"), (35 * 365, "35-44"), (45 * 365, "45-54"), (55 * 365, "55+")]
    for days, want in ages:
        born = F.date_sub(F.lit(as_of), days)
        assert one(spark, e.age_group(born, as_of)) == want
    assert one(spark, e.age_group(F.lit(None).cast("date"), as_of)) is None


def test_hash_fraction_is_uniform_and_repeatable(spark):
    df = spark.range(20_000).select(e.hash_fraction("id", 42).alias("h"))
    low, high, mean = df.agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    assert df.filter("h < 0.7").count() == df.filter("h < 0.7").count()


def test_map_values_default(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [r[0] for r in df.select(e.map_values("c", {"a": "A"}, "none")).collect()] == ["A", "none", "none"]
    assert [r[0] for r in df.select(e.map_values("c", {"a": "A"})).collect()] == ["A", None, None]


def test_line_total(spark):
    assert float(one(spark, e.line_total(F.lit("1.15").cast("decimal(10,2)"), F.lit(3)))) == 3.45
