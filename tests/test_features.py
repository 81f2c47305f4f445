from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.functions.constants import FIVE_LEVELS
from patronage.operators import features as ft
from patronage.plans import unify

AS_OF = date(2001, 8, 2)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(200), "x": rng.normal(0, 1, 200), "y": rng.pareto(1, 200)})
    pdf.loc[::17, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id int, x double, y double")


def test_median_and_clip_match_pandas(numbers):
    pdf, df = numbers
    got = ft.prepare_matrix(df, ["x", "y"]).toPandas().sort_values("id")
    for c in ("x", "y"):
        v = pdf[c].fillna(pdf[c].median())
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        np.testing.assert_allclose(got[c], v.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)), rtol=1e-12)


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 10.0], [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], [3.0, 3.0]])
def test_cut_equal_matches_pandas(spark, values):
    want = pd.cut(pd.Series(values), bins=5, labels=FIVE_LEVELS).astype(str).tolist()
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = [r["level"] for r in ft.cut_equal(df, "v", FIVE_LEVELS, "level").orderBy("i").collect()]
    assert got == want


def test_fill_typed(spark):
    df = spark.createDataFrame([(None, None, None, None)], "n decimal(10,2), s string, d date, b boolean")
    row = ft.fill_typed(df).first()
    assert (row["n"], row["s"], row["d"], row["b"]) == (0, "Unknown", None, None)


def test_default_missing_by_name(spark):
    df = ft.default_missing(spark.range(1), ["id", "order_count", "avg_x", "a_score", "idle_days", "zzz", "total_rate"])
    assert df.first().asDict() == {
        "id": 0, "order_count": 0.0, "avg_x": 1.0, "a_score": 50.0, "idle_days": 365.0, "zzz": 0.0, "total_rate": 0.0
    }


def test_select_available(spark):
    df, missing = ft.select_available(spark.range(1).withColumn("customer_id", F.lit("a")), ["id", "nope"])
    assert df.columns == ["customer_id", "id"] and missing == ["nope"]


def test_impute_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert [r[0] for r in ft.impute_mode(df, "c").collect()].count("a") == 3


@pytest.fixture(scope="module")
def orders(spark):
    rng = np.random.default_rng(5)
    rows = [
        (f"c{rng.integers(0, 4)}", f"t{i}", AS_OF - timedelta(days=int(rng.integers(0, 60))), int(rng.integers(1, 100)))
        for i in range(300)
    ]
    schema = "customer_id string, transaction_id string, order_date date, total_amount decimal(10,2)"
    from decimal import Decimal

    pdf = pd.DataFrame(rows, columns=["c", "t", "d", "v"])
    return pdf, spark.createDataFrame([(c, t, d, Decimal(v)) for c, t, d, v in rows], schema)


def test_lags_and_trailing_means_by_brute_force(orders):
    pdf, df = orders
    daily = pdf.groupby(["c", "d"])["v"].sum().to_dict()
    for r in ft.revenue_lags(df, AS_OF).collect():
        c, d = r["customer_id"], r["order_day"]
        for n in (1, 7, 30):
            assert r[f"revenue_lag_{n}"] == daily.get((c, d - timedelta(days=n)), 0)
        for n in (7, 30):
            total = sum(daily.get((c, d - timedelta(days=i)), 0) for i in range(n))
            assert r[f"revenue_ma_{n}"] == pytest.approx(total / n)


def test_order_history_by_brute_force(orders):
    pdf, df = orders
    rows = {r["customer_id"]: r for r in ft.order_history_features(df, AS_OF).collect()}
    for c, g in pdf.groupby("c"):
        days = sorted(g["d"])
        gaps = [(b - a).days for a, b in zip(days, days[1:])]
        assert rows[c]["total_orders"] == len(g)
        assert rows[c]["avg_days_between_orders"] == pytest.approx(np.mean(gaps))
        assert rows[c]["days_since_first_order"] == (AS_OF - days[0]).days
        recent = g[[d >= AS_OF - timedelta(days=30) for d in g["d"]]]
        assert rows[c]["order_count_30d"] == len(recent) and rows[c]["revenue_30d"] == recent["v"].sum()


def test_single_order_has_no_gap(spark, orders):
    _, df = orders
    assert ft.order_history_features(df.limit(1), AS_OF).first()["avg_days_between_orders"] is None


@pytest.mark.parametrize(
    "frequency,carts,views,stage",
    [(5, 0, 0, "loyal_customer"), (2, 0, 0, "repeat_customer"), (1, 9, 9, "first_time_buyer"),
     (0, 1, 9, "cart_abandoner"), (0, 0, 1, "product_browser"), (0, 0, 0, "visitor")],
)
def test_journey_stage(spark, frequency, carts, views, stage):
    df = spark.createDataFrame([(frequency, carts, views)], "frequency int, cart_adds int, product_views int")
    assert df.select(ft.journey_stage()).first()[0] == stage


def test_conversion_probability_is_additive_and_capped(spark):
    schema = "rfm_score int, total_page_views int, total_events int, total_interactions int, product_views int, cart_adds int"
    df = spark.createDataFrame([(0, 0, 0, 0, 0, 0), (41, 11, 0, 0, 0, 0), (61, 0, 6, 0, 0, 1), (500, 99, 99, 99, 99, 99)], schema)
    got = [r[0] for r in df.select(ft.additive_conversion_probability()).collect()]
    assert got == pytest.approx([0.1, 0.3, 0.6, 0.95])


def test_journey_path(spark):
    df = spark.createDataFrame([("purchase",), ("browse",), (None,)], "journey string")
    rows = ft.journey_path(df, 3).collect()
    assert [len(r["predicted_path"]) for r in rows] == [3, 3, 2]
    assert [r["expected_revenue"] for r in rows] == [150.0, 0.0, 0.0]


def test_unified_has_one_row_per_rfm_customer(warehouse):
    assert warehouse.stored.count() == warehouse.rfm.count() == 1427
    assert warehouse.stored.select("customer_id").distinct().count() == 1427
    assert set(unify.RFM_COLUMNS) <= set(warehouse.stored.columns)


def test_merge_suffix(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b", 2)], "k int, v string, w int")
    assert unify.merge_suffix(left, right, "k", "_r").first().asDict() == {"k": 1, "v": "a", "v_r": "b", "w": 2}


def test_demographics_with_repeats_do_not_multiply_customers(spark, warehouse):
    w = warehouse
    twice = w.demographics.unionByName(w.demographics.withColumn("household_size", F.lit(9)))
    joined = unify.join_customer_tables(unify.load_rfm(w.rfm), twice, w.journey, w.campaign_data, w.ab)
    assert joined.count() == 1427
