"""Point-in-time lookups against a plain version over all pairs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from patronage.operators import asof, features

DAY0 = date(1999, 12, 20)


def plain(facts, key, day):
    known = sorted((d, v) for k, d, v in facts if k == key and d <= day)
    return (known[-1][1] if known else None), sum(v or 0 for _, v in known)


@pytest.mark.parametrize("width", [1, 7, 64, 100_000])
def test_state_equals_plain_version(spark, width):
    rng = random.Random(3)
    days = [DAY0 + timedelta(days=n) for n in range(120)]
    facts = [("hot", d, rng.randrange(100)) for d in days] + [("rare", days[5], 4), ("rare", days[90], 9), ("once", days[0], 1)]
    asked = [(k, rng.choice(days) + timedelta(days=rng.choice([-200, 0, 0, 0, 300])), i) for i, k in
             enumerate(["hot"] * 40 + ["rare"] * 20 + ["once", "once", "never"] * 4)]
    asked += asked[:3]
    got = asof.as_of_state(
        spark.createDataFrame(facts, "key string, day date, v long"),
        spark.createDataFrame(asked, "key string, day date, place int"), "key", "day", ["v"], width,
    )
    assert got.columns == ["key", "day", "place", "last_v", "total_v"]
    wanted = sorted((k, d, i, *plain(facts, k, d)) for k, d, i in asked)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:3]) == sorted(wanted, key=lambda r: r[:3])


def test_nulls_and_empty_sides(spark):
    facts = spark.createDataFrame([("a", None, 1), (None, DAY0, 2), ("a", DAY0, None)], "key string, day date, v long")
    asked = spark.createDataFrame([("a", DAY0), (None, DAY0), ("a", None)], "key string, day date")
    got = asof.as_of_state(facts, asked, "key", "day", ["v"])
    assert got.count() == 3
    assert {(r["last_v"], r["total_v"]) for r in got.collect()} == {(None, 0)}
    assert asof.as_of_state(facts.limit(0), asked, "key", "day", ["v"]).count() == 3
    assert asof.as_of_state(facts, asked.limit(0), "key", "day", ["v"]).count() == 0


def test_lags_never_see_the_label_day_or_later(spark):
    at = lambda n: DAY0 + timedelta(days=n)
    facts = spark.createDataFrame([("a", at(0), 5), ("a", at(3), 7), ("a", at(4), 11), ("a", at(9), 13)], "key string, day date, v long")
    labels = spark.createDataFrame([("a", at(4)), ("a", at(4)), ("a", at(11)), ("b", at(4)), ("a", None)], "key string, label_day date")
    got = asof.as_of_features(facts, labels, "key", "day", "label_day", ["v"], [1, 3], [4]).collect()
    assert sorted((r["key"], r["label_day"], r["v_lag_1"], r["v_lag_3"], r["v_sum_4"]) for r in got) == [
        ("a", at(4), 7, 5, 12), ("a", at(11), 13, 11, 13), ("b", at(4), None, None, 0),
    ]


def test_later_orders_do_not_change_training_lags(warehouse):
    w = warehouse
    labels = features.label_days(w.stored, date(2001, 8, 2), True)
    later = w.sold.join(labels, "customer_id").filter(F.col("order_date") >= F.col("label_day")).select(w.sold.columns)
    made_up = w.sold.unionByName(later.withColumn("total_amount", F.col("total_amount") * 3))
    # daily sums of the label day itself change, what came before it does not
    args = (w.valid_performance, w.campaigns)
    before = features.forecast_lags(labels, w.sold, *args)
    assert before.exceptAll(features.forecast_lags(labels, made_up.select(w.sold.columns), *args)).isEmpty()
    assert before.count() == w.stored.count()
    assert before.filter("revenue_lag_1 is not null").count() > 100


def test_training_uses_lags_of_the_data(warehouse):
    w = warehouse
    from patronage.models import training

    rows = training.forecasting_inputs(w.train_part, w.train_lags)
    assert rows.count() == w.train_part.count()
    same = rows.filter(F.col("revenue_lag_1") == F.col("monetary_value").cast("double") * 0.95)
    assert same.count() < rows.count() / 100


def test_plan_moves_one_key_in_buckets(spark):
    facts = spark.createDataFrame([("a", DAY0, 1)], "key string, day date, v long")
    plan = asof.as_of_state(facts, facts.select("key", "day"), "key", "day", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan and "Join Inner" not in plan and "CartesianProduct" not in plan


def test_lag_tables_share_one_sum_of_campaign_rows(warehouse, spark):
    part = spark.createDataFrame([("CUST_000001", "At Risk", 5)], "customer_id string, target_audience string, recency_days int")
    read = {file.rsplit("/", 1)[-1] for last in (True, False) for file in warehouse.forecast_lags(part, last).inputFiles()}
    assert "orders.parquet" in read
    assert "lineitem.parquet" not in read
