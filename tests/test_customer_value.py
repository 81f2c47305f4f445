from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from patronage.operators import cleanup, rfm
from patronage.registry import oracle

from .conftest import SAMPLE_LARGER

AS_OF = date(2001, 8, 2)


def scored(spark, **values):
    base = {"recency_days": 10, "frequency": 1, "monetary_value": 1.0, **values}
    df = spark.createDataFrame([tuple(float(v) for v in base.values())], ", ".join(f"{n} double" for n in base))
    return rfm.rfm_segments(rfm.rfm_scores(df)).first()


@pytest.mark.parametrize(
    "days,score", [(29, 5), (30, 5), (31, 4), (60, 4), (61, 3), (90, 3), (91, 2), (180, 2), (181, 1), (None, 1)]
)
def test_recency_edges(spark, days, score):
    df = spark.createDataFrame([(days, 1, 1.0)], "recency_days int, frequency int, monetary_value double")
    assert rfm.rfm_scores(df).first()["recency_score"] == score


@pytest.mark.parametrize("n,score", [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (6, 3), (7, 4), (9, 4), (10, 5), (11, 5)])
def test_frequency_edges(spark, n, score):
    assert scored(spark, frequency=n)["frequency_score"] == score


@pytest.mark.parametrize(
    "v,score,tier",
    [
        (499.99, 1, "Minimal"), (500, 2, "Low"), (999.99, 2, "Low"), (1000, 2, "Medium"), (1499.99, 2, "Medium"),
        (1500, 3, "Medium"), (2000, 3, "High"), (2999.99, 3, "High"), (3000, 4, "High"), (4999.99, 4, "High"),
        (5000, 5, "Premium"),
    ],
)
def test_monetary_edges(spark, v, score, tier):
    row = scored(spark, monetary_value=v)
    assert (row["monetary_score"], row["customer_value_tier"]) == (score, tier)


@pytest.mark.parametrize(
    "days,segment", [(30, "Champions"), (60, "Loyal"), (90, "At Risk"), (180, "Can't Lose"), (181, "New")]
)
def test_segment_follows_recency(spark, days, segment):
    assert scored(spark, recency_days=days)["rfm_segment"] == segment


@pytest.mark.parametrize(
    "n,days,level",
    [
        (8, 60, "Highly Engaged"), (8, 61, "Engaged"), (7, 60, "Engaged"), (5, 91, "Moderately Engaged"),
        (3, 180, "Moderately Engaged"), (2, 180, "Low Engagement"), (1, 365, "Low Engagement"), (9, 366, "Inactive"),
    ],
)
def test_engagement_edges(spark, n, days, level):
    assert scored(spark, frequency=n, recency_days=days)["engagement_level"] == level


@pytest.fixture(scope="module")
def tiny(spark):
    customers = spark.createDataFrame(
        [("c1", "a@x", "A", "B", AS_OF - timedelta(days=400)), ("c2", "b@x", "C", "D", AS_OF - timedelta(days=5)),
         ("c3", "c@x", "E", "F", AS_OF)],
        "customer_id string, email string, first_name string, last_name string, registration_date date",
    )
    orders = spark.createDataFrame(
        [
            ("t1", "c1", AS_OF - timedelta(days=3), Decimal("10.00"), "Delivered"),
            ("t2", "c1", AS_OF - timedelta(days=3), Decimal("20.00"), "Shipped"),
            ("t3", "c1", AS_OF - timedelta(days=1), Decimal("99.00"), "Cancelled"),
            ("t4", "c2", AS_OF, Decimal("5.00"), "Shipped"),
            ("t5", "c3", AS_OF, Decimal("7.00"), "Pending"),
        ],
        "transaction_id string, customer_id string, order_date date, total_amount decimal(10,2), order_status string",
    )
    items = spark.createDataFrame(
        [("i1", "t1"), ("i2", "t1"), ("i3", "t1"), ("i4", "t2"), ("i5", "t3")], "item_id string, transaction_id string"
    )
    return customers, orders, items


def test_metrics_by_hand(tiny):
    rows = {r["customer_id"]: r for r in rfm.rfm_metrics(*tiny, AS_OF).collect()}
    assert set(rows) == {"c1", "c2"}, "customers without a successful order are left out"
    c1, c2 = rows["c1"], rows["c2"]
    assert (c1["recency_days"], c1["frequency"], c1["unique_purchase_days"], c1["total_items_purchased"]) == (3, 2, 1, 4)
    assert (c1["monetary_value"], c1["customer_lifetime_value"]) == (Decimal("30.00"), Decimal("37.5000"))
    assert c1["avg_order_value"] == 15.0 and c1["purchase_frequency_rate"] == pytest.approx(2 / 13)
    assert (c2["total_items_purchased"], c2["purchase_frequency_rate"], c2["recency_days"]) == (0, 0.0, 0)


def test_fanout_counts_an_order_once_per_item(tiny):
    rows = {r["customer_id"]: r for r in rfm.rfm_metrics(*tiny, AS_OF, item_fanout=True).collect()}
    assert rows["c1"]["monetary_value"] == Decimal("50.00")
    assert rows["c1"]["avg_order_value"] == 12.5
    assert rows["c2"]["monetary_value"] == Decimal("5.00")


def test_counts_of_the_sample(warehouse):
    """Sizes and sums against SQL over the same files."""
    con = duckdb.connect()
    for file in Path(SAMPLE_LARGER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")

    def sql(text):
        return con.execute(oracle._complete(text)).fetchall()

    w = warehouse
    tables = {
        "cust_ok": w.customers, "demo_ok": w.demographics, "txn_ok": w.transactions, "item_ok": w.items, "camp_ok": w.campaigns,
        "perf_ok": w.performance,
    }
    for name, df in tables.items():
        assert [(df.count(),)] == sql(f"select count(*) from {name}"), name
    segments = w.rfm.groupBy("rfm_segment").agg(F.count("*"), F.sum("monetary_value")).collect()
    wanted = sql("select rfm_segment, count(*), sum(monetary_value) from rfm group by 1")
    assert sorted(map(tuple, segments)) == sorted(wanted) and len(wanted) == 5
    fan = rfm.rfm_metrics(w.customers, w.transactions, w.items, AS_OF, item_fanout=True)
    assert [tuple(fan.agg(F.sum("monetary_value")).first())] == sql("select sum(monetary_value) from rfm_fan")


def test_parent_checks_are_implied_by_the_analysis(warehouse):
    """Row rules alone give the same analysis as the fully cleaned tables."""
    w = warehouse
    full = rfm.customer_rfm(w.customers, w.transactions, w.items, AS_OF)
    assert w.rfm.exceptAll(full).isEmpty() and full.exceptAll(w.rfm).isEmpty()


def test_same_result_with_other_partitioning(warehouse):
    w = warehouse
    before = sorted(map(str, w.rfm.collect()))
    old = w.spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            w.spark.conf.set("spark.sql.shuffle.partitions", n)
            again = rfm.customer_rfm(w.customers, w.valid_transactions, w.valid_items, AS_OF)
            assert sorted(map(str, again.collect())) == before
    finally:
        w.spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("fanout", [False, True])
def test_trusted_keys_give_the_same_metrics(warehouse, fanout):
    w = warehouse
    inputs = (w.customers, w.valid_transactions, w.valid_items, AS_OF)
    counted = rfm.rfm_metrics(*inputs, item_fanout=fanout)
    trusted = rfm.rfm_metrics(*inputs, item_fanout=fanout, trust_keys=True)
    assert counted.exceptAll(trusted).isEmpty() and trusted.exceptAll(counted).isEmpty()


def test_approximate_counts_are_close(warehouse):
    w = warehouse
    near = rfm.rfm_metrics(w.customers, w.transactions, w.items, AS_OF, approx=True).agg(F.sum("frequency")).first()[0]
    exact = w.rfm.agg(F.sum("frequency")).first()[0]
    assert abs(near - exact) / exact < 0.05


def test_rejects_complement_clean_rows(warehouse):
    raw = warehouse.view("customers")
    rules = cleanup.customer_rules(AS_OF)
    bad = cleanup.rejects(raw, rules)
    assert bad.count() + cleanup.passing(raw, rules).count() == raw.count()
    reasons = {r[0] for r in bad.select(F.explode("failed_rules")).distinct().collect()}
    assert reasons == {"email_missing", "email_malformed", "registered_in_future"}
