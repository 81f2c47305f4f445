from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronage.operators import abtest, campaign, journey

D = date(2001, 1, 1)
CAMPAIGN = (
    "campaign_id string, campaign_name string, campaign_type string, channel string, target_audience string, "
    "start_date date, end_date date, budget decimal(12,2), status string"
)
PERFORMANCE = "campaign_id string, impressions int, clicks int, conversions int, revenue decimal(10,2)"


@pytest.mark.parametrize(
    "roas,segment,score",
    [
        (None, "Poor", 0), (0.99, "Poor", 0), (1.0, "Low", 20), (1.49, "Low", 20), (1.5, "Low", 40), (2.0, "Medium", 60),
        (2.99, "Medium", 60), (3.0, "High", 80), (4.99, "High", 80), (5.0, "High", 100),
    ],
)
def test_campaign_ladders(spark, roas, segment, score):
    df = spark.createDataFrame([(roas, Decimal(1), Decimal(1))], "overall_roas double, total_revenue decimal(10,2), budget decimal(10,2)")
    row = campaign.campaign_segments(df).first()
    assert (row["performance_segment"], row["efficiency_score"]) == (segment, score)


def test_campaign_metrics_and_ranks(spark):
    campaigns = spark.createDataFrame(
        [("a", "A", "Email", "Google", "All", D, date(2001, 1, 11), Decimal(100), "Active"),
         ("b", "B", "Email", "Google", "All", D, D, Decimal(100), "Active"),
         ("c", "C", "Video", "Direct", "All", D, D, Decimal(50), "Active")], CAMPAIGN)
    performance = spark.createDataFrame([("a", 100, 10, 1, Decimal("30.00")), ("a", 100, 0, 0, Decimal("0.00")),
                                         ("b", 0, 0, 0, Decimal("30.00"))], PERFORMANCE)
    data = campaign.campaign_segments(campaign.campaign_metrics(campaigns, performance))
    rows = {r["campaign_id"]: r for r in campaign.campaign_ranks(data).collect()}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert (a["overall_ctr"], a["overall_conversion_rate"], a["overall_roas"]) == (0.05, 0.1, 0.3)
    assert (a["avg_daily_impressions"], b["avg_daily_revenue"], b["overall_ctr"]) == (20.0, 0.0, 0.0)
    assert c["total_revenue"] is None and c["overall_roas"] is None and c["overall_ctr"] == 0.0
    assert c["performance_segment"] == "Poor"
    assert [rows[i]["revenue_rank"] for i in "abc"] == [1, 2, 3], "ties by id, NULL last"


def test_daily_roas_is_capped(spark):
    performance = spark.createDataFrame([("a", 3, 1, 0, Decimal("90000.00"))], PERFORMANCE)
    campaigns = spark.createDataFrame([("a", Decimal("1.00"))], "campaign_id string, budget decimal(12,2)")
    row = campaign.derive_campaign_kpis(performance, campaigns).first()
    assert (row["ctr"], row["roas"]) == (0.3333, 999.99)


PROFILE = "purchase_events int, add_to_cart_events int, click_events int, total_sessions int, unique_pages_viewed int"


@pytest.mark.parametrize(
    "values,labels",
    [
        ((1, 0, 0, 0, 0), ("Converter", "Converted", "Simple", 100, 1.0)),
        ((0, 1, 0, 11, 21), ("Engaged", "Abandoned", "Complex", 80, 0.7)),
        ((0, 0, 11, 6, 11), ("Explorer", "Browsing", "Medium", 60, 0.5)),
        ((0, 0, 10, 6, 10), ("Explorer", "Browsing", "Simple", 40, 0.3)),
        ((0, 0, 0, 5, 50), ("Browser", "Browsing", "Simple", 20, 0.1)),
        ((0, 0, 0, 1, 0), ("Visitor", "Browsing", "Simple", 0, 0.0)),
    ],
)
def test_journey_ladders(spark, values, labels):
    row = journey.journey_labels(spark.createDataFrame([values], PROFILE)).first()
    assert (
        row["journey_type"], row["conversion_status"], row["journey_complexity"], row["engagement_score"],
        row["conversion_probability"],
    ) == labels


def test_customer_without_clicks_gets_defaults(spark, warehouse):
    customers = spark.createDataFrame([("nobody", "n@x", "N", "N")], "customer_id string, email string, first_name string, last_name string")
    w = warehouse
    row = journey.customer_journey(
        customers, w.view("sessions"), w.view("page_views"), w.view("click_events"), w.view("product_interactions"),
        w.view("search_queries"),
    ).first()
    assert row["total_sessions"] == 0 and row["avg_session_duration"] == 0
    assert {row[c] for c in journey.LABEL_COLUMNS} == {"Unknown"}
    assert row["journey_type"] == "Visitor"


def test_preferences(spark):
    sessions = spark.createDataFrame(
        [("s1", "c", 10, "Mobile", "Chrome"), ("s2", "c", 20, "Desktop", "Chrome"), ("s3", "c", 30, "Tablet", "Safari"),
         ("s3", "c", 30, "Mobile", "Safari"), ("s4", "d", 5, "Mobile", None), ("s5", None, 5, "Mobile", "Edge")],
        "session_id string, customer_id string, duration_seconds int, device_type string, browser string")
    rows = {r["customer_id"]: r for r in journey.session_stats(sessions).collect()}
    assert set(rows) == {"c", "d"}
    assert (rows["c"]["total_sessions"], rows["c"]["device_types_used"], rows["c"]["browsers_used"]) == (3, 3, 2)
    assert (rows["c"]["device_preference"], rows["c"]["browser_preference"]) == ("Mobile", "Other")
    assert rows["d"]["browser_preference"] == "Other"


def test_journey_types_of_the_sample(warehouse):
    got = {r[0]: r[1] for r in warehouse.journey.groupBy("journey_type").count().collect()}
    assert got == {"Converter": 335, "Engaged": 388, "Explorer": 176, "Browser": 426, "Visitor": 105}


def ab_row(spark, a, b):
    """One test with (impressions, clicks, conversions, revenue) of both variants."""
    tests = spark.createDataFrame(
        [("t", "T", "c", "x", "y", D, date(2001, 1, 8), 100, "Running")],
        "test_id string, test_name string, campaign_id string, variant_a_description string, variant_b_description string, "
        "start_date date, end_date date, sample_size int, test_status string")
    rows = [("t", "A", *a)] * bool(a) + [("t", "B", *b)] * bool(b)
    schema = "test_id string, variant string, impressions int, clicks int, conversions int, revenue int"
    return abtest.ab_results(tests, spark.createDataFrame(rows, schema)).first()


@pytest.mark.parametrize(
    "n,significance,confidence,p",
    [(499, "No", "Low", 0.5), (500, "Maybe", "90%", 0.1), (999, "Maybe", "90%", 0.1), (1000, "Yes", "95%", 0.05),
     (1999, "Yes", "95%", 0.05), (2000, "Yes", "99%", 0.01)],
)
def test_evidence_edges(spark, n, significance, confidence, p):
    row = ab_row(spark, (n, 10, 1, 5), (5000, 10, 1, 5))
    assert (row["statistical_significance"], row["confidence_level"], row["p_value"]) == (significance, confidence, p)
    assert row["sample_size_required"] == max(2000, n + 5000)


@pytest.mark.parametrize(
    "a,b,winner,advice",
    [
        ((1000, 10, 1, 5), (1000, 20, 4, 5), "B", "Implement Variant B"),
        ((1000, 20, 4, 5), (1000, 10, 1, 50), "A", "Implement Variant A"),
        ((1000, 10, 1, 5), (1000, 20, 1, 50), "B", "Implement Variant B"),
        ((1000, 10, 1, 50), (1000, 20, 1, 5), "A", "Implement Variant A"),
        ((1000, 10, 1, 5), (1000, 10, 1, 5), "Tie", "Inconclusive - Continue A"),
        ((400, 10, 1, 5), (400, 20, 4, 5), "B", "Continue Testing"),
        ((600, 10, 1, 5), (600, 20, 4, 5), "B", "Inconclusive - Continue A"),
    ],
)
def test_winner_and_recommendation(spark, a, b, winner, advice):
    row = ab_row(spark, a, b)
    assert (row["winner"], row["recommendation"]) == (winner, advice)


def test_test_without_results(spark):
    row = ab_row(spark, (), ())
    assert row["variant_a_clicks"] == 0 and row["total_clicks"] is None
    assert (row["winner"], row["ctr_lift_percentage"], row["sample_size_required"]) == ("Tie", 0.0, 2000)


def test_summary_rates_add_up(warehouse):
    summary = abtest.ab_summary(warehouse.ab)
    assert summary.agg(F.sum("test_count")).first()[0] == warehouse.ab.count() == 1779
    assert summary.filter((F.col("winner") == "Tie") & (F.col("clear_winner_rate") != 0)).isEmpty()
