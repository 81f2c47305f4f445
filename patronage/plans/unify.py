"""One feature row per customer: RFM, demographics, journey, campaign and test results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import map_values, ratio
from patronage.operators.features import fill_typed, stamp
from patronage.operators.ranking import first_per_key

# Columns taken from each analysis
RFM_COLUMNS = [
    "customer_id", "email", "first_name", "last_name", "registration_date", "recency_days", "frequency",
    "monetary_value", "recency_score", "frequency_score", "monetary_score", "rfm_score", "rfm_segment",
    "customer_value_tier", "engagement_level", "total_items_purchased", "avg_order_value",
    "unique_purchase_days", "customer_lifetime_value", "purchase_frequency_rate",
]
DEMOGRAPHIC_COLUMNS = [
    "customer_id", "age_group", "education_level", "occupation", "household_size", "marital_status",
    "interests", "lifestyle_segment",
]
CAMPAIGN_COLUMNS = [
    "campaign_id", "campaign_name", "campaign_type", "channel", "target_audience", "start_date", "end_date",
    "budget", "status", "total_impressions", "total_clicks", "total_conversions", "total_revenue",
    "overall_ctr", "overall_conversion_rate", "overall_roas", "performance_segment", "efficiency_score",
    "budget_utilization_percent", "revenue_rank", "conversion_rank", "roas_rank",
]
AB_COLUMNS = [
    "test_id", "test_name", "campaign_id", "variant_a_description", "variant_b_description", "start_date",
    "end_date", "test_duration_days", "test_status", "variant_a_ctr", "variant_b_ctr",
    "variant_a_conversion_rate", "variant_b_conversion_rate", "ctr_lift_percentage",
    "conversion_lift_percentage", "revenue_lift_percentage", "winner", "confidence_level",
    "statistical_significance", "recommendation", "p_value", "sample_size_required",
]


def _project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def load_rfm(rfm: DataFrame) -> DataFrame:
    return _project(rfm, RFM_COLUMNS)


def project_demographics(demographics: DataFrame) -> DataFrame:
    return _project(demographics, DEMOGRAPHIC_COLUMNS)


def load_demographics(demographics_clean: DataFrame, customers_clean: DataFrame) -> DataFrame:
    """Demographics of clean customers; the parent key is unique, so a semi join."""
    return project_demographics(demographics_clean).join(
        customers_clean.select("customer_id"), "customer_id", "left_semi"
    )


def load_campaigns(cp: DataFrame) -> DataFrame:
    return _project(cp, CAMPAIGN_COLUMNS)


def load_ab_tests(ab: DataFrame) -> DataFrame:
    return _project(ab, AB_COLUMNS)


def load_journey(journey: DataFrame) -> DataFrame:
    return journey


def _significant():
    return F.count_if(F.col("statistical_significance") == "Yes")


def audience_summary(cp: DataFrame) -> DataFrame:
    """Campaign count, mean rates and revenue per target audience (NULL audience dropped)."""
    return (
        cp.filter(F.col("target_audience").isNotNull())
        .groupBy("target_audience")
        .agg(
            F.count("campaign_id").alias("campaign_count"),
            F.avg("overall_roas").alias("avg_roas"),
            F.avg("overall_ctr").alias("avg_ctr"),
            F.avg("overall_conversion_rate").alias("avg_conversion_rate"),
            F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_campaign_revenue"),
        )
    )


def ab_by_campaign(ab: DataFrame) -> DataFrame:
    return (
        ab.filter(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id")
        .agg(
            F.count("test_id").alias("ab_test_count"),
            F.avg("ctr_lift_percentage").alias("avg_ctr_lift"),
            F.avg("conversion_lift_percentage").alias("avg_conversion_lift"),
            _significant().alias("significant_tests"),
        )
    )


def ab_by_campaign_type(ab: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Mean lifts per campaign type. Tests are summed per campaign before the join, so it
    carries one row per campaign rather than one per test."""
    lifts = ("ctr_lift_percentage", "conversion_lift_percentage")
    per_campaign = ab.groupBy("campaign_id").agg(
        *[F.sum(c).alias(f"{c}_sum") for c in lifts],
        *[F.count(c).alias(f"{c}_n") for c in lifts],
        _significant().alias("significant"),
    )
    typed = per_campaign.join(campaigns.select("campaign_id", "campaign_type"), "campaign_id")
    return (
        typed.filter(F.col("campaign_type").isNotNull())
        .groupBy("campaign_type")
        .agg(
            ratio(F.sum("ctr_lift_percentage_sum"), F.sum("ctr_lift_percentage_n")).alias("avg_ctr_lift"),
            ratio(F.sum("conversion_lift_percentage_sum"), F.sum("conversion_lift_percentage_n")).alias(
                "avg_conversion_lift"
            ),
            F.sum("significant").alias("significant_ab_tests"),
        )
    )


def merge_suffix(left: DataFrame, right: DataFrame, on: str, suffix: str) -> DataFrame:
    """Left join; right columns whose name is taken get a suffix."""
    taken = set(left.columns) - {on}
    renamed = right.select(*[F.col(c).alias(c + suffix if c in taken else c) for c in right.columns])
    return left.join(renamed, on, "left")


def engineer_features(df: DataFrame, as_of: date) -> DataFrame:
    """Ratios and flags of the unified table. ``churn_risk`` is 1 / (recency + 1) and so is
    highest for the most recent buyers; the name is kept."""

    def n(name: str):
        return F.col(name).cast("double")

    sessions = F.col("total_sessions") + 1

    def flag(condition):
        return F.coalesce(condition, F.lit(False)).cast("int")

    first = df.withColumns(
        {
            "customer_age_days": F.datediff(F.lit(as_of), F.to_date("registration_date")).cast("bigint"),
            "days_since_last_purchase": F.col("recency_days"),
            "engagement_score_normalized": n("engagement_score") / 100,
        }
    )
    second = first.withColumn("purchase_velocity", ratio("frequency", F.col("customer_age_days") + 1))
    return second.withColumns(
        {
            "session_intensity": ratio("total_page_views", sessions),
            "conversion_efficiency": ratio("purchase_events", sessions),
            "search_intensity": ratio("total_search_queries", sessions),
            "product_exploration": ratio("unique_products_viewed", sessions),
            "cart_behavior": ratio("cart_adds", sessions),
            "rfm_composite": (n("recency_score") + n("frequency_score") + n("monetary_score")) / 3,
            "value_engagement_ratio": ratio("monetary_value", F.col("engagement_score") + 1),
            "campaign_response_rate": F.col("avg_ctr") * F.col("avg_conversion_rate"),
            "ab_test_impact": F.col("avg_ctr_lift") * F.col("avg_conversion_lift"),
            "churn_risk": ratio(F.lit(1), F.col("recency_days") + 1),
            "upsell_potential": n("monetary_value") * F.col("purchase_velocity"),
            "lifetime_value_potential": n("customer_lifetime_value") * F.col("engagement_score_normalized"),
            "is_high_value": flag(F.col("customer_value_tier") == "Premium"),
            "is_engaged": flag(F.col("engagement_level").isin("Highly Engaged", "Engaged")),
            "is_mobile_user": flag(F.col("device_preference") == "Mobile"),
            "is_return_visitor": flag(F.col("total_sessions") > 1),
        }
    )


def join_customer_tables(
    rfm: DataFrame,
    demographics: DataFrame,
    journey: DataFrame,
    campaigns: DataFrame,
    ab: DataFrame,
) -> DataFrame:
    """The left merges around the RFM table.

    RFM, demographics and journey are all keyed by customer_id, so their joins share one
    partitioning. The two campaign-level sides keep only the few audiences and types the
    fixed mappings name, which bounds the broadcast.
    """
    per_customer = demographics.transform(first_per_key, ["customer_id"], [])
    merged = rfm.join(per_customer, "customer_id", "left")
    merged = merge_suffix(merged, journey, "customer_id", "_journey")

    audiences = audience_summary(campaigns).filter(
        F.col("target_audience").isin(*sorted(set(k.SEGMENT_AUDIENCE.values())))
    )
    types = ab_by_campaign_type(ab, campaigns).filter(
        F.col("campaign_type").isin(*sorted(set(k.SEGMENT_CAMPAIGN_TYPE.values())))
    )
    return (
        merged.withColumn("target_audience", map_values("rfm_segment", k.SEGMENT_AUDIENCE))
        .join(F.broadcast(audiences), "target_audience", "left")
        .withColumn("campaign_type", map_values("rfm_segment", k.SEGMENT_CAMPAIGN_TYPE))
        .join(F.broadcast(types), "campaign_type", "left")
    )


def unify(
    rfm: DataFrame,
    demographics: DataFrame,
    journey: DataFrame,
    campaigns: DataFrame,
    ab: DataFrame,
    as_of: date,
    version: str = "1.0",
) -> DataFrame:
    """The unified customer table. RFM holds a customer once and every side is reduced to
    its join key first, so no join can repeat a customer and no closing distinct is needed.
    Customers without a successful order are not in RFM and so not here."""
    joined = join_customer_tables(rfm, demographics, journey, campaigns, ab)
    return stamp(fill_typed(engineer_features(joined, as_of)), version, as_of)


def attach_order_history(unified: DataFrame, history: DataFrame) -> DataFrame:
    """Add trailing order counts and revenue; customers without orders get NULL."""
    return merge_suffix(unified, history, "customer_id", "_history")
