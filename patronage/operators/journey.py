"""Clickstream aggregates per customer, the journey profile, and its summary.

Each collection is reduced to one row per customer before the star join, so the join
sees at most one row per customer and side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.expr import at_least, ladder, mean, ratio


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def session_stats(sessions: DataFrame) -> DataFrame:
    """Sessions, durations, devices and browsers per customer."""
    stats = (
        sessions.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_distinct("session_id").alias("total_sessions"),
            mean("duration_seconds").alias("avg_session_duration"),
            F.sum("duration_seconds").alias("total_session_time"),
            F.count_distinct("device_type").alias("device_types_used"),
            F.count_distinct("browser").alias("browsers_used"),
            _count(_is("device_type", "Mobile")).alias("mobile"),
            _count(_is("device_type", "Desktop")).alias("desktop"),
            F.count("browser").alias("browser_rows"),
            *[_count(_is("browser", b)).alias(b) for b in ("Chrome", "Safari", "Firefox")],
        )
    )
    device = ladder(
        [
            (F.col("mobile") > F.col("desktop"), "Mobile"),
            (F.col("desktop") > F.col("mobile"), "Desktop"),
        ],
        "Mixed",
    )
    # a browser is preferred when it has more rows than all others together
    browser = ladder(
        [(F.col(b) > F.col("browser_rows") - F.col(b), b) for b in ("Chrome", "Safari", "Firefox")], "Other"
    )
    return stats.withColumns({"device_preference": device, "browser_preference": browser}).drop(
        "mobile", "desktop", "browser_rows", "Chrome", "Safari", "Firefox"
    )


def page_view_stats(page_views: DataFrame) -> DataFrame:
    return (
        page_views.filter(F.col("session_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_distinct("view_id").alias("total_page_views"),
            F.count_distinct("page_url").alias("unique_pages_viewed"),
            mean("time_on_page").alias("avg_time_on_page"),
            F.sum("time_on_page").alias("total_time_on_pages"),
            at_least(mean("scroll_depth"), [(80, "High"), (50, "Medium")], "Low").alias("scroll_engagement"),
        )
    )


def event_stats(
    events: DataFrame, purchase: str = "purchase", cart: str = "add_to_cart", form: str = "form_submit"
) -> DataFrame:
    stats = (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_distinct("event_id").alias("total_events"),
            _count(_is("event_type", "click")).alias("click_events"),
            _count(_is("event_type", "scroll")).alias("scroll_events"),
            _count(_is("event_type", form)).alias("form_submit_events"),
            _count(_is("event_type", cart)).alias("add_to_cart_events"),
            _count(_is("event_type", purchase)).alias("purchase_events"),
        )
    )
    category = ladder(
        [
            (F.col("purchase_events") + F.col("add_to_cart_events") > 0, "Converter"),
            (F.col("form_submit_events") > 0, "Engaged"),
            (F.col("click_events") > 5, "Active"),
        ],
        "Passive",
    )
    return stats.withColumn("event_category", category)


def interaction_stats(interactions: DataFrame, wishlist: Sequence[str] = ("wishlist",)) -> DataFrame:
    """``wishlist`` names the interaction types that count as wish-list additions."""
    return (
        interactions.filter(F.col("session_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_distinct("interaction_id").alias("total_interactions"),
            F.count_distinct("product_id").alias("unique_products_viewed"),
            _count(_is("interaction_type", "view")).alias("product_views"),
            _count(_is("interaction_type", "add_to_cart")).alias("cart_adds"),
            _count(F.col("interaction_type").isin(*wishlist)).alias("wishlist_adds"),
        )
        .withColumn("interaction_intensity", at_least("unique_products_viewed", [(10, "High"), (5, "Medium")], "Low"))
    )


def search_stats(searches: DataFrame) -> DataFrame:
    return (
        searches.filter(F.col("session_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_distinct("query_id").alias("total_search_queries"),
            F.count_distinct("search_term").alias("unique_search_terms"),
            F.count("clicked_result_position").alias("clicked_search_results"),
        )
        .withColumn(
            "search_effectiveness",
            ladder(
                [
                    (F.col("clicked_search_results") * 2 > F.col("total_search_queries"), "Effective"),
                    (F.col("clicked_search_results") > 0, "Moderate"),
                ],
                "Ineffective",
            ),
        )
    )


# Columns of the journey profile by source; counts default to 0, labels to 'Unknown'
SESSION_COLUMNS = ["total_sessions", "avg_session_duration", "device_preference", "browser_preference"]
PAGE_COLUMNS = ["total_page_views", "unique_pages_viewed", "avg_time_on_page", "scroll_engagement"]
EVENT_COLUMNS = ["total_events", "click_events", "add_to_cart_events", "purchase_events", "event_category"]
INTERACTION_COLUMNS = [
    "total_interactions", "unique_products_viewed", "product_views", "cart_adds", "interaction_intensity",
]
SEARCH_COLUMNS = [
    "total_search_queries", "unique_search_terms", "clicked_search_results", "search_effectiveness",
]
LABEL_COLUMNS = {
    "device_preference", "browser_preference", "scroll_engagement", "event_category",
    "interaction_intensity", "search_effectiveness",
}


def star_join(customers: DataFrame, parts: Sequence[DataFrame], key: str = "customer_id") -> DataFrame:
    """Left joins of pre-aggregated parts that share one key."""
    out = customers
    for part in parts:
        out = out.join(part, key, "left")
    return out


def fill_unmatched(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0 for measures and 'Unknown' for labels where a customer had no rows."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit("Unknown") if c in LABEL_COLUMNS else F.lit(0)) for c in columns}
    )


def journey_labels(profile: DataFrame) -> DataFrame:
    """Journey type, conversion status, complexity, engagement score, conversion probability."""
    bought = F.col("purchase_events") > 0
    carted = F.col("add_to_cart_events") > 0
    clicked = F.col("click_events") > 10
    sessions, pages = F.col("total_sessions"), F.col("unique_pages_viewed")
    often, again = sessions > 5, sessions > 1
    return profile.withColumns(
        {
            "journey_type": ladder(
                [(bought, "Converter"), (carted, "Engaged"), (often, "Explorer"), (again, "Browser")], "Visitor"
            ),
            "conversion_status": ladder([(bought, "Converted"), (carted, "Abandoned")], "Browsing"),
            "journey_complexity": ladder(
                [((sessions > 10) & (pages > 20), "Complex"), (often & (pages > 10), "Medium")], "Simple"
            ),
            "engagement_score": ladder([(bought, 100), (carted, 80), (clicked, 60), (often, 40), (again, 20)], 0),
            "conversion_probability": ladder(
                [(bought, 1.0), (carted, 0.7), (clicked, 0.5), (often, 0.3), (again, 0.1)], 0.0
            ),
        }
    )


def customer_journey(
    customers: DataFrame,
    sessions: DataFrame,
    page_views: DataFrame,
    events: DataFrame,
    interactions: DataFrame,
    searches: DataFrame,
) -> DataFrame:
    """One row per customer. Aggregates the profile does not show are pruned from the plan."""
    parts = [
        (session_stats(sessions), SESSION_COLUMNS),
        (page_view_stats(page_views), PAGE_COLUMNS),
        (event_stats(events), EVENT_COLUMNS),
        (interaction_stats(interactions), INTERACTION_COLUMNS),
        (search_stats(searches), SEARCH_COLUMNS),
    ]
    base = customers.select("customer_id", "email", "first_name", "last_name")
    joined = star_join(base, [df.select("customer_id", *columns) for df, columns in parts])
    return journey_labels(fill_unmatched(joined, [c for _, columns in parts for c in columns]))


def journey_summary(journey: DataFrame) -> DataFrame:
    keys = ["journey_type", "conversion_status", "journey_complexity", "device_preference", "browser_preference"]
    rows = F.count(F.lit(1))
    return (
        journey.groupBy(*keys)
        .agg(
            rows.alias("session_count"),
            F.round(mean("engagement_score"), 2).alias("avg_engagement_score"),
            F.round(F.avg("conversion_probability"), 3).alias("avg_conversion_probability"),
            F.round(mean("total_sessions"), 2).alias("avg_sessions"),
            F.round(mean("total_page_views"), 2).alias("avg_page_views"),
            F.round(F.avg("avg_session_duration"), 2).alias("avg_session_duration"),
            F.round(mean("unique_products_viewed"), 2).alias("avg_products_viewed"),
            F.round(mean("total_search_queries"), 2).alias("avg_search_queries"),
            ratio(_count(F.col("purchase_events") > 0), rows).alias("conversion_rate"),
            ratio(_count(F.col("add_to_cart_events") > 0), rows).alias("cart_add_rate"),
        )
        .orderBy(F.desc("session_count"), *keys)
    )


def journey_display(summary: DataFrame) -> DataFrame:
    return summary.select(
        "journey_type",
        "conversion_status",
        "session_count",
        F.round("avg_engagement_score", 1).alias("avg_engagement"),
        F.round(F.col("conversion_rate") * 100, 2).alias("conversion_rate_percent"),
        F.round(F.col("cart_add_rate") * 100, 2).alias("cart_add_rate_percent"),
    ).orderBy(F.desc("session_count"))
