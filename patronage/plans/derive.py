"""All derived tables from the source tables, and where they are kept."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from patronage.operators import abtest, campaign, cleanup, features, journey, rfm, splits
from patronage.plans import unify
from patronage.sources.tables import read_parquet, write_parquet

Keep = Callable[[str, DataFrame], DataFrame]


def lazily(name: str, df: DataFrame) -> DataFrame:
    """Keep nothing: every table stays a logical plan."""
    return df


def in_folder(spark: SparkSession, base: str, mode: str = "overwrite") -> Keep:
    """Write each table below ``base`` and go on from the written rows. ``mode="ignore"``
    keeps tables that are there already."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        return read_parquet(spark, write_parquet(df, f"{base}/{name}", mode=mode))

    return keep


def derive_tables(sources: Mapping[str, DataFrame], as_of: date, months: int = 3, keep: Keep = lazily) -> dict[str, DataFrame]:
    """Cleaned tables, analyses, summaries, the unified table and its two time parts, by name.

    ``sources`` holds the thirteen operational tables under their own names. Each table is
    handed to ``keep`` once, in dependency order, and later steps read what it returns.
    """
    s = sources
    out: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(name, df)
        return out[name]

    customers = add("customers_clean", cleanup.clean_customers(s["customers"], as_of))
    demographics = add(
        "customer_demographics_clean", cleanup.clean_demographics(s["customer_demographics"], customers)
    )
    orders = add("transactions_clean", cleanup.clean_transactions(s["transactions"], customers, as_of))
    items = add("transaction_items_clean", cleanup.clean_items(s["transaction_items"], orders))
    campaigns = add("campaigns_clean", cleanup.clean_campaigns(s["campaigns"]))
    performance = add(
        "campaign_performance_clean", cleanup.clean_campaign_performance(s["campaign_performance"], campaigns)
    )
    tests = add("ab_tests_clean", cleanup.clean_ab_tests(s["ab_tests"], campaigns))
    results = add("ab_test_results_clean", cleanup.clean_ab_results(s["ab_test_results"], tests))
    add(
        "data_quality_summary",
        cleanup.dq_summary(
            {
                "customers": (customers, s["customers"]),
                "transactions": (orders, s["transactions"]),
                "campaigns": (campaigns, s["campaigns"]),
                "ab_tests": (tests, s["ab_tests"]),
            }
        ),
    )

    value = add("customer_rfm_data", rfm.customer_rfm(customers, orders, items, as_of))
    add("rfm_summary_stats", rfm.rfm_summary(value))

    metrics = campaign.campaign_segments(campaign.campaign_metrics(campaigns, performance))
    campaign_data = add("campaign_performance_data", campaign.campaign_ranks(metrics))
    add("campaign_channel_summary", campaign.channel_summary(campaign_data))
    add("campaign_type_summary", campaign.type_summary(campaign_data))

    paths = add(
        "customer_journey_data",
        journey.customer_journey(
            customers, s["sessions"], s["page_views"], s["events"], s["product_interactions"], s["search_queries"]
        ),
    )
    add("journey_pattern_summary", journey.journey_summary(paths))

    ab = add("ab_test_results_data", abtest.ab_results(tests, results))
    add("ab_test_summary_stats", abtest.ab_summary(ab))

    unified = add(
        "unified_customer_dataset",
        unify.attach_order_history(
            unify.unify(
                unify.load_rfm(value),
                unify.load_demographics(demographics, customers),
                unify.load_journey(paths),
                unify.load_campaigns(campaign_data),
                unify.load_ab_tests(ab),
                as_of,
            ),
            features.order_history_features(cleanup.successful_orders(orders), as_of),
        ),
    )
    train, recent = splits.timeline_split(unified, as_of, months)
    for part, rows, at_last_order in (("training", train, True), ("recent", recent, False)):
        kept = add(f"{part}_customer_dataset", rows)
        labels = features.label_days(kept, as_of, at_last_order)
        lags = features.forecast_lags(labels, cleanup.successful_orders(orders), performance, campaigns)
        add(f"{part}_forecast_lags", lags)
    return out
