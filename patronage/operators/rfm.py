"""Recency, frequency and monetary value per customer: metrics, scores, segments, summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import (
    at_least,
    at_most,
    days_between,
    ladder,
    mean,
    months_between_whole,
    ratio,
    ratio0,
)
from patronage.operators.cleanup import successful_orders


def rfm_metrics(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    as_of: date,
    statuses: Sequence[str] = k.SUCCESSFUL_STATUSES,
    item_fanout: bool = False,
    approx: bool = False,
    trust_keys: bool = False,
) -> DataFrame:
    """One row per customer with at least one successful order; others are left out.

    By default an order's amount counts once. ``item_fanout=True`` counts it once per
    item, which is what joining orders to items before summing gives. The joined rows
    are never built for that: an order carries its number of items as a weight.

    Orders and items are reduced to customer grain apart from each other, so the item
    table crosses the network as two narrow columns and a customer or order that holds
    a large share of the rows is combined on the map side. ``approx`` swaps the exact
    distinct counts for HyperLogLog sketches. ``trust_keys`` counts rows where the counted
    column is a declared primary key (``unique_violations`` tells whether it is one): items
    are then counted per order before anything is joined, which spares moving every item id
    twice.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    of_key = F.count if trust_keys else distinct
    sold = successful_orders(orders, statuses).select(
        "customer_id", "transaction_id", "order_date", "total_amount"
    )
    if item_fanout or trust_keys:
        per_order = items.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("item_rows"))
        sold = sold.join(per_order, "transaction_id", "left")
    weight = F.coalesce("item_rows", F.lit(1)) if item_fanout else F.lit(1)
    amount_weight = F.sum(F.when(F.col("total_amount").isNotNull(), weight))

    by_customer = sold.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"),
        of_key(F.col("transaction_id")).alias("frequency"),
        F.coalesce(F.sum(F.col("total_amount") * weight), F.lit(0)).cast("decimal(22,2)").alias("monetary_value"),
        amount_weight.alias("amount_weight"),
        distinct(F.to_date("order_date")).alias("unique_purchase_days"),
        *([F.sum("item_rows").alias("total_items_purchased")] if trust_keys else []),
    )
    if not trust_keys:
        bought = (
            items.select("transaction_id", "item_id")
            .join(sold.select("transaction_id", "customer_id"), "transaction_id")
            .groupBy("customer_id")
            .agg(distinct(F.col("item_id")).alias("total_items_purchased"))
        )
        by_customer = by_customer.join(bought, "customer_id", "left")
    profile = customers.select("customer_id", "email", "first_name", "last_name", "registration_date")
    months = months_between_whole("registration_date", F.lit(as_of))
    return (
        profile.join(by_customer, "customer_id")
        .select(
            *profile.columns,
            days_between("last_order", F.lit(as_of)).alias("recency_days"),
            "frequency",
            "monetary_value",
            ratio("monetary_value", "amount_weight").alias("avg_order_value"),
            F.coalesce("total_items_purchased", F.lit(0)).cast("bigint").alias("total_items_purchased"),
            "unique_purchase_days",
            (F.col("monetary_value") * F.lit(k.LIFETIME_VALUE_FACTOR).cast("decimal(3,2)"))
            .cast("decimal(24,4)")
            .alias("customer_lifetime_value"),
            ratio0("frequency", months).alias("purchase_frequency_rate"),
        )
    )


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Add recency, frequency and monetary scores, 1 to 5."""
    return metrics.withColumns(
        {
            "recency_score": at_most("recency_days", k.RECENCY_STEPS, 1),
            "frequency_score": at_least("frequency", k.FREQUENCY_STEPS, 1),
            "monetary_score": at_least("monetary_value", k.MONETARY_STEPS, 1),
        }
    )


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Add the three-digit score, the segment, the value tier and the engagement level.

    Scores start at 111, so the default segment is never assigned.
    """
    with_score = scores.withColumn(
        "rfm_score", F.col("recency_score") * 100 + F.col("frequency_score") * 10 + F.col("monetary_score")
    )
    engagement = [
        ((F.col("frequency") >= orders) & (F.col("recency_days") <= days), label)
        for orders, days, label in k.ENGAGEMENT_STEPS
    ]
    return with_score.withColumns(
        {
            "rfm_segment": at_least("rfm_score", k.RFM_SEGMENT_STEPS, k.RFM_SEGMENT_DEFAULT),
            "customer_value_tier": at_least("monetary_value", k.VALUE_TIER_STEPS, k.VALUE_TIER_DEFAULT),
            "engagement_level": ladder(engagement, k.ENGAGEMENT_DEFAULT),
        }
    )


def customer_rfm(customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: date, **options) -> DataFrame:
    """Metrics, scores and segments as one logical plan."""
    return rfm_segments(rfm_scores(rfm_metrics(customers, orders, items, as_of, **options)))


def rfm_summary(rfm: DataFrame) -> DataFrame:
    """Averages per segment, value tier and engagement level, best value first. Money is
    averaged and rounded as decimals, so half cents round the same way everywhere."""
    return (
        rfm.groupBy("rfm_segment", "customer_value_tier", "engagement_level")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.avg("monetary_value"), 2).alias("avg_monetary_value"),
            F.round(mean("frequency"), 2).alias("avg_frequency"),
            F.round(mean("recency_days"), 1).alias("avg_recency_days"),
            F.round(F.avg("customer_lifetime_value"), 2).alias("avg_lifetime_value"),
            F.round(F.avg("avg_order_value"), 2).alias("avg_order_value"),
            F.round(F.avg("purchase_frequency_rate"), 2).alias("avg_purchase_frequency"),
        )
        .orderBy(F.desc("avg_monetary_value"), "rfm_segment", "customer_value_tier", "engagement_level")
    )


def rfm_display(summary: DataFrame) -> DataFrame:
    return summary.select(
        "rfm_segment",
        "customer_count",
        F.round("avg_monetary_value", 2).alias("avg_value"),
        F.round("avg_frequency", 2).alias("avg_orders"),
        F.round("avg_recency_days", 1).alias("avg_days_since_purchase"),
    ).orderBy(F.desc("avg_value"))
