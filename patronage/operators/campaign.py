"""Campaign KPIs, segments, ranks and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import at_least, days_between, ratio, ratio0
from patronage.operators.ranking import global_row_number
from patronage.session import cut_lineage


def campaign_metrics(campaigns: DataFrame, performance: DataFrame) -> DataFrame:
    """Totals and rates per campaign. A campaign without performance rows keeps NULL totals.

    Performance is summed per campaign before the join, so only one row per campaign and
    task is shuffled however many rows a campaign has.
    """
    totals = performance.groupBy("campaign_id").agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("revenue").cast("decimal(22,2)").alias("total_revenue"),
    )
    base = campaigns.select(
        "campaign_id", "campaign_name", "campaign_type", "channel", "target_audience",
        "start_date", "end_date", "budget", "status",
    )
    daily = {
        f"avg_daily_{name}": ratio0(f"total_{name}", "campaign_duration")
        for name in ("impressions", "clicks", "conversions", "revenue")
    }
    return (
        base.join(totals, "campaign_id", "left")
        .withColumns(
            {
                "overall_ctr": ratio0("total_clicks", "total_impressions"),
                "overall_conversion_rate": ratio0("total_conversions", "total_clicks"),
                "overall_roas": ratio0("total_revenue", "budget"),
                "campaign_duration": days_between("start_date", "end_date"),
            }
        )
        .withColumns(daily)
    )


def campaign_segments(metrics: DataFrame) -> DataFrame:
    """Add performance segment, efficiency score and revenue as percent of budget."""
    return metrics.withColumns(
        {
            "performance_segment": at_least("overall_roas", k.PERFORMANCE_STEPS, "Poor"),
            "efficiency_score": at_least("overall_roas", k.EFFICIENCY_STEPS, 0),
            "budget_utilization_percent": ratio0("total_revenue", "budget") * 100,
        }
    )


def campaign_ranks(campaigns: DataFrame) -> DataFrame:
    """Add revenue, conversion and ROAS ranks over all campaigns, 1 = highest, NULL last,
    ties by campaign id. Each rank sorts only the key and one measure."""
    ranked = cut_lineage(campaigns)
    out = ranked
    for measure, name in (
        ("total_revenue", "revenue_rank"),
        ("total_conversions", "conversion_rank"),
        ("overall_roas", "roas_rank"),
    ):
        place = global_row_number(
            ranked.select("campaign_id", measure), [F.desc_nulls_last(measure), F.asc("campaign_id")], name
        )
        out = out.join(place.select("campaign_id", name), "campaign_id")
    return out


def _summary(cp: DataFrame, key: str) -> DataFrame:
    return cp.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_campaigns"),
        F.sum("budget").alias("total_budget"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("overall_roas").alias("avg_roas"),
        F.avg("overall_ctr").alias("avg_ctr"),
        F.avg("overall_conversion_rate").alias("avg_conversion_rate"),
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_conversions").alias("total_conversions"),
    )


def channel_summary(cp: DataFrame) -> DataFrame:
    """Per channel: mean of the campaigns' ratios, and the ratios of the sums."""
    return (
        _summary(cp, "channel")
        .withColumns(
            {
                "channel_roas": ratio0("total_revenue", "total_budget"),
                "channel_ctr": ratio0("total_clicks", "total_impressions"),
                "channel_conversion_rate": ratio0("total_conversions", "total_clicks"),
            }
        )
        .orderBy(F.desc("channel_roas"), "channel")
    )


def type_summary(cp: DataFrame) -> DataFrame:
    return (
        _summary(cp, "campaign_type")
        .drop("total_impressions", "total_clicks", "total_conversions")
        .withColumn("type_roas", ratio0("total_revenue", "total_budget"))
        .orderBy(F.desc("type_roas"), "campaign_type")
    )


def campaign_display(channels: DataFrame, types: DataFrame) -> DataFrame:
    """Channel and type summaries under one schema."""

    def lines(df: DataFrame, title: str, category: str, roas: str, ctr: str, conversion: str) -> DataFrame:
        return df.select(
            F.lit(title).alias("summary_type"),
            F.col(category).alias("category"),
            "total_campaigns",
            F.round("total_budget", 2).alias("total_budget"),
            F.round("total_revenue", 2).alias("total_revenue"),
            F.round(roas, 2).alias("roas"),
            F.round(F.col(ctr) * 100, 2).alias("ctr_percent"),
            F.round(F.col(conversion) * 100, 2).alias("conversion_percent"),
        )

    return (
        lines(channels, "Channel Performance", "channel", "channel_roas", "channel_ctr", "channel_conversion_rate")
        .unionByName(
            lines(types, "Campaign Type Performance", "campaign_type", "type_roas", "avg_ctr", "avg_conversion_rate")
        )
        .orderBy("summary_type", F.desc("roas"), "category")
    )


def derive_campaign_kpis(performance: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per performance row: rates to four digits, and daily return on a year's budget to
    two digits, capped so that it fits its column."""
    budget = campaigns.select("campaign_id", "budget")
    daily_roas = F.when(
        F.col("budget") > 0, F.round(ratio("revenue", F.col("budget").cast("double") / 365), 2)
    ).otherwise(0.0)
    return (
        performance.join(budget, "campaign_id")
        .withColumns(
            {
                "ctr": F.round(ratio0("clicks", "impressions"), 4),
                "conversion_rate": F.round(ratio0("conversions", "clicks"), 4),
                "roas": F.least(daily_roas, F.lit(k.ROAS_CAP)),
            }
        )
        .drop("budget")
    )
