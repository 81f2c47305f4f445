"""A/B tests: variant totals, rates, lift, evidence, winner, recommendation, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import days_between, ladder, mean, ratio, ratio0

METRICS = ("impressions", "clicks", "conversions", "revenue")


def ab_variant_totals(tests: DataFrame, results: DataFrame) -> DataFrame:
    """Sums of four metrics for A, for B and in all, per test. Results are summed per test
    before the join. A test without results has variant sums of 0 and NULL totals."""
    sums = [
        F.sum(F.when(F.col("variant") == variant.upper(), F.col(m)).otherwise(0)).alias(f"variant_{variant}_{m}")
        for variant in ("a", "b")
        for m in METRICS
    ]
    per_test = results.groupBy("test_id").agg(*sums, *[F.sum(m).alias(f"total_{m}") for m in METRICS])
    base = tests.select(
        "test_id", "test_name", "campaign_id", "variant_a_description", "variant_b_description",
        "start_date", "end_date", "sample_size", "test_status",
    )
    joined = base.join(per_test, "test_id", "left")
    return joined.withColumns(
        {
            f"variant_{v}_{m}": F.coalesce(F.col(f"variant_{v}_{m}"), F.lit(0))
            for v in ("a", "b")
            for m in METRICS
        }
    )


def ab_rates(totals: DataFrame) -> DataFrame:
    """Click rate, conversion rate and revenue per impression of both variants."""
    rates = {}
    for v in ("a", "b"):
        p = f"variant_{v}_"
        rates[p + "ctr"] = ratio0(p + "clicks", p + "impressions")
        rates[p + "conversion_rate"] = ratio0(p + "conversions", p + "clicks")
        rates[p + "revenue_per_impression"] = ratio0(p + "revenue", p + "impressions")
    return totals.withColumns({**rates, "test_duration_days": days_between("start_date", "end_date")})


def _lift(rate: str) -> Column:
    a, b = F.col(f"variant_a_{rate}"), F.col(f"variant_b_{rate}")
    return ratio0(b - a, a) * 100


def ab_lift(rates: DataFrame) -> DataFrame:
    """Percent change of B over A for three rates; 0 where A has none."""
    return rates.withColumns(
        {
            "ctr_lift_percentage": _lift("ctr"),
            "conversion_lift_percentage": _lift("conversion_rate"),
            "revenue_lift_percentage": _lift("revenue_per_impression"),
        }
    )


def _evidence(steps: list[tuple[int, object]], default: object) -> Column:
    smaller = F.least("variant_a_impressions", "variant_b_impressions")
    return ladder([(smaller >= bound, value) for bound, value in steps], default)


def ab_significance(tests: DataFrame) -> DataFrame:
    """Evidence labels by the impressions of the smaller variant. These are thresholds,
    not a statistical test."""
    return tests.withColumns(
        {
            "statistical_significance": _evidence(k.SIGNIFICANCE_STEPS, "No"),
            "confidence_level": _evidence(k.CONFIDENCE_STEPS, "Low"),
            "p_value": _evidence(k.P_VALUE_STEPS, 0.50),
        }
    )


def _better(first: str, second: str) -> Column:
    """``first`` beats ``second`` on both rates."""
    return (F.col(f"variant_{first}_ctr") > F.col(f"variant_{second}_ctr")) & (
        F.col(f"variant_{first}_conversion_rate") > F.col(f"variant_{second}_conversion_rate")
    )


def _earns_more(first: str, second: str) -> Column:
    return F.col(f"variant_{first}_revenue_per_impression") > F.col(f"variant_{second}_revenue_per_impression")


def ab_winner(tests: DataFrame) -> DataFrame:
    """Both rates decide; if they disagree, revenue per impression does; else a tie."""
    steps = [
        (_better("b", "a"), "B"),
        (_better("a", "b"), "A"),
        (_earns_more("b", "a"), "B"),
        (_earns_more("a", "b"), "A"),
    ]
    return tests.withColumn("winner", ladder(steps, "Tie"))


def ab_sample_size(tests: DataFrame) -> DataFrame:
    shown = F.col("variant_a_impressions") + F.col("variant_b_impressions")
    return tests.withColumn("sample_size_required", F.greatest(F.lit(k.MIN_SAMPLE_SIZE).cast("bigint"), shown))


def ab_recommend(tests: DataFrame) -> DataFrame:
    significant = F.col("statistical_significance") == "Yes"
    steps = [
        (significant & (F.col("winner") == "B"), "Implement Variant B"),
        (significant & (F.col("winner") == "A"), "Implement Variant A"),
        (F.col("statistical_significance") == "No", "Continue Testing"),
    ]
    return tests.withColumn("recommendation", ladder(steps, "Inconclusive - Continue A"))


def ab_results(tests: DataFrame, results: DataFrame) -> DataFrame:
    """The whole analysis as one plan: one join, then projections."""
    out = ab_variant_totals(tests, results)
    for step in (ab_rates, ab_lift, ab_significance, ab_winner, ab_sample_size, ab_recommend):
        out = step(out)
    return out


def ab_summary(ab: DataFrame) -> DataFrame:
    keys = ["test_status", "statistical_significance", "winner", "confidence_level"]
    rows = F.count(F.lit(1))

    def share(condition: Column) -> Column:
        return ratio(F.count_if(condition), rows)

    return (
        ab.groupBy(*keys)
        .agg(
            rows.alias("test_count"),
            F.round(F.avg("ctr_lift_percentage"), 2).alias("avg_ctr_lift"),
            F.round(F.avg("conversion_lift_percentage"), 2).alias("avg_conversion_lift"),
            F.round(F.avg("revenue_lift_percentage"), 2).alias("avg_revenue_lift"),
            F.round(mean("test_duration_days"), 1).alias("avg_test_duration"),
            F.round(mean("sample_size_required"), 0).alias("avg_sample_size_required"),
            share(F.col("statistical_significance") == "Yes").alias("significant_test_rate"),
            share(F.col("winner") != "Tie").alias("clear_winner_rate"),
            share(F.col("recommendation").startswith("Implement")).alias("actionable_test_rate"),
            share(F.col("recommendation") == "Implement Variant B").alias("variant_b_win_rate"),
        )
        .orderBy(F.desc("test_count"), *keys)
    )


def ab_display(summary: DataFrame) -> DataFrame:
    return summary.select(
        "test_status",
        "statistical_significance",
        "winner",
        "test_count",
        F.round("avg_ctr_lift", 1).alias("avg_ctr_lift_percent"),
        F.round("avg_conversion_lift", 1).alias("avg_conversion_lift_percent"),
        F.round(F.col("significant_test_rate") * 100, 1).alias("significant_test_rate_percent"),
        F.round(F.col("clear_winner_rate") * 100, 1).alias("clear_winner_rate_percent"),
    ).orderBy(F.desc("test_count"))
