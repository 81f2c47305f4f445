"""Row rules of the eight cleaned tables, the cleaned tables, and the rejected rows.

Each table has one ordered list of (rule name, condition). A row is clean when all
conditions hold; it is rejected, with the names of the failed rules, otherwise. A NULL
condition counts as failed, as it does in a WHERE clause.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.constants import SUCCESSFUL_STATUSES

Rules = Sequence[tuple[str, Column]]


def _present(*names: str) -> list[tuple[str, Column]]:
    return [(f"{name}_missing", F.col(name).isNotNull()) for name in names]


def _not_negative(*names: str) -> list[tuple[str, Column]]:
    return [(f"{name}_negative", F.col(name) >= 0) for name in names]


def _positive(*names: str) -> list[tuple[str, Column]]:
    return [(f"{name}_not_positive", F.col(name) > 0) for name in names]


def customer_rules(as_of: date) -> Rules:
    return [
        *_present("customer_id", "email"),
        ("email_malformed", F.col("email").contains("@")),
        *_present("registration_date"),
        ("registered_in_future", F.col("registration_date") <= F.lit(as_of)),
    ]


def demographics_rules() -> Rules:
    return _present("customer_id", "age_group")


def transaction_rules(as_of: date) -> Rules:
    return [
        *_present("transaction_id", "customer_id", "order_date"),
        *_positive("total_amount"),
        ("ordered_in_future", F.col("order_date") <= F.lit(as_of)),
    ]


def item_rules() -> Rules:
    return [*_present("item_id", "transaction_id"), *_positive("quantity", "unit_price", "total_price")]


def campaign_rules() -> Rules:
    return [
        *_present("campaign_id", "campaign_name", "start_date", "end_date"),
        ("ends_before_start", F.col("start_date") <= F.col("end_date")),
        *_positive("budget"),
    ]


def performance_rules() -> Rules:
    return [
        *_present("performance_id", "campaign_id", "date"),
        *_not_negative("impressions", "clicks", "conversions", "revenue"),
    ]


def ab_test_rules() -> Rules:
    return [
        *_present("test_id", "test_name", "start_date", "end_date"),
        ("ends_before_start", F.col("start_date") <= F.col("end_date")),
        *_positive("sample_size"),
    ]


def ab_result_rules() -> Rules:
    return [
        *_present("result_id", "test_id"),
        ("variant_unknown", F.col("variant").isin("A", "B")),
        *_not_negative("impressions", "clicks", "conversions", "revenue"),
    ]


def passing(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [condition for _, condition in rules]))


def rejects(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that fail at least one rule, with the failed names in rule order."""
    failed = F.array(
        *[F.when(~F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in rules]
    )
    return df.withColumn("failed_rules", F.array_compact(failed)).filter(F.size("failed_rules") > 0)


def keep_with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Children whose parent row is kept. The parent key is unique, so a semi join gives
    the rows of the inner join and can neither multiply rows nor carry parent columns."""
    return child.join(parent.select(key), key, "left_semi")


def clean_customers(df: DataFrame, as_of: date) -> DataFrame:
    return passing(df, customer_rules(as_of))


def clean_demographics(df: DataFrame, customers_clean: DataFrame) -> DataFrame:
    return keep_with_parent(passing(df, demographics_rules()), customers_clean, "customer_id")


def clean_transactions(df: DataFrame, customers_clean: DataFrame, as_of: date) -> DataFrame:
    return keep_with_parent(passing(df, transaction_rules(as_of)), customers_clean, "customer_id")


def clean_items(df: DataFrame, transactions_clean: DataFrame) -> DataFrame:
    return keep_with_parent(passing(df, item_rules()), transactions_clean, "transaction_id")


def clean_campaigns(df: DataFrame) -> DataFrame:
    return passing(df, campaign_rules())


def clean_campaign_performance(df: DataFrame, campaigns_clean: DataFrame) -> DataFrame:
    return keep_with_parent(passing(df, performance_rules()), campaigns_clean, "campaign_id")


def clean_ab_tests(df: DataFrame, campaigns_clean: DataFrame) -> DataFrame:
    return keep_with_parent(passing(df, ab_test_rules()), campaigns_clean, "campaign_id")


def clean_ab_results(df: DataFrame, ab_tests_clean: DataFrame) -> DataFrame:
    return keep_with_parent(passing(df, ab_result_rules()), ab_tests_clean, "test_id")


def successful_orders(df: DataFrame, statuses: Sequence[str] = SUCCESSFUL_STATUSES) -> DataFrame:
    return df.filter(F.col("order_status").isin(*statuses))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each table; one count job per table, one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_summary(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Clean and original row counts per table, from {name: (clean, original)}."""
    parts = []
    for name, (clean, original) in pairs.items():
        total = original.agg(F.count(F.lit(1))).scalar()
        parts.append(
            clean.agg(F.count(F.lit(1)).alias("clean_count")).select(
                F.lit(name).alias("table_name"), "clean_count", total.alias("original_count")
            )
        )
    return reduce(DataFrame.unionByName, parts)
