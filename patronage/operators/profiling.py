"""Statistics over any table: counts, value counts, describe, histogram, rates, top share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions.constants import FEATURE_CATEGORY_PARTS
from patronage.operators.quantiles import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, NULLs dropped."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def group_size(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def label_mode(df: DataFrame, column: str) -> DataFrame:
    """Most common label (ties: the smallest) and the number of labels. Counted per label
    first, so the final task sees labels, not rows."""
    per_label = group_size(df, column)
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col(column).alias("label")))
    return per_label.agg(best.alias("m"), F.count(F.lit(1)).alias("label_count")).select(
        F.col("m.label").alias("most_common"), "label_count"
    )


def _double(column: str) -> Column:
    return F.col(column).cast("double")


def _moments(column: str) -> list[Column]:
    v = _double(column)
    return [
        F.count(v).cast("double").alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]


def describe_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, count, mean, std, min, q25, q50, q75, max; one pass for all moments."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            *_moments(c),
            *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e")).select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def summary_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, median, std, min, max, sum."""
    median = exact_quantiles(df, [column], [0.5])[column][0]
    return df.agg(*_moments(column), F.sum(column).cast("double").alias("sum")).withColumn(
        "median", F.lit(median).cast("double")
    )


def rate(df: DataFrame, condition: Column, name: str = "rate") -> DataFrame:
    """Share of rows that meet a condition."""
    return df.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias(name))


def threshold_counts(df: DataFrame, column: str, high: float = 0.7, low: float = 0.3) -> DataFrame:
    return df.agg(
        F.count_if(F.col(column) > high).alias("high_count"), F.count_if(F.col(column) < low).alias("low_count")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass: column_name, missing."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "missing")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum (the last bin includes it): bin, bin_start,
    bin_end, count. Empty bins are not listed."""
    v = _double(column)
    low, high = df.agg(F.min(v), F.max(v)).first()
    if low is None:
        low = high = 0.0
    width = (high - low) / bins or 1.0
    index = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    return (
        df.filter(v.isNotNull())
        .groupBy(index.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
            "count",
        )
    )


def top_rows(df: DataFrame, column: str, q: float = 0.8) -> tuple[float | None, DataFrame]:
    """The q-quantile and the rows at or above it."""
    threshold = exact_quantiles(df, [column], [q])[column][0]
    return threshold, df.filter(_double(column) >= F.lit(threshold).cast("double"))


def top_quantile(df: DataFrame, column: str, q: float = 0.8) -> DataFrame:
    """One row about the rows at or above the q-quantile: threshold, count, percent, mean."""
    threshold = exact_quantiles(df, [column], [q])[column][0]
    v, bound = _double(column), F.lit(threshold).cast("double")
    hit = F.count_if(v >= bound)
    return df.agg(
        hit.alias("high_count"),
        (F.try_divide(hit.cast("double"), F.count(F.lit(1)).cast("double")) * 100).alias("high_percent"),
        F.avg(F.when(v >= bound, v)).alias("high_mean"),
    ).select(bound.alias("threshold"), "high_count", "high_percent", "high_mean")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def feature_categories(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(category, column) pairs by column name; a column may be in several categories."""
    return [
        (category, c)
        for category, (parts, names) in FEATURE_CATEGORY_PARTS.items()
        for c in columns
        if c in names or any(part in c.lower() for part in parts)
    ]


def profile(df: DataFrame) -> DataFrame:
    """A table profile as (section, key, value) text rows.

    Sections: shape (rows, columns by kind), types, feature categories, missing values, duplicates, numeric
    summary, and value counts of every text column.
    """
    spark = df.sparkSession
    static = (
        [
            ("shape", "columns", str(len(df.columns))),
            ("shape", "numeric_columns", str(len(numeric_columns(df)))),
            ("shape", "text_columns", str(len(text_columns(df)))),
        ]
        + [("type", f.name, f.dataType.simpleString()) for f in df.schema.fields]
        + [("feature_category", c, category) for category, c in feature_categories(df.columns)]
    )
    parts = [spark.createDataFrame(static, "section string, key string, value string")]
    text = "cast({} as string)"
    parts.append(df.agg(F.count(F.lit(1)).alias("n")).selectExpr("'shape' as section", "'rows' as key", text.format("n") + " as value"))
    parts.append(null_counts(df).selectExpr("'missing' as section", "column_name as key", text.format("missing") + " as value"))
    parts.append(
        duplicate_rows(df).selectExpr("'duplicates' as section", "'rows' as key", text.format("duplicate_rows") + " as value")
    )
    numbers = numeric_columns(df)
    if numbers:
        stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
        long = describe_exact(df, numbers).unpivot(["column_name"], stats, "stat", "v")
        parts.append(
            long.selectExpr("'describe' as section", "column_name || '.' || stat as key", text.format("round(v, 6)") + " as value")
        )
    texts = text_columns(df)
    if texts:
        long = df.select(*texts).unpivot([], texts, "column_name", "v").filter(F.col("v").isNotNull())
        parts.append(
            long.groupBy("column_name", "v")
            .agg(F.count(F.lit(1)).alias("n"))
            .selectExpr("'value_count' as section", "column_name || '=' || v as key", text.format("n") + " as value")
        )
    return reduce(DataFrame.unionByName, parts)
