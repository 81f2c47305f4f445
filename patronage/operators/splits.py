"""Repeatable splits: by hash, exact by hash order, stratified, and by date."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.expr import hash_fraction
from patronage.operators.ranking import rank_within


def random_split(df: DataFrame, fraction: float, seed: int = 42, key: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """(first, rest): a row goes by the hash of its key, so the split needs no shuffle,
    is the same on every run, and keeps rows of one key together. Sizes are approximate."""
    chosen = F.coalesce(hash_fraction(key, seed) < fraction, F.lit(False))
    return df.filter(chosen), df.filter(~chosen)


def train_test(
    df: DataFrame, test_fraction: float = 0.2, seed: int = 42, key: str = "customer_id", stratify: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test). With ``stratify`` every label gives the same share, to the row."""
    if stratify is None:
        test, train = random_split(df, test_fraction, seed, key)
        return train, test
    marked = exact_split_flag(df, 1.0 - test_fraction, seed, key, stratify)
    return marked.filter("in_first").drop("in_first"), marked.filter("not in_first").drop("in_first")


def exact_split_flag(
    df: DataFrame, fraction: float, seed: int = 42, key: str = "customer_id", strata: str | None = None
) -> DataFrame:
    """Add ``in_first``: true for the first round(fraction x rows) rows of each stratum in
    hash order (ties by key).

    Ordering a stratum would put it in one task. Instead rows are counted per stratum and
    hash bucket; a bucket lies wholly before or after the cut, save one bucket per
    stratum, and only that one is ordered. There are as many buckets as the square root of
    the rows, so neither the buckets of a stratum nor the rows of a bucket fill a task. One
    job counts the rows.
    """
    buckets = math.isqrt(df.count()) + 1
    stratum = F.col(strata) if strata else F.lit(0)
    base = df.withColumns({"_stratum": stratum, "_hash": hash_fraction(key, seed)}).withColumn(
        "_bucket", F.floor(F.col("_hash") * buckets).cast("bigint")
    )
    per_bucket = base.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy("_stratum").orderBy("_bucket")
    whole = Window.partitionBy("_stratum")
    running = per_bucket.select(
        "_stratum",
        "_bucket",
        (F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        "_n",
        F.round(F.sum("_n").over(whole) * F.lit(fraction)).cast("bigint").alias("_wanted"),
    )
    edge = running.filter(
        (F.col("_before") < F.col("_wanted")) & (F.col("_before") + F.col("_n") >= F.col("_wanted"))
    ).select(
        F.col("_stratum").alias("_s"),
        F.col("_bucket").alias("_edge"),
        (F.col("_wanted") - F.col("_before")).alias("_left"),
    )
    joined = base.join(edge, F.col("_stratum").eqNullSafe(F.col("_s")), "left")
    on_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    decided = joined.filter(~on_edge).withColumn(
        "in_first", F.coalesce(F.col("_bucket") < F.col("_edge"), F.lit(False))
    )
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy("_hash", key))
    ordered = joined.filter(on_edge).withColumn("in_first", place <= F.col("_left"))
    return decided.unionByName(ordered).select(*df.columns, "in_first")


def stratified_folds(
    df: DataFrame, strata: str, folds: int = 5, seed: int = 42, key: str = "customer_id", name: str = "fold"
) -> DataFrame:
    """Add ``name``: the rows of each stratum are dealt to the folds in turn, in hash order of their
    keys, so the folds' shares of a stratum differ by one row at most, however rare it is. The order
    is one distributed sort; no stratum meets in one task."""
    hashed = df.withColumn("_hash", hash_fraction(key, seed))
    placed = rank_within(hashed, [strata], [F.asc("_hash"), F.asc(key)], "_place")
    return placed.withColumn(name, ((F.col("_place") - 1) % folds).cast("int")).drop("_hash", "_place")


def timeline_split(
    df: DataFrame,
    as_of: date,
    months: int = 3,
    date_columns: tuple[str, ...] = ("registration_date", "dataset_created_at"),
    key: str = "customer_id",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(train, infer) at ``as_of`` - 30 x ``months`` days, in a column of its own,
    ``split_ts``. A row without a date is in neither part. The first date column that
    holds any value is used; with none, rows are split 70/30 by hash."""
    present = [c for c in date_columns if c in df.columns]
    used = next((c for c in present if not df.filter(F.col(c).isNotNull()).isEmpty()), None)
    if used is None:
        return random_split(df, 0.7, seed, key)
    cutoff = F.date_sub(F.lit(as_of), 30 * months)
    dated = df.withColumn("split_ts", F.to_date(used))
    before: Column = F.col("split_ts") < cutoff
    return dated.filter(before), dated.filter(F.col("split_ts") >= cutoff)
