"""Checks for the rules the source stores declare: keys, required fields, domains, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count. NULL keys are exempt,
    as in a unique index."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def required_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column, counted in one pass: column_name, violations."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "violations")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Children whose non-NULL key has no parent row."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def propagate_deletes(child: DataFrame, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Children after their missing parents were deleted: ``cascade`` drops the rows,
    ``set_null`` keeps them with an empty key."""
    if rule == "cascade":
        kept = child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_semi")
        return kept.unionByName(child.filter(F.col(key).isNull()))
    if rule == "set_null":
        # rows that have no key already need no partner, so they are kept out of the join
        known = parent.select(F.col(key).alias("_parent")).distinct()
        linked = child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left")
        checked = linked.select(*[F.col("_parent").alias(key) if c == key else F.col(c) for c in child.columns])
        return checked.unionByName(child.filter(F.col(key).isNull()))
    raise ValueError(f"unknown rule {rule!r}")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows with a value outside the allowed list; NULL is not a value."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def touch(df: DataFrame, as_of: datetime | date, changed_from: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Set ``updated_at``. With the previous version given, only rows that differ from it
    are touched; rows not in it are new and touched too."""
    stamp = F.lit(as_of).cast("timestamp_ntz")
    if changed_from is None:
        return df.withColumn("updated_at", stamp)
    compared = [c for c in df.columns if c not in (key, "updated_at")]
    before = changed_from.select(
        F.col(key).alias("_key"), F.struct(*compared).alias("_before"), F.col("updated_at").alias("_was")
    )
    joined = df.drop("updated_at").join(before, F.col(key) == F.col("_key"), "left")
    unchanged = F.col("_key").isNotNull() & F.struct(*compared).eqNullSafe(F.col("_before"))
    return joined.withColumn("updated_at", F.when(unchanged, F.col("_was")).otherwise(stamp)).drop(
        "_key", "_before", "_was"
    )


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill declared column defaults where the value is absent."""
    known = {c: v for c, v in defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()})
