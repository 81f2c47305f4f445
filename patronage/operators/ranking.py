"""Ranks and ordered positions that do not funnel a table through one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.session import cut_lineage


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` over a whole table, as a distributed sort.

    ``row_number`` without PARTITION BY moves every row to one task. Here the rows are
    range-partitioned and sorted, each remembers its place in its own partition, and the
    number of rows in earlier partitions is added. The sorted rows are checkpointed
    first: the sizes and the places must come from the same sort. ``order_by`` must end in a
    unique key, which also lets a run of equal values be split over partitions.
    Only the partition sizes, one number per partition, reach the driver.
    """
    placed = cut_lineage(df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()))
    # monotonically_increasing_id: partition number in the high bits, row number in the low 33
    part = F.shiftright("_place", 33)
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for size in sizes:
        starts.append((size["part"], total))
        total += size["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    return (
        placed.join(F.broadcast(offsets), part == F.col("_part"), "left")
        .withColumn(name, F.col("_start") + row + F.lit(1))
        .drop("_place", "_part", "_start")
    )


def rank_within(df: DataFrame, partition: Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` per group, whatever the size of the groups: the position in one
    distributed sort by group and order, counted from the first position of the group."""
    placed = global_row_number(df, [*[F.asc(c) for c in partition], *order_by], "_position")
    keys = [f"_{c}" for c in partition]
    first = placed.groupBy(*[F.col(c).alias(k) for c, k in zip(partition, keys)]).agg(F.min("_position").alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(partition, keys)])
    return (
        placed.join(first, same)
        .withColumn(name, F.col("_position") - F.col("_first") + 1)
        .drop("_position", "_first", *keys)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all other columns.

    A minimum over a struct keeps one candidate per key and task before the shuffle, so
    a key with a large share of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order_by, *rest)).alias("_first"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])


def rank_curve(scores: DataFrame, column: str, key: str) -> DataFrame:
    """Predictions against their rank, highest first."""
    return global_row_number(scores.select(key, column), [F.desc(column), F.asc(key)], "customer_rank")
