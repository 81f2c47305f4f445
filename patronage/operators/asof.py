"""Point-in-time lookups: what was known of a key on a day, never from later rows.

A key's history is cut into buckets of ``width`` days. Inside a bucket a window runs over at most
one fact and a few questions per day; the state that earlier buckets leave behind comes from one
row per key and bucket. So no task holds more than a bucket of one key, however many rows it owns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 64


def as_of_state(
    facts: DataFrame, questions: DataFrame, key: str, day: str, values: Sequence[str], width: int = WIDTH
) -> DataFrame:
    """Every question with ``last_<value>`` (of the latest fact on or before its day, NULL without
    one) and ``total_<value>`` (sum of all facts on or before its day, 0 without one).

    ``facts`` holds at most one row per key and day. Rows of either side without a key or a day
    answer nothing: such facts are left out, such questions find nothing. Repeated questions stay.
    """
    rest = [c for c in questions.columns if c not in (key, day)]
    bucket = F.floor(F.unix_date(F.col(day)) / F.lit(width)).alias("_bucket")
    known = facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(
        key, F.col(day).alias("_day"), bucket, F.struct(*values).alias("_fact"), F.lit(None).alias("_asked")
    )
    asked = questions.select(
        key, F.col(day).alias("_day"), bucket, F.lit(None).alias("_fact"), F.struct(F.lit(1).alias("_one"), *rest).alias("_asked")
    )
    both = known.unionByName(asked)
    until = Window.partitionBy(key, "_bucket").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        both.withColumns(
            {
                "_last": F.last("_fact", ignorenulls=True).over(until),
                **{f"_sum_{v}": F.sum(f"_fact.{v}").over(until) for v in values},
            }
        )
        .filter(F.col("_asked").isNotNull())
        .drop("_fact")
    )
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max(F.when(F.col("_fact").isNotNull(), F.struct("_day", "_fact")))
    left_behind = (
        both.groupBy(key, "_bucket")
        .agg(newest.alias("_newest"), *[F.sum(f"_fact.{v}").alias(f"_whole_{v}") for v in values])
        .select(
            key,
            "_bucket",
            F.last("_newest", ignorenulls=True).over(before)["_fact"].alias("_earlier"),
            *[F.sum(f"_whole_{v}").over(before).alias(f"_before_{v}") for v in values],
        )
    )
    state = F.coalesce("_last", "_earlier")
    return inside.join(left_behind, [key, "_bucket"], "left").select(
        key,
        F.col("_day").alias(day),
        *[F.col(f"_asked.{c}").alias(c) for c in rest],
        *[state[v].alias(f"last_{v}") for v in values],
        *[
            (F.coalesce(f"_before_{v}", F.lit(0)) + F.coalesce(f"_sum_{v}", F.lit(0))).alias(f"total_{v}")
            for v in values
        ],
    )


def as_of_features(
    facts: DataFrame,
    labels: DataFrame,
    key: str,
    day: str,
    label_day: str,
    values: Sequence[str],
    lags: Sequence[int],
    spans: Sequence[int],
    width: int = WIDTH,
) -> DataFrame:
    """Per distinct key and label day: ``<value>_lag_<n>``, the value of the latest fact at least
    ``n`` days before the label, and ``<value>_sum_<n>``, the sum over the ``n`` days before it.
    Neither sees the label day itself."""
    back = sorted({1, *lags, *[n + 1 for n in spans]})
    questions = (
        labels.filter(F.col(key).isNotNull() & F.col(label_day).isNotNull())
        .select(key, label_day)
        .distinct()
        .select(key, label_day, F.explode(F.array(*[F.lit(n) for n in back])).alias("_back"))
        .withColumn(day, F.date_sub(label_day, F.col("_back")))
    )
    known = as_of_state(facts, questions, key, day, values, width)

    def at(n: int, column: str):
        return F.max(F.when(F.col("_back") == n, F.col(column)))

    return known.groupBy(key, label_day).agg(
        *[at(n, f"last_{v}").alias(f"{v}_lag_{n}") for v in values for n in lags],
        *[(at(1, f"total_{v}") - at(n + 1, f"total_{v}")).alias(f"{v}_sum_{n}") for v in values for n in spans],
    )
