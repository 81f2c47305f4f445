"""Assign customers to segments defined by stored JSON criteria."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions.constants import RULE_SEGMENTS

#: Definitions that one projection evaluates; any number of them become several projections.
TOGETHER = 500

# Forms of a criterion: comparison with a number, comparison with an age in days
_NUMBER = re.compile(r"^(>=|<=|>|<)\s*(-?\d+(?:\.\d+)?)$")
_AGE = re.compile(r"^(>|<)\s*(\d+) days ago$")


def default_segments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RULE_SEGMENTS, "segment_id string, segment_name string, segment_description string, criteria string"
    )


def _compare(left: Column, operator: str, right: Column) -> Column:
    return {">": left > right, "<": left < right, ">=": left >= right, "<=": left <= right}[operator]


def criterion(column: str, rule: str, data_type: T.DataType, as_of: date) -> Column:
    """One criterion as a condition.

    ``">1000"`` compares with a number, ``">30 days ago"`` with the date that long before
    ``as_of`` (> means later), anything else is equality in the column's own type.
    """
    value = F.col(column)
    age = _AGE.match(rule)
    if age:
        return _compare(F.to_date(value), age[1], F.date_sub(F.lit(as_of), int(age[2])))
    number = _NUMBER.match(rule)
    if number:
        return _compare(value.cast("double"), number[1], F.lit(float(number[2])))
    return value == F.lit(rule).cast(data_type)


def assign_rule_segments(customers: DataFrame, segments: DataFrame, as_of: date) -> DataFrame:
    """Mapping rows (customer, segment) where every criterion of the segment holds.

    The segment definitions are a settings table, written by hand. They become conditions of
    projections over the customers: no join, no shuffle, no pair of customer and segment
    beyond the matches.
    """
    parsed = segments.select(
        "segment_id", F.from_json("criteria", "map<string,string>").alias("criteria")
    ).orderBy("segment_id")
    definitions = parsed.collect()
    types = {f.name: f.dataType for f in customers.schema.fields}

    matches = []
    for definition in definitions:
        criteria = definition["criteria"] or {}
        unknown = sorted(set(criteria) - set(types))
        if unknown or not criteria:
            raise ValueError(f"{definition['segment_id']}: unknown or no criteria {unknown}")
        holds = reduce(lambda a, b: a & b, [criterion(c, rule, types[c], as_of) for c, rule in criteria.items()])
        matches.append(F.when(holds, F.lit(definition["segment_id"])))

    parts = [
        customers.select("customer_id", F.explode(F.array_compact(F.array(*matches[i : i + TOGETHER]).cast("array<string>"))).alias("segment_id"))
        for i in range(0, max(1, len(matches)), TOGETHER)
    ]
    return (
        reduce(DataFrame.unionAll, parts)
        .withColumns(
            {
                "mapping_id": F.concat_ws("-", "customer_id", "segment_id"),
                "assigned_date": F.lit(as_of),
                "confidence_score": F.lit("1.00").cast("decimal(3,2)"),
            }
        )
        .select("mapping_id", "customer_id", "segment_id", "assigned_date", "confidence_score")
    )
