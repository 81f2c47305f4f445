"""Column expressions used by several operators. All are built-in functions, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ladder(steps: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Ordered CASE: the value of the first condition that holds, else ``default``."""
    out: Column | None = None
    for condition, value in steps:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        return F.lit(default)
    return out.otherwise(default)


def at_least(c: ColumnLike, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """Ladder over ``c >= bound``; a NULL falls to the default."""
    return ladder([(col(c) >= F.lit(bound), value) for bound, value in steps], default)


def at_most(c: ColumnLike, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """Ladder over ``c <= bound``; a NULL falls to the default."""
    return ladder([(col(c) <= F.lit(bound), value) for bound, value in steps], default)


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """Double division that gives NULL for a zero divisor."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio0(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` where the divisor is positive, else 0 (also for a NULL divisor)."""
    return F.when(col(den) > 0, ratio(num, den)).otherwise(F.lit(0.0))


def mean(c: ColumnLike) -> Column:
    """Average as exact sum over count, so integer and decimal inputs give one answer
    whatever the order in which partial sums arrive."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole elapsed days (bigint)."""
    return F.timestamp_diff("DAY", col(start).cast("timestamp_ntz"), col(end).cast("timestamp_ntz"))


def months_between_whole(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole elapsed months (bigint)."""
    return F.timestamp_diff("MONTH", col(start).cast("timestamp_ntz"), col(end).cast("timestamp_ntz"))


def map_values(c: ColumnLike, mapping: Mapping[object, object], default: object = None) -> Column:
    """Literal dictionary lookup. Only for mappings written in code, never for data."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def cut(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; NULL outside and on the lowest edge."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    value = col(c)
    steps = []
    for low, high, label in zip(edges, edges[1:], labels):
        inside = value > F.lit(float(low))
        if high != float("inf"):
            inside = inside & (value <= F.lit(float(high)))
        steps.append((inside & ~F.isnan(value.cast("double")), label))
    return ladder(steps)


def cut_ordinal(label: ColumnLike, labels: Sequence[str]) -> Column:
    """Position of a bin label, so ordered bins sort in their own order."""
    return map_values(label, {name: i for i, name in enumerate(labels)})


def line_total(unit_price: ColumnLike, quantity: ColumnLike) -> Column:
    return F.round(col(unit_price) * col(quantity), 2)


def age_group(date_of_birth: ColumnLike, as_of: date) -> Column:
    """Age in years as whole 365-day units, then five bands."""
    age = F.floor(F.datediff(F.lit(as_of), col(date_of_birth)) / F.lit(365))
    return F.when(
        age.isNotNull(),
        at_least(age, [(55, "55+"), (45, "45-54"), (35, "35-44"), (25, "25-34")], "18-24"),
    )


def zero_to_one(c: ColumnLike) -> Column:
    """Replace 0 by 1, for use as a divisor."""
    return F.when(col(c) == 0, F.lit(1)).otherwise(col(c))


def hash_fraction(key: ColumnLike, seed: int) -> Column:
    """Repeatable pseudo-random number in [0, 1): the first 32 bits of an md5."""
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
