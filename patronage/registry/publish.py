"""One form of values for comparing results of two engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 1_000_000.0


def publish(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, other numbers as doubles of six digits, dates as text,
    arrays as comma-separated text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FractionalType)):
            # scaled first, so that both engines round the same binary number
            c = F.round(c.cast("double") * SCALE, 0) / SCALE + F.lit(0.0)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)
