"""File listings as DataFrames: newest file, changed files, recent data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def has_suffix(path: Column, suffixes: Sequence[str]) -> Column:
    lowered = F.lower(path)
    return reduce(lambda a, b: a | b, [lowered.endswith(s.lower()) for s in suffixes])


def file_manifest(spark: SparkSession, prefix: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """path, modificationTime and length of every file below ``prefix``.

    The content column is never selected, so file bodies are not read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(prefix)
        .select("path", "modificationTime", "length")
    )
    return listing.filter(has_suffix(F.col("path"), suffixes)) if suffixes else listing


def latest_by_suffix(manifest: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Newest file per suffix (ties: the greater path). A maximum of a struct combines on
    the map side, so a suffix with most of the files is not sorted in one task."""
    lowered = F.lower(F.col("path"))
    tags = F.array(*[F.when(lowered.endswith(s.lower()), F.lit(s)) for s in suffixes])
    return (
        manifest.withColumn("suffix", F.explode(F.array_compact(tags)))
        .groupBy("suffix")
        .agg(F.max(F.struct("modificationTime", "path", "length")).alias("f"))
        .select("suffix", "f.path", "f.modificationTime", "f.length")
    )


def latest_by_name(manifest: DataFrame, family_length: int = 15) -> DataFrame:
    """Newest file per family when names end in a time label of fixed length
    (``model_20240131_120000.ext``): the greatest name wins."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    family = F.substring(stem, F.lit(1), F.length(stem) - F.lit(family_length + 1))
    return (
        manifest.withColumn("family", family)
        .groupBy("family")
        .agg(F.max(F.struct(name.alias("name"), "path", "modificationTime", "length")).alias("f"))
        .select("family", "f.path", "f.modificationTime", "f.length")
    )


def changed_files(current: DataFrame, cached: DataFrame) -> DataFrame:
    """Files that are new, or whose size or time differs from the cached listing."""
    c, k = current.alias("c"), cached.alias("k")
    same = (
        (F.col("c.path") == F.col("k.path"))
        & F.col("c.length").eqNullSafe(F.col("k.length"))
        & F.col("c.modificationTime").eqNullSafe(F.col("k.modificationTime"))
    )
    return c.join(k, same, "left_anti")


def timeline_info(manifest: DataFrame) -> DataFrame:
    """File, time and size of each Parquet output."""
    return manifest.filter(has_suffix(F.col("path"), [".parquet"])).select(
        F.col("path").alias("file"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def recent(df: DataFrame, ts: str, months: int, as_of: date) -> DataFrame:
    """Rows of the last ``months`` x 30 days; a plain range filter that reaches the scan."""
    return df.filter(F.col(ts) >= F.date_sub(F.lit(as_of), 30 * months))
