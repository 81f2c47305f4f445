"""Readers and writers for source, derived and report tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronage.sources.schemas import SCHEMAS

# Snapshot label format
RUN_LABEL = "%Y%m%d_%H%M%S"


def read_table(
    spark: SparkSession,
    name: str,
    location: str,
    fmt: str = "parquet",
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """One source table by name.

    JSON and CSV files are read with the declared schema, so nothing is inferred; Parquet and
    ORC files carry their own. ``fmt="jdbc"`` reads a relational store: ``location`` is its URL, and a
    partition column with bounds splits the read into parallel range queries. Any other
    connector on the class path (a document store, say) is named by ``fmt`` as well.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        reader = reader.option("url", location).option("dbtable", options.get("dbtable", name))
        if partition_column is not None:
            if bounds is None or partitions is None:
                raise ValueError("a partitioned read needs bounds and a number of partitions")
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", str(bounds[0]))
                .option("upperBound", str(bounds[1]))
                .option("numPartitions", str(partitions))
            )
        return reader.load()
    if fmt in ("json", "csv") and name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.load(location)


def read_parquet(spark: SparkSession, path: str | Sequence[str], suffix: str | None = None) -> DataFrame:
    """Parquet files; ``suffix`` narrows a folder tree to matching names."""
    reader = spark.read
    if suffix:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def materialize(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Create a table from a query. ``mode="ignore"`` keeps a table that is there already.

    ``bucket_by`` stores the rows hashed and sorted by a key: later aggregations by that key
    and joins on it with tables of as many buckets read them without a shuffle.
    """
    writer = df.write.mode(mode).format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def run_label(run_ts: datetime) -> str:
    return run_ts.strftime(RUN_LABEL)


def write_snapshot(df: DataFrame, base: str, run_ts: datetime) -> str:
    """Append one run under its own ``run_ts`` partition; earlier runs stay readable and a
    filter on ``run_ts`` reads only the folders it needs. Writing a run again replaces it."""
    (
        df.withColumn("run_ts", F.lit(run_label(run_ts)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .parquet(base)
    )
    return base


def read_latest_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the newest run, found by the names of the run folders; no other run is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    runs = [s.getPath().getName() for s in listed if s.getPath().getName().startswith("run_ts=")]
    if not runs:
        raise FileNotFoundError(f"no run below {base}")
    return spark.read.option("basePath", base).parquet(f"{base}/{max(runs)}")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Long-form report (section, key, value rows) as JSON lines."""
    report.write.mode(mode).json(path)
    return path
