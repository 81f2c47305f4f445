"""Columns and storage helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import prepare_checkpoint_dir

SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, gap: str = SPACES) -> Column:
    """Words between runs of ``gap``; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def ngram_hashes(words: Column, count: Column, n: int) -> Column:
    """64-bit hashes of all runs of ``n`` words, in place order; empty if there is none."""
    return F.when(
        count >= n,
        F.transform(F.sequence(F.lit(0), count - n), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(n)))),
    ).otherwise(F.array().cast("array<bigint>"))


def keyed(docs: DataFrame, rest: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and ``text_key``, a hash of the text.

    Only these columns are read, so other columns can have any name; with ``rest`` they come
    along in a struct of that name. The pair (doc_id, text_key) names a row's result: identical
    rows share one, and rows that repeat an id with another text do not mix.
    """
    other = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")]
    more = [F.struct(*other).alias("rest")] if rest else []
    return docs.select("doc_id", "text", F.xxhash64(F.lit(17), "text").alias("text_key"), *more)


def with_rest(rows: DataFrame, columns: Sequence[str], text: Column | None = None) -> DataFrame:
    """``columns`` as they were before ``keyed``; a new text goes with its own ``n_chars``."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if text is not None:
        own |= {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*((own[c] if c in own else F.col("rest").getField(c)).alias(c) for c in columns))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the checkpoint folder, which driver and executors share."""
    prepare_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    jvm = spark._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting to delete the shuffle files of a query when it has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written in the block are deleted when they are written, and not
    when the driver happens to collect garbage."""
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write the rows below the checkpoint folder and read them back; also the folder. What was
    shuffled for them is deleted then."""
    folder = shared_folder(df.sparkSession, label)
    # a plan takes the setting when it is made: this one is made here
    with shuffles_released(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder
