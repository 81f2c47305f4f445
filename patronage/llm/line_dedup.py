"""Line dedup over levelled sorted runs of line hashes.

A run is a Parquet folder of (line_hash, n_docs, last_doc), range-partitioned and sorted by
hash. Every batch of documents adds a run to level 0; when a level holds ``fanout`` runs they
are merged into one run of the next level, so N batches leave O(log N) runs and each hash is
rewritten O(log N) times. A batch is cleaned by a merge anti-join with the runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import ascii_lower, keyed, remove_folders, same_row, shared_folder

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
#: A line hash is met by its documents in so many places, as one line can be in most of them.
SALTS = 32
EDGES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(EDGES)))


def line_hash(line: Column) -> Column:
    """128 bits, so that equal hashes mean equal keys at any number of lines."""
    return F.unhex(F.md5(line_key(line)))


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_key, place, line_hash) of every long line; places count from 0."""
    lines = docs.where("doc_id is not null").select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    keyed_lines = lines.select("doc_id", "text_key", "place", line_key(F.col("line")).alias("key"))
    long = keyed_lines.where(F.char_length("key") >= min_chars)
    return long.select("doc_id", "text_key", "place", F.unhex(F.md5("key")).alias("line_hash"))


class LineRuns:
    """Runs by level, in folders below the checkpoint folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level is merged from two runs at least")
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        folder = shared_folder(self.spark, f"line-run-{level}")
        rows.repartitionByRange("line_hash").sortWithinPartitions("line_hash").write.parquet(folder)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(folder)

    def _read(self, folders: list[str]) -> DataFrame:
        schema = "line_hash binary, n_docs long, last_doc long"
        return self.spark.read.schema(schema).parquet(*folders)

    def add(self, lines: DataFrame) -> None:
        """Add a batch's run: (doc_id, line_hash) rows of documents that no other batch holds."""
        self._write(
            lines.groupBy("line_hash").agg(
                F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").cast("long").alias("last_doc")
            ),
            0,
        )
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self._merged(merged), level + 1)
            remove_folders(self.spark, merged)
            level += 1

    def _merged(self, folders: list[str]) -> DataFrame:
        return (
            self._read(folders)
            .groupBy("line_hash")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        )

    def folders(self) -> list[str]:
        return [folder for level in self.levels for folder in level]

    def totals(self) -> DataFrame:
        """(line_hash, n_docs, last_doc) over all runs."""
        return self._merged(self.folders())

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Rows of a new batch whose hash no run holds."""
        return lines.join(self._read(self.folders()), "line_hash", "left_anti")

    def drop(self) -> None:
        remove_folders(self.spark, self.folders())
        self.levels = []


def repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """(doc_id, text_key, taken): places of the lines that a row loses, in order; see ``dedup_lines``."""
    spark = docs.sparkSession
    lines = long_lines(keyed(docs), min_chars)
    staged = shared_folder(spark, "line-batches")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(staged)
    schema = "doc_id long, text_key long, place int, line_hash binary, batch int"
    stored = spark.read.schema(schema).parquet(staged)
    runs = LineRuns(spark, fanout)
    for number in range(batches):
        runs.add(stored.where(F.col("batch") == number))
    repeated = runs.totals().where(F.col("n_docs") >= min_docs)
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # the merge anti-join, told from its other side: lines that a run takes away
    taken = (
        stored.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(salted, ["line_hash", "salt"])
        .where("doc_id < last_doc")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("place")).alias("taken"))
        .checkpoint()
    )
    runs.drop()
    remove_folders(spark, [staged])
    return taken


def cleaned(docs: DataFrame, taken: DataFrame, rest: bool = False) -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped, the kept ``text``, and ``rest`` if asked for."""
    rows = keyed(docs, rest)
    more = [rows["rest"]] if rest else []
    names = ["rest"] if rest else []
    rows = rows.join(taken, same_row(rows, taken), "left").select(
        rows["doc_id"], rows["text_key"], F.split(F.coalesce(rows["text"], F.lit("")), "\n").alias("lines"), "taken", *more
    )
    # what lies between the places that go, each line copied once
    ends = F.concat(F.array(F.lit(-1)), "taken", F.array(F.size("lines")))
    between = F.transform(
        F.sequence(F.lit(0), F.size("taken")),
        lambda i: F.slice("lines", F.get("ends", i) + 2, F.get("ends", i + 1) - F.get("ends", i) - 1),
    )
    kept = F.when(F.col("taken").isNull(), F.col("lines")).otherwise(F.flatten(between))
    rows = rows.select("*", F.when(F.col("taken").isNotNull(), ends).alias("ends"))
    return rows.select("doc_id", "text_key", "lines", kept.alias("kept"), *names).select(
        "doc_id",
        "text_key",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
        *names,
    )


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    rest: bool = False,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_lines``, ``n_dropped`` and the kept ``text`` per row.

    Line keys of at least ``min_chars`` code points in at least ``min_docs`` documents keep
    their lines in the largest doc_id only. Null and empty texts are one empty line. Rows that
    share a doc_id count as one document, and each is cleaned; rows without doc_id are not
    counted and stay whole. Jobs run while the runs are written. With ``rest``, the other
    columns of ``docs`` come along in a struct. A task holds one text and its lines at a time;
    lines are taken out by place, so a text costs what its length says, however many go.
    """
    return cleaned(docs, repeated_lines(docs, min_chars, min_docs, batches, fanout), rest)
