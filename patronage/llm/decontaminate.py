"""Benchmark decontamination by winnowing.

Documents and benchmark items are fingerprinted by the smallest k-gram hash of every sliding
window of w k-grams. Any shared run of k + w - 1 words shares a fingerprint, so the join of
the fingerprints finds every document with such a run; hits are then extended word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import ascii_lower, keyed, ngram_hashes, same_row, split_words, store

#: Everything that is not a word character, among ASCII; other characters are in words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), GAP)


def winnow(hashes: Column, width: int) -> Column:
    """Distinct smallest hashes of all windows of ``width``; empty if there is no window."""
    if width == 1:
        return F.array_distinct(hashes)
    last = F.size(hashes) - width
    lowest = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.least(*(F.get(hashes, i + j) for j in range(width)))
    )
    return F.when(last >= 0, F.array_distinct(lowest)).otherwise(F.array().cast("array<bigint>"))


def _counted(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*names, words_of(F.col("text")).alias("words")).select(
        *names, "words", F.size("words").alias("count")
    )


def fingerprints(rows: DataFrame, length: int, gram: int, *names: str) -> DataFrame:
    """(names..., print) of rows with ``words`` and ``count``: every run of ``length`` words
    holds one of its row's prints. Runs no longer than a gram are prints themselves."""
    gram = min(gram, length)
    grams = rows.select(*names, ngram_hashes(F.col("words"), F.col("count"), gram).alias("grams"))
    return grams.select(*names, F.explode(winnow(F.col("grams"), length - gram + 1)).alias("print"))


def _windows(length: int | Column) -> Column:
    count = F.col("count")
    return F.when(
        count >= length,
        F.transform(F.sequence(F.lit(0), count - length), lambda i: F.array_join(F.slice("words", i + 1, length), " ")),
    ).otherwise(F.array().cast("array<string>"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit, item_ids (sorted as strings) and
    spans, the runs of words that are windows, as (first, end) word places.

    An item's windows are its runs of ``window`` words, or the whole item if it is shorter. A
    document word inside any occurrence of a window is hit. Items without id or words count
    for nothing; rows without doc_id are judged like any other. Shorter items are looked up
    class by class of their length, of which there are fewer than ``window``. One short job
    stores the items.
    """
    spark = docs.sparkSession
    items, _ = store(
        _counted(benchmark.where("item_id is not null"), "item_id")
        .where("count > 0")
        .withColumn("length", F.least("count", F.lit(window))),
        "benchmark-items",
    )
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())
    rows = keyed(docs)
    key = ("doc_id", "text_key")
    counted = _counted(rows, *key)
    schema = counted.select(*key).schema
    marked = spark.createDataFrame([], schema)
    places = None
    for length in lengths:
        of_length = items.where(F.col("length") == length)
        known = fingerprints(of_length, length, gram, "item_id").select("print").distinct()
        marked = marked.union(
            fingerprints(counted, length, gram, *key).join(known, "print", "left_semi").select(*key)
        )
    marked = marked.distinct()
    suspects = _counted(rows.join(marked, same_row(rows, marked), "left_semi"), *key)
    for length in lengths:
        windows = (
            items.where(F.col("length") == length)
            .select("item_id", F.explode(F.array_distinct(_windows(length))).alias("run"))
            .groupBy("run")
            .agg(F.collect_set("item_id").alias("items"))
        )
        found = suspects.select(*key, F.posexplode(_windows(length)).alias("place", "run")).join(windows, "run")
        found = found.select(*key, "place", (F.col("place") + length).alias("end"), "items")
        places = found if places is None else places.unionByName(found)
    base = counted.select(*key, F.col("count").cast("long").alias("n_words"))
    no_items = F.array().cast("array<string>")
    no_spans = F.array().cast("array<struct<first:int,end:int>>")
    if places is None:
        return base.select("*", F.lit(0).cast("long").alias("n_hit"), no_items.alias("item_ids"), no_spans.alias("spans"))
    per_row = places.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.struct(F.col("place").alias("first"), "end"))).alias("runs"),
        F.collect_set("items").alias("items"),
    )
    hits = per_row.select(
        *key,
        F.col("runs").alias("spans"),
        _covered(F.col("runs")).alias("n_hit"),
        F.array_sort(F.transform(F.array_distinct(F.flatten("items")), lambda i: i.cast("string"))).alias("item_ids"),
    )
    return base.join(hits, same_row(base, hits), "left").select(
        base["doc_id"],
        base["text_key"],
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", no_items).alias("item_ids"),
        F.coalesce("spans", no_spans).alias("spans"),
    )


def _covered(runs: Column) -> Column:
    """Words in the union of (first, end) runs, given in order."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("reach"))
    return F.aggregate(
        runs,
        start,
        lambda a, x: F.struct(
            (a["words"] + F.greatest(x["end"] - F.greatest(x["first"], a["reach"]), F.lit(0))).alias("words"),
            F.greatest(a["reach"], x["end"]).alias("reach"),
        ),
        lambda a: a["words"],
    )
