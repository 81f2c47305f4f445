"""Substring dedup: words in a long window that an earlier document has too are removed.

The whole corpus is its own reference, so the reference is first cut down to what repeats.

1. Every window of ``window`` words picks an anchor, its smallest k-gram hash. Neighbouring
   windows with the same anchor form a segment. Equal windows pick equal anchors, so only
   segments whose anchor is in two documents or more can hold a repeat.
2. A segment that an earlier document has word for word is repeated as a whole. Of each such
   group the first one stands for all from here on.
3. Segments that differ but share an anchor are compared by window hash. A repeated window has
   one owner, the first segment with it. Owners are the reference: however many documents
   share a passage, it is there once.
4. Reference shards of bounded size become suffix automata. Each is sent to the tasks that hold
   segments with a window of its owners; they stream through it for matching statistics, and
   windows that an earlier document of the shard has are marked, word for word.
5. Documents meet their marked spans and lose those words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import keyed, same_row, store
from patronage.llm.suffix_automaton import SuffixAutomaton

WINDOW = 50
GRAM = 20
#: Segments in a reference shard, and segments that a task streams through it. A segment has
#: fewer than twice WINDOW words.
SHARD = 500
STREAM = 2_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CACHED = 500_000


class WordHashes(dict):
    """64-bit hashes of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], "uint64")


def _powers(base: np.uint64, count: int) -> np.ndarray:
    row = np.full(count, base)
    row[:1] = 1
    return np.multiply.accumulate(row)


class Runs:
    """Hashes of any run of a word sequence, from sums of its prefixes."""

    def __init__(self, hashes: np.ndarray):
        self.sums = np.concatenate((np.zeros(1, "uint64"), np.cumsum(hashes * _powers(_BASE, len(hashes)))))
        self.shift = _powers(_INVERSE, len(hashes) + 1)

    def hash(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[first]) * self.shift[first] + (end - first).astype("uint64")
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (value ^ (value >> np.uint64(32))).view("int64")


def segments(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchor, content hash, first window and number of windows of each segment."""
    n_windows = len(hashes) - window + 1
    if n_windows < 1:
        return (np.zeros(0, "int64"),) * 4
    runs, width = Runs(hashes), window - gram + 1
    starts = np.arange(len(hashes) - gram + 1)
    grams = runs.hash(starts, starts + gram)
    best = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(n_windows)
    first = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
    count = np.diff(np.append(first, n_windows))
    return grams[best[first]], runs.hash(first, first + count + window - 1), first, count


def _arrow(kinds: dict[str, pa.DataType], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


def _segment_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    kinds = {c: pa.int64() for c in ("anchor", "content", "doc_id", "text_key")} | {"first": pa.int32(), "count": pa.int32()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[np.zeros(0, "int64")] for _ in kinds]
            for doc, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = segments(hashes.of((text or "").encode().split()), window, gram)
                owner = [np.full(len(found[0]), doc), np.full(len(found[0]), key)]
                for part, column in zip(parts, [*found[:2], *owner, *found[2:]], strict=True):
                    part.append(column)
            yield _arrow(kinds, [np.concatenate(p) for p in parts])

    return docs.where("doc_id is not null").mapInArrow(
        cut, "anchor long, content long, doc_id long, text_key long, first int, count int"
    )


def _texts_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted`` (anchor, content, doc_id, text_key, first, count) as (id, doc_id, words)."""
    listed = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "content", "first", "count")).alias("parts"))
    rows = docs.join(listed, ["doc_id", "text_key"]).select("doc_id", "text", "parts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"anchor": pa.int64(), "content": pa.int64(), "doc_id": pa.int64(), "words": pa.string()}
        for batch in batches:
            out: list[tuple] = []
            for doc, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                for p in parts:
                    run = b" ".join(words[p["first"] : p["first"] + p["count"] + window - 1])
                    out.append((p["anchor"], p["content"], doc, run.decode()))
            yield _arrow(kinds, list(zip(*out, strict=True)) or [[]] * 4)

    found = rows.mapInArrow(cut, "anchor long, content long, doc_id long, words string")
    return found.select(F.xxhash64("anchor", "content").alias("id"), "anchor", "content", "doc_id", "words")


def _window_rows(parts: DataFrame, window: int) -> DataFrame:
    """(hash, doc_id, id) of every window of the segments."""
    kinds = {"hash": pa.int64(), "doc_id": pa.int64(), "id": pa.int64()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, "int64")] for _ in kinds]
            for name, doc, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = hashes.of(words.encode().split())
                starts = np.arange(len(row) - window + 1)
                found = Runs(row).hash(starts, starts + window)
                for column, values in zip(columns, (found, np.full(len(found), doc), np.full(len(found), name)), strict=True):
                    column.append(values)
            yield _arrow(kinds, [np.concatenate(c) for c in columns])

    return parts.select("id", "doc_id", "words").mapInArrow(cut, "hash long, doc_id long, id long")


def _match(parts: DataFrame, window: int, shard: int, stream: int) -> DataFrame:
    """(anchor, content, places): windows of ``parts`` that a part of a smaller document has."""
    windows = _window_rows(parts, window)
    owners = (
        windows.groupBy("hash")
        .agg(F.min(F.struct("doc_id", "id")).alias("owner"), F.max("doc_id").alias("last"))
        .where("last > owner.doc_id")
        .select("hash", F.col("owner.doc_id").alias("owner_doc"), F.col("owner.id").alias("owner"))
    )
    links, _ = store(
        windows.join(owners, "hash").where("doc_id > owner_doc").select("owner", "id").distinct(), "substring-links"
    )
    held = links.select("owner").distinct()
    shards = max(1, -(-held.count() // shard))
    number = F.pmod(F.xxhash64(F.lit(5), "owner"), F.lit(shards)).cast("int")
    # a shard that many segments stream through goes to as many tasks as they fill
    asked = links.select(number.alias("shard"), "id").distinct()
    tasks = asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / stream).cast("int").alias("tasks"))
    reference = (
        held.select(F.col("owner").alias("id"), number.alias("shard"))
        .join(parts.select("id", F.col("doc_id").alias("known_doc"), F.col("words").alias("known_words")), "id")
        .join(tasks, "shard")
        .select("shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "known_doc", "known_words")
    )
    streamed = (
        asked.join(tasks, "shard")
        .select("shard", F.pmod(F.xxhash64(F.lit(7), "id"), F.col("tasks")).cast("int").alias("task"), "id")
        .join(parts, "id")
        .select("shard", "task", "anchor", "content", "doc_id", "words")
    )

    def follow(known: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        automaton = SuffixAutomaton()
        for doc, words in zip(known["known_doc"], known["known_words"], strict=True):
            automaton.add(words.encode().split(), int(doc))
        automaton.close()
        rows = []
        for row in asking.itertuples():
            places = automaton.earlier(row.words.encode().split(), int(row.doc_id), window)
            if places:
                rows.append((row.anchor, row.content, places))
        return pd.DataFrame(rows, columns=["anchor", "content", "places"])

    found = (
        reference.groupBy("shard", "task")
        .cogroup(streamed.groupBy("shard", "task"))
        .applyInPandas(follow, "anchor long, content long, places array<int>")
    )
    return found.groupBy("anchor", "content").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))


def repeated_windows(docs: DataFrame, window: int, gram: int, shard: int, stream: int) -> DataFrame:
    """(doc_id, text_key, starts): first places of the windows that an earlier document has."""
    rows, _ = store(_segment_rows(docs, window, gram), "substring-segments")
    place = F.struct("doc_id", "text_key", "first", "count")
    groups = rows.groupBy("anchor", "content").agg(F.min(place).alias("one"), F.max("doc_id").alias("last"))
    anchors = (
        groups.groupBy("anchor")
        .agg(F.min("one.doc_id").alias("low"), F.max("last").alias("high"), F.count(F.lit(1)).alias("kinds"))
        .where("low < high")
        .select("anchor", "kinds")
    )
    shared, _ = store(groups.join(anchors, "anchor"), "substring-groups")
    parts, _ = store(_texts_of(docs, shared.where("kinds > 1").select("anchor", "content", "one.*"), window), "substring-parts")
    marked, _ = store(_match(parts, window, shard, stream), "substring-matches")
    none = F.array().cast("array<int>")
    # of equal segments the first keeps what no earlier document has, all others lose everything
    known = shared.join(marked, ["anchor", "content"], "left").select(
        "anchor", "content", F.col("one.doc_id").alias("owner"), "last", F.coalesce("places", none).alias("places")
    ).where("last > owner or size(places) > 0").drop("last")
    known, _ = store(known, "substring-known")  # both sides of the next join can then be split where a key is hot
    inside = F.when(F.col("doc_id") > F.col("owner"), F.sequence(F.lit(0), F.col("count") - 1)).otherwise(F.col("places"))
    hit = rows.join(known, ["anchor", "content"]).select(
        "doc_id", "text_key", F.transform(inside, lambda p: p + F.col("first")).alias("starts")
    )
    return hit.where("size(starts) > 0").groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, stream: int = STREAM
) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, spans (removed runs as first and end word) and the
    kept ``text``, its words joined by one space, per row of ``docs``.

    A word goes if a window of ``window`` words covers it that also starts in a document with a
    smaller doc_id; windows are judged on the input. Null and empty texts have no words. Rows
    that share a doc_id are one document and never remove from each other; rows without doc_id
    neither remove nor lose words. Jobs run while intermediate tables are stored.
    """
    rows = keyed(docs)
    starts = repeated_windows(rows, window, gram, shard, stream)
    joined = rows.join(starts, same_row(rows, starts), "left").select(rows["doc_id"], rows["text_key"], "text", "starts")
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    kinds = {"doc_id": pa.int64(), "text_key": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "spans": span, "text": pa.string()}

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, key, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                spans: list[tuple[int, int]] = []
                for place in sorted(set(places or ())):
                    if spans and place <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], place + window)
                    else:
                        spans.append((place, place + window))
                kept, at = [], 0
                for first, end in spans:
                    kept += words[at:first]
                    at = end
                kept += words[at:]
                ends = [{"first": a, "end": b} for a, b in spans]
                out.append((doc, key, len(words), len(words) - len(kept), ends, b" ".join(kept).decode()))
            yield _arrow(kinds, list(zip(*out, strict=True)) or [[]] * len(kinds))

    return joined.mapInArrow(
        remove,
        "doc_id long, text_key long, n_words long, n_removed long, spans array<struct<first:int,end:int>>, text string",
    )
