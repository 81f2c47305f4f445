"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to three letters, word
edges marked). A document's own list is compared with every profile: each of its n-grams adds
the distance between its two ranks, or the full list length if the profile lacks it. The
language with the smallest sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
RANKS = 300
#: More learned languages than this are a mistake in the labels: an error, never a cut.
MAX_LANGUAGES = 2_000
_EDGE = 1
_BITS = 21
_HELD = 2_000_000  # n-grams counted together in a training task


@cache
def _letters() -> np.ndarray:
    """By code point: its lower-case letter + 2, or the edge mark for what is no letter."""
    table = np.full(0x110000, _EDGE, "int64")
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = (ord(low) if len(low) == 1 else point) + 2
    return table


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, empty if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), "<u4")
    row = np.concatenate(([_EDGE], _letters()[points], [_EDGE]))
    inside = row != _EDGE
    row = row[inside | np.concatenate(([True], inside[:-1]))]
    if len(row) < 2:
        return row[:0]
    if row[-1] != _EDGE:
        row = np.append(row, _EDGE)
    pairs = row[:-1] << _BITS | row[1:]
    triples = (pairs[:-1] << _BITS | row[2:])[row[1:-1] != _EDGE]
    return np.concatenate((row[row != _EDGE], pairs, triples))


def is_held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def learn_profiles(labelled: DataFrame, ranks: int = RANKS) -> dict[str, list[int]]:
    """The ``ranks`` most frequent n-grams of each language, ties by code, from all rows of
    ``labelled`` (text, lang). Rows without text or lang teach nothing. The result, at most
    MAX_LANGUAGES * ranks numbers, is collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts.astype("int64"))],
                    ["lang", "code", "n"],
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = ngrams(text)
                held.setdefault(lang, []).append(codes)
                size += len(codes)
                if size >= _HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    known = labelled.where("lang is not null and text is not null").select("lang", "text")
    counts = known.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = counts.withColumn("place", place).where(F.col("place") <= ranks)
    lists = best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("list"))
    rows = lists.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: lang holds something else")
    return {r["lang"]: [x["code"] for x in r["list"]] for r in sorted(rows, key=lambda r: r["lang"])}


class Ranker:
    """Compares n-gram lists with all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], ranks: int = RANKS):
        self.ranks = ranks
        self.names = sorted(profiles)
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], "int64"))
        # one row more, for n-grams that no profile has
        self.places = np.full((len(self.codes) + 1, len(self.names)), -1, "int32")
        for column, name in enumerate(self.names):
            self.places[np.searchsorted(self.codes, profiles[name]), column] = np.arange(len(profiles[name]))

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: one less the distance as a share of the largest possible."""
        grams = ngrams(text)
        if not len(grams) or not self.names:
            return UNDETERMINED, 0.0
        codes, counts = np.unique(grams, return_counts=True)
        own = codes[np.argsort(-counts, kind="stable")[: self.ranks]]
        found = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        places = self.places[np.where(self.codes[found] == own, found, len(self.codes))]
        away = np.abs(places - np.arange(len(own), dtype="int32")[:, None])
        total = np.where(places < 0, self.ranks, away).sum(axis=0)
        best = int(total.argmin())
        return self.names[best], float(1 - total[best] / (self.ranks * len(own)))


def language_udf(profiles: dict[str, list[int]], ranks: int = RANKS):
    """A column function: text to a struct of lang_pred and score.

    Text that is null, empty or without a letter, and any text if no language was learned, is
    "und" with score 0. Equal distances go to the first name in order.
    """

    ranker = Ranker(profiles, ranks)

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([ranker.judge(t) for t in texts], columns=["lang_pred", "score"])

    return judge


def identify(
    docs: DataFrame, parts: int = 4, part: int = 2, ranks: int = RANKS, into: str = "language"
) -> DataFrame:
    """All columns of ``docs`` and a struct column ``into`` (lang_pred, score), replaced if there.

    Profiles are learned from the rows whose id is not held out; lang and ids take no part in a
    prediction. Two passes over the texts, and no shuffle of them.
    """
    labelled = docs.where(~is_held_out(F.col("doc_id"), parts, part)).select("text", "lang")
    judge = language_udf(learn_profiles(labelled, ranks), ranks)
    return docs.withColumn(into, judge(F.col("text")))
