"""Spelling variants by permuterm rotations.

Every word is marked with a terminator and rotated. The rotation that starts behind a character
and ends with it has, without that character, a prefix that names all other characters and their
places: words with the same prefix differ by a replacement in this place, and the word whose
whole rotation is that prefix lacks the character. All rotations are sorted by prefix, and a scan
over the sorted ranges emits the neighbours of each word.

A range holds at most one word per letter of the alphabet and the shorter word, whatever the size
of the corpus, because the characters of a word in it are fixed but for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import ascii_lower, store

RUNS = r"[A-Za-zÀ-ÿ]+"
#: Marks the end of a word; no run has it.
END = "$"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least this many times as frequent as the word.
TIMES = 10


def corrupted(doc_id: Column, run: Column) -> Column:
    """The lower-case run; if 31 divides h = crc32("<doc_id>:<run>"), without code point h % length.
    A null id counts as an empty one."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (h % F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))
    return F.when(h % 31 == 0, without).otherwise(run)


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of all whole texts. Shorter runs go before they are changed, as a
    deletion makes none longer; counts are added up in the tasks before the shuffle."""
    runs = docs.where("text is not null").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0))).alias("run"))
    long = runs.where(F.char_length("run") >= least_length).select("doc_id", ascii_lower(F.col("run")).alias("run"))
    words = long.select(corrupted(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """Rotations of ``words`` (word, n): ``prefix``, ``whole`` for those that end with no skipped
    character, and ``last`` unless the skipped character repeats in the next place.

    A word that differs by a character within a run of equal ones would meet its neighbour once
    for each of them; only the last of the run counts.
    """
    word = F.col("word")
    length = F.char_length(word)

    def skipping(i: Column) -> Column:
        after, before = F.substring(word, i + 2, length), F.substring(word, F.lit(1), i)
        return F.struct(
            F.concat(after, F.lit(END), before).alias("prefix"),
            F.lit(False).alias("whole"),
            (F.substring(word, i + 1, F.lit(1)) != F.substring(word, i + 2, F.lit(1))).alias("last"),
        )

    def entire(i: Column) -> Column:
        turned = F.concat(F.substring(word, i + 1, length), F.lit(END), F.substring(word, F.lit(1), i))
        return F.struct(turned.alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("last"))

    every = F.concat(
        F.transform(F.sequence(F.lit(0), length - 1), skipping), F.transform(F.sequence(F.lit(0), length), entire)
    )
    return words.select("word", "n", F.explode(every).alias("turned")).select("word", "n", "turned.*")


def neighbours(words: DataFrame) -> DataFrame:
    """For each word with a neighbour in a range: ``near``, how many it meets there, and ``best``,
    a struct of the most frequent other one (``less`` is its count, negated)."""
    in_order = Window.partitionBy("prefix").orderBy(F.desc("n"), "word")
    in_range = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.struct((-F.col("n")).alias("less"), "word")
    scanned = rotations(words).select(
        "word",
        "whole",
        "last",
        F.count("*").over(in_range).alias("size"),
        F.sum(F.col("last").cast("int")).over(in_range).alias("inserted"),
        F.max("whole").over(in_range).alias("has_whole"),
        F.row_number().over(in_order).alias("place"),
        F.first(entry).over(in_range).alias("first"),
        F.nth_value(entry, 2).over(in_range).alias("second"),
    )
    replaced = F.col("size") - F.col("has_whole").cast("int") - 1
    near = F.when(F.col("whole"), F.col("inserted")).otherwise(replaced + (F.col("has_whole") & F.col("last")).cast("int"))
    best = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first"))
    return scanned.where("size > 1").select("word", near.cast("long").alias("near"), best.alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where ``forms`` (word, form) leads in the end. Every round doubles the
    steps taken; as counts grow tenfold by each step, a chain of 18 steps is the longest that
    64-bit counts allow, and five rounds are the most."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        reached, _ = store(reached, "spelling-roots")
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(ahead, "root", "left")
        if reached.join(ahead, "root", "left_semi").isEmpty():
            return reached
        reached = moved.select("word", F.coalesce("further", "root").alias("root"))


def group_variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for each word of ``docs``
    (doc_id, text).

    Two words are near if one inserted, deleted or replaced code point makes one the other. A
    word's form is its most frequent near word (ties: the smallest by code points) if that is at
    least ``times`` as frequent. Null and empty texts have no words, an empty table gives an empty
    one; repeated rows count as often as they occur; other columns are not read. A task holds the
    runs of one text at a time, so memory grows with the longest text. Stored tables below the
    checkpoint folder hold words and counts only.
    """
    words, _ = store(count_words(docs, least_length, least_count), "spelling-words")
    none = F.lit(None).cast("struct<less: bigint, word: string>")
    met = neighbours(words).select("word", F.lit(None).cast("long").alias("n"), "near", "best")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("near"), none.alias("best"))
    found = met.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )
    has_form = -F.col("best.less") >= times * F.col("n")
    judged, _ = store(
        found.select(
            "word",
            "n",
            "n_near",
            F.when(has_form, F.col("best.word")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = last_forms(judged.where("form is not null").select("word", "form"))
    rooted = judged.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
