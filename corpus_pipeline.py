"""From raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir), where docs is the stored output of the stage before,
and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from patronage.llm.common import keyed, read, same_row, store, with_rest
from patronage.llm.queries import public_vocabulary

#: Below this share of the best possible rank agreement a text is in none of the languages.
LEAST_LANGUAGE_SCORE = 0.1


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and texts that hardly agree with any profile. If no row has
    a language to learn from, every text is undetermined and only texts without a letter go."""
    profiles = language_id.learn_profiles(docs.where(~language_id.is_held_out(F.col("doc_id"), 4, 2)))
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    language = language_id.language_udf(profiles)(F.col("text"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), language.alias("language"))
    known = (F.col("language.lang_pred") != language_id.UNDETERMINED) & (
        F.col("language.score") >= LEAST_LANGUAGE_SCORE
    )
    return rows.where(known).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated lines; a text of which nothing is left stays as an empty one."""
    return with_rest(line_dedup.dedup_lines(docs, rest=True), docs.columns, F.col("text"))


def _without(docs: DataFrame, gone: DataFrame, once: bool = False) -> DataFrame:
    """Rows that ``gone`` does not name; with ``once``, one of those alike in id and text."""
    rows = keyed(docs, rest=True)
    rows = rows.join(gone, same_row(rows, gone), "left_anti")
    return with_rest(rows.dropDuplicates(["doc_id", "text_key"]) if once else rows, docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are linked by five-word Jaccard similarities of 0.8 or more, one with the
    smallest doc_id stays. A row is its doc_id and its text, so a text goes only if it is linked
    itself, whatever else has its id. Rows without words or doc_id stay. Of rows that repeat both
    id and text, one stays."""
    found = ngram_join.near_duplicates(docs)
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    gone = found.where(~stays).select("doc_id", "text_key").distinct()
    return _without(docs, gone, once=True)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a shorter item, go."""
    leaks = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, leaks.where("n_hit > 0").select("doc_id", "text_key").distinct())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return packing.pack(packing.cut_pieces(docs, **public_vocabulary()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: Models and tokenizers are not SQL; the tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's output written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
