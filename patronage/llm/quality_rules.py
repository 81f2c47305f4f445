"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; policies and ablations are bit arithmetic on the ledger and never read text again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import SPACES, ngram_hashes, split_words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Name and failure condition of each rule; a rule's place is its bit and never changes.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)

#: Policies by version: the rules whose failure rejects a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words"),
}


def mask_of(rules: Sequence[str], known: Sequence[tuple[str, str]] = RULES) -> int:
    places = {name: place for place, (name, _) in enumerate(known)}
    return sum(1 << places[name] for name in set(rules))


def _repeat_words(grams: Column, width: int) -> Column:
    """Places covered by runs of ``width`` words whose hash is found twice or more."""
    placed = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(ordered: Column) -> Column:
        return F.array_sort(
            F.transform(
                F.filter(
                    ordered,
                    lambda x, j: (x["h"] == F.get(ordered, j - 1)["h"]) | (x["h"] == F.get(ordered, j + 1)["h"]),
                ),
                lambda x: x["i"],
            )
        )

    def covered(places: Column) -> Column:
        widths = F.transform(
            places, lambda p, j: F.least(F.lit(width), F.coalesce(F.get(places, j + 1) - p, F.lit(width)))
        )
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, x: a + x)

    # transform over an array of one value computes that value once, whatever its uses
    ordered = F.transform(F.array(placed), repeated)
    return F.get(F.transform(ordered, covered), F.lit(0))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and MEASURES per row of ``docs``, all longs; a null text counts as empty."""
    body = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select(
        "doc_id",
        F.char_length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.char_length(body) - F.char_length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        split_words(F.col("text"), SPACES).alias("words"),
    )
    grams = parts.select("*", F.size("words").alias("count")).select(
        "*", ngram_hashes(F.col("words"), F.col("count"), 3).alias("grams")
    )
    return grams.select(
        "doc_id",
        F.col("count").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("grams")) < F.size("grams"), _repeat_words(F.col("grams"), 3))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def rule_ledger(docs: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``doc_id``, MEASURES and ``failures``, whose bit i is set if rule i fails.

    One row per row of ``docs`` (columns doc_id, text; others are ignored), repeated rows and
    null ids included. No shuffle: each document is judged on its own text.
    """
    bits = F.lit(0).cast("long")
    for place, (_, condition) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failures", bits)


def apply_policy(ledger: DataFrame, version: str, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """The ledger with ``kept``: none of the policy's rules fails."""
    mask = F.lit(mask_of(policies[version])).cast("long")
    return ledger.withColumn("kept", F.col("failures").bitwiseAND(mask) == 0)


def ablations(ledger: DataFrame, version: str, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """Per rule of a policy: rows that fail it, rows rejected by it alone, and rows that the
    policy without it keeps. Computed from counts per failure mask, a table of at most
    2 ** rules rows whatever the input."""
    names = list(policies[version])
    mask = mask_of(names)
    counts = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).count()
    rules = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(mask_of([n])).cast("long").alias("bit")) for n in names))
    each = counts.select("bits", "count", F.explode(rules).alias("r")).select("bits", "count", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("count")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("count")).otherwise(0)).alias(
            "kept_without"
        ),
    )
