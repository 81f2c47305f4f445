"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import (
    conversation_repair,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    private_data,
    quality_rules,
    spelling_variants,
    substring_dedup,
    toxicity,
    url_filter,
)
from patronage.llm.private_scan import STRICT
from patronage.llm.common import read


def public_vocabulary() -> dict[str, str]:
    """Files of the public tokenizer that the packing query uses."""
    import public_tokenizers

    path = public_tokenizers.path
    return {
        "tokenizer": path("byte_bpe_50k.json"),
        "ranks": path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op1_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = language_id.identify(read(spark, sf_dir, "documents"))
    held_out = language_id.is_held_out(F.col("doc_id"), 4, 2)
    return judged.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op3_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per page. A page's outcome is bad if the row of ``labels`` with its id has quality 0."""
    labels = read(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    judged = url_filter.filter_urls(read(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_adaptive_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_adaptive_prefix_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with the number of links of every document."""
    found = ngram_join.with_link_counts(read(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_pieces(read(spark, sf_dir, "documents"), **public_vocabulary()))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.rule_ledger(read(spark, sf_dir, "documents"))
    base = quality_rules.apply_policy(ledger, "base")
    judged = quality_rules.apply_policy(base.withColumn("base_failed", ~F.col("kept")), "v2")
    return judged.select("doc_id", *quality_rules.MEASURES[:5], "base_failed", "kept")


def op10_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the labels of documents whose crc32 leaves 0 or 2 by 3."""
    docs = read(spark, sf_dir, "documents")
    held_out = language_id.is_held_out(F.col("doc_id"), 3, 1)
    labels = read(spark, sf_dir, "labels")
    score = toxicity.toxicity_udf(toxicity.fit_on(docs, labels.where(~held_out)))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


def op11_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(spans: str):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("private.strict", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = private_data.find_private(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(count(kind) for kind in STRICT),
        F.sha2(written("private.strict"), 256).alias("base_sha256"),
        written("private.spans").alias("spans"),
    )


def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(read(spark, sf_dir, "documents"))


def op13_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(read(spark, sf_dir, "conversations"))
    return conversation_repair.repair(damaged).withColumnRenamed("hash", "repaired_sha256")


QUERIES = {
    "op1_rank_order": op1_rank_order,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_automata": op3_suffix_automata,
    "op4_url_reputation": op4_url_reputation,
    "op5_adaptive_prefix": op5_adaptive_prefix,
    "op5_adaptive_prefix_links": op5_adaptive_prefix_links,
    "op6_best_fit": op6_best_fit,
    "op7_line_runs": op7_line_runs,
    "op8_winnowing": op8_winnowing,
    "op9_rule_ledger": op9_rule_ledger,
    "op10_recurrent_toxicity": op10_recurrent_toxicity,
    "op11_weak_supervision": op11_weak_supervision,
    "op12_permuterm": op12_permuterm,
    "op13_glr_repair": op13_glr_repair,
}
