"""The operators as queries of a table folder, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    bpe,
    conversations,
    decontaminate,
    licences,
    lm,
    packing,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    spelling,
    substring_dedup,
    url_filter,
)
from usagelens.llm.common import held_out, table


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of all documents."""
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    out = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items found in any document."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    table(spark, sf_dir, "benchmark").select("item_id", "text"))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary_path()).drop("text")


def span_list(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_spans(docs, secrets.train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(span_list("base"), 256).alias("base_sha256"),
                        span_list("spans").alias("spans"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; a seventh of them, by id, is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "held_out", held_out("doc_id", 7, 2))
    learned = docs.where(~F.col("held_out"))
    counts = lm.count_tokens(learned)
    return lm.score(docs, lm.train(learned, counts), counts)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the labels, by id, is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    model = quality_model.train(docs, labels)
    scored = quality_model.classify(docs, model)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.counted_words(docs, typo_every=31).where("n >= 2"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all damaged conversations and the cheapest edits that repair them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.figures(conversations.damage(rows), rows)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_bpe_encoding": op5_bpe_encoding,
    "op6_secret_scans": op6_secret_scans,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_url_filters": op10_url_filters,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {}
