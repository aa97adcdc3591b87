"""Registered queries of the corpus operators, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyload.llm import (decontaminate, embedding_lsh, html_text, language_id, line_dedup, merkle, minhash, mixing, periodic_runs,
                          suffix_dedup, token_counts, url_filter, weak_quality)
from tidyload.llm.common import table


def op1_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_minhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_substring_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), min_bytes=50)
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        "doc.doc_id", (F.octet_length("kept_bytes") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("doc.page_id", "doc.url", "text", "n_chars")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = language_id.admitted("doc_id")
    found = language_id.identify(docs, language_id.train(docs.where(learn)), keep=["doc_id"])
    return found.select("doc.doc_id", "lang_pred", "score").withColumn("held_out", ~learn).select("doc_id", "held_out", "lang_pred", "score")


def op8_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_quality.quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc.doc_id", "posterior", "score", "good")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after its personal data is masked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", token_counts.personal_data_edits())
    return token_counts.count_tokens(docs, edits_col="edits", keep=["doc_id"]).select("doc.doc_id", *[f.name for f in token_counts.RESULT])


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.dedup_lines(docs, line_dedup.build(docs), keep=["doc_id"])
    return found.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def tampered_manifest(docs: DataFrame, bits: int = merkle.BITS) -> DataFrame:
    """Each document whose crc32 of the id is divisible by 7 has one more character than it says."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"n_chars": more}, where=chosen, bits=bits)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, after a repetition is planted in one document of ten."""
    found = periodic_runs.word_runs(table(spark, sf_dir, "documents"), keep=["doc_id"], plant=F.crc32(F.col("doc_id").cast("string")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", periodic_runs.strongest()).select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_dups, op2_minhash_dups, op3_url_filter, op4_benchmark_leaks, op5_substring_dups, op6_html_text,
        op7_language_id, op8_weak_quality, op9_token_counts, op10_source_mix, op11_line_dedup, op12_merkle_manifest,
        op13_periodic_runs)}
