"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import fingerprints, html_extraction, mixing, near_dedup, packing, periodic_runs, pii, quality_rules, substring_dedup, suffix_dedup, token_alignment, toxicity, url_reputation


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the labels outside the held-out fold; every document scored."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(fold != 0).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit_classifier(docs, labels))
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weigh(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_pii(docs, pii.fit_scorer(docs))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; a page's outcome is the label row of the same number, bad if low quality or toxic."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_reputation.judge_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    crf = quality_rules.fit_crf(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge_quality(docs, crf)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages, html_extraction.fit(pages))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_alignment.align(docs, tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model")).documents()
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_url_reputation": op7_url_reputation,
    "op8_fingerprints": op8_fingerprints,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_html_extraction": op11_html_extraction,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE: dict[str, str] = {"op7_url_reputation": url_reputation.ORACLE}
