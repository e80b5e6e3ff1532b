"""A training-corpus pipeline from the operators of ``ledgerlake.llm``.

Stages, in order; each takes (spark, docs, sf_dir) and all but the last return
documents with the input's columns:

1. toxicity: documents that the classifier, fitted on the labelled ones among them, rejects go;
2. near-dedup: the row of smallest doc_id of each group of near copies stays;
3. personal data: spans are replaced in the text, and n_chars follows;
4. mixing: documents are drawn so that sources, languages and topics meet their targets;
5. packing: the documents' token pieces with their places in sequences.

Null and empty texts pass all stages as empty documents. Stage 2 decides by row: rows of
equal doc_id stay if their texts are unlike, as do rows without doc_id that have no
copy; these leave in stage 4. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, near_dedup, packing, pii, toxicity
from ledgerlake.llm._store import stored
from ledgerlake.llm.queries import tokenizer_path

KEEP = 0.8  # share of tokens that the mixture keeps
NEAR_PERCENT = 80  # similarity of word shingles from which documents are near copies


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.fit_classifier(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, NEAR_PERCENT)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs, pii.fit_scorer(docs))
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep=KEEP)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Boosted trees, raking and tokenising are not SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
