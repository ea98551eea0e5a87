"""Corpus pipeline over ``documents``: language ID, near-dedup, PII, source mixing, packing.

Each stage takes what the one before kept, written to the shared folder and read again:

* language: documents whose text is null or has no letter are rejected, all others stay,
  whatever their language, and also if no language could be learned;
* dedup: one document of each group of near-duplicates stays (5-word shingles, Jaccard >= 0.8);
* private: spans of personal data are replaced by their kind in brackets, n_chars follows;
* mix: sources are taken to their target weights, documents dropped or repeated whole;
* pack: texts are encoded and packed into sequences of 1024 tokens.

All but the last return the columns of ``documents``. Repeated documents of the mix are rows
with the same doc_id.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import langid, minhash, mixing, packing, pii
from hirelens.llm.common import unused, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score = unused("lang_pred", docs.columns), unused("score", docs.columns)
    model = langid.train(docs)
    if not model.langs:
        return langid.with_letters(docs)
    found = langid.predict(docs, model, lang, score)
    return found.where(found[score] > 0).select(*docs.columns)      # 0: no text or no letter


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, width=5, percent=80).select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # executors hold what earlier stages left in the JVM: a smaller cache of chunks than the operator's own
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_bytes=10 << 20))


STAGES = [("language", language), ("dedup", dedup), ("private", private), ("mix", mix), ("pack", pack)]
# Language model and tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
