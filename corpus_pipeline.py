"""The corpus pipeline: documents in, clean and tokenized documents out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import bpe, decontam, jaccard, langid, paragraphs
from folio.llm.common import removed, table, written

#: Least share of a text's words that the language model has evidence of: known words, or known n-grams of two characters or more.
EVIDENCE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised. Those go whose prediction is `und` (null text, no letter) and those that are
    in none of the languages learned: the prediction rests on under EVIDENCE of their words. Learns from the documents whose
    lang is not null; if none is, only texts without a letter go. All columns stay as they are."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    got = langid.identify(docs, model)
    pred, _, evidence = got.columns[len(docs.columns) :]
    return got.where((F.col(pred) != langid.UNKNOWN) & (F.col(evidence) >= EVIDENCE)).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (5-word shingles, similarity 0.8): the one of least doc_id, and one
    row of it. A row without doc_id stays only where its group has no row with one, and then once."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of texts; n_chars follows where a text changes. A document of which nothing is left but white
    space goes."""
    got = paragraphs.dedup(docs)
    n_words, cut, _ = got.columns[len(docs.columns) :]
    left = got.where((F.col(cut) == 0) | (F.col(cut) < F.col(n_words)))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(cut) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and token_ids; a name that docs already has gets underscores at its end."""
    return bpe.encode(docs, ids=True, texts=False, cache=20_000, step=1 << 19)  # less memory: it is the last of five stages


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("bpe", encode),
]

#: No SQL: language scores, MinHash-guided cuts and byte-pair merges are beyond it; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
            if k:
                removed(before)
    return docs
