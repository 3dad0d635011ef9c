"""Corpus cleaning: toxicity, line dedup, near-dedup, packing, one after the other over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes every stage's result as Parquet in the shared
folder and reads it back for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm import ftrl, golay_simhash, packing, template_lines
from loanlake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go, but for exactly 0.5, the score of a model that no weight moves (as
    where nothing is labelled). The model learns from the labelled rows of ``docs`` whose crc32(doc_id) mod 5
    is not 0."""
    labels = table(spark, sf_dir, "labels").where(ftrl.remainder("doc_id", 5) != 0)
    scored = ftrl.score(docs, ftrl.fit(docs, labels), keep=docs.columns)
    return scored.where("predicted = 0 OR score = 0.5").select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template occurs in several documents go, but for the first; no document goes."""
    cleaned = template_lines.drop_recurring(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 or fewer bits (4-word shingles) stays."""
    return golay_simhash.drop_near_duplicates(docs, words_each=4, max_bits=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed documents. The workers also hold what earlier stages keep, so the tokenizer's word
    cache is a quarter of its default."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_entries=250_000)
    return pieces.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "loss_tokens")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_recurring_lines),
          ("simhash_dedup", near_duplicates), ("packing", pack)]

#: Logistic regression, fingerprints and tokenizers are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
