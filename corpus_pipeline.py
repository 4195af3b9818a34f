"""Corpus pipeline: five operators applied to ``documents`` one after another.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's result as Parquet under the shared checkpoint folder and reads it again
as the next stage's ``docs``.  All but the last stage return the columns of
``documents``.

1. language_id: documents without a determinable language are rejected (null
   text, or no letter in it); the model learns from the labels of its input.
2. exact_dedup: one document of each group of equal texts stays (largest id).
3. ngram_join: one document of each near-duplicate class stays (smallest id).
4. mixing: sources are mixed to target weights; a document is repeated or left out
   as its expected copies say.
5. packing: what is left is tokenised and packed; one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import exact_dedup, language_id, mixing, ngram_join, packing
from faultline.llm.common import materialize, table
from faultline.llm.queries import tokenizer_args


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    return language_id.keep_determined(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, **tokenizer_args()))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language ID and n-gram hashing have no SQL form; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
