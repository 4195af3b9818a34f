"""One registered query per operator, over the driver's whole tables.

Each query gets its rows from its operator with production parameters and
derives digest columns where its contract asks for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    byte_bpe,
    exact_dedup,
    language_id,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    sharding,
    spelling,
    topk,
    url_filter,
)
from faultline.llm.common import table

# --- Fixed values: the URL rules of op2. ---------------------------------------------
URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]
# --------------------------------------------------------------------------------------


def tokenizer_args() -> dict:
    """Rank file, split pattern and special tokens of the byte-level BPE with 50k ids."""
    import public_tokenizers as pt

    return {
        "ranks_path": pt.path("byte_bpe_50k.tiktoken"),
        "pattern": pt.PATTERN,
        "special": {"<|endoftext|>": 50256},
    }


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), **tokenizer_args())
    return packing.pack(pieces)


SHARD_BYTES = 1 << 20


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, is_query=F.col("vec_id") % 20 == 0, k=20, scale=64)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades 0 (toxic), 1 (clean, low quality), 2 (clean, good) from the two flags."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, graded_labels(table(spark, sf_dir, "labels")), n_grades=3)
    return quality.score(docs, model, keep_from=2)


def held_out(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, train=~held_out(F.col("doc_id")))
    out = language_id.predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as pt

    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, pt.path("byte_bpe_multi_50k.tiktoken"), pt.PATTERN)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    looped = docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.summarize(looped)


SLIP_MODULUS = 97


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), slip_modulus=SLIP_MODULUS)
    return spelling.variants(words)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_topk": op7_topk,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}
