"""Helpers shared by the operators: durable intermediate tables, global ranks, word codes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import checkpoint_dir

_LOCAL_BITS = 33  # low bits of monotonically_increasing_id() count rows within a partition


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    It cuts lineage like ``checkpoint()`` does, in a columnar compressed form
    that later scans can prune.  A lost executor costs no recomputation of what
    was written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column is called that."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "rank") -> DataFrame:
    """Add a gapless 0-based rank over all rows in ``order`` order.

    Rows are range-partitioned and sorted, so no key, however frequent, meets
    in one task.  The order is written once; each row's position in its
    partition is then fixed, and the only table sent to every task has one row
    per partition (the number of rows before it)."""
    order = list(order)
    ranged = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    )
    kept = materialize(ranged, "ranked").withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        kept.groupBy("_pid").agg(F.count("*").alias("_n"))
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )  # one row per range partition
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        kept.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, F.col("_before") + local)
        .drop("_pid", "_mid", "_before")
    )


def seeded_unit(seed: int | str, *cols: Column) -> Column:
    """A draw in [0, 1) from ``md5('<seed>:<col>:...')``; null columns are skipped.

    The first 13 hex digits, so that DuckDB computes the same double."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


# -- words of a batch of texts, inside a task ----------------------------------
def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """White-space words of a string column as ``(codes, doc_of_word, vocabulary)``.

    Words are coded by their place in the batch's vocabulary, so that per-word
    work (hashing, table look-ups) runs once per distinct word.  Null texts have
    no words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.utf8_split_whitespace(texts)
    words = lists.flatten()
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    enc = words.dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False)
    vocab = enc.dictionary
    empty = np.flatnonzero(pc.equal(vocab, "").to_numpy(zero_copy_only=False))  # from leading or trailing white space
    if len(empty):
        keep = codes != empty[0]
        codes, doc = codes[keep], doc[keep]
    return codes, doc, vocab


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in vocab.cast(pa.large_binary()).to_pylist()), np.uint64, len(vocab))


def ngram_hashes(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order-sensitive 64-bit hashes of each run of ``n`` words within a document.

    Returns the hashes and the document of each."""
    if len(word_hash) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = len(word_hash) - n + 1
    h = mix64(word_hash[:last])
    for i in range(1, n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hash[i : i + last])
    inside = doc[:last] == doc[n - 1 :]
    return h[inside], doc[:last][inside]
