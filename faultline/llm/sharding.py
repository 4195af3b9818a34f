"""Sharding by extendible hashing.

A document's hash bits are an md5 of its key.  The directory is indexed by hash
prefixes: a bucket whose documents exceed the byte limit splits on its next bit,
all others stay, until every bucket fits.  Every bucket is one shard; its label is
its prefix bits, so the shard of a key follows from the directory alone.

Buckets are settled in rounds of ``BITS_A_ROUND`` bits.  A round sums the bytes of
each prefix of the still unsettled rows, for all depths of the round at once (one
map-side combined aggregate), and settles every row at the first depth where its
bucket fits.  Only rows of oversized buckets go on to the next round; the bytes of
a bucket never meet in one task.

When the hash bits are used up, rows of an oversized bucket have the same key (or
there is a single document larger than the limit).  They are told apart by
their rank in the bucket: the exact way for what splitting cannot separate.  A
single document above the limit gets a shard of its own.

Defined cases
- null text has 0 bytes; a null key is hashed as the empty string;
- rows that repeat a key share a bucket until the bits are used up;
- an empty table gives an empty directory and result;
- (id, text) are the only columns read, so extra columns never clash;
  ``write_shards`` writes the input's columns and refuses an input that
  already has a column called ``shard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh_name, global_rank, materialize

HASH_BITS = 60
BITS_A_ROUND = 12


def hash_bits(key: Column, seed: int = 0) -> Column:
    """60 hash bits of a key as a long: the first 15 hex digits of md5('<seed>:<key>')."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth: Column) -> Column:
    """The first ``depth`` bits of ``h``."""
    return F.call_function("shiftright", F.col("h"), F.lit(HASH_BITS) - depth)


def _label(depth: Column, prefix: Column) -> Column:
    """Prefix bits as text; the whole hash space is the empty label."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(prefix.cast("string"), 10, 2), depth, "0"))


def assign_shards(
    docs: DataFrame, max_bytes: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: id, the columns in ``carry``, ``n_bytes``, ``shard`` (label),
    ``depth`` and ``shard_bytes`` (the shard's total)."""
    left = materialize(
        docs.select(
            docs[id_col].alias(id_col),
            *[docs[c] for c in carry],
            F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long").alias("n_bytes"),
            hash_bits(docs[id_col], seed).alias("h"),
        ),
        "hashed",
    )
    names = left.columns
    done: list[DataFrame] = []
    for low in range(0, HASH_BITS + 1, BITS_A_ROUND + 1):
        high = min(low + BITS_A_ROUND, HASH_BITS)
        # bytes per prefix at the round's last depth, then of all shorter prefixes of the round
        leaves = materialize(left.groupBy(_prefix(F.lit(high)).alias("leaf")).agg(F.sum("n_bytes").alias("b")), "leaves")
        up = leaves.select("leaf", "b", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn(
            "prefix", F.call_function("shiftright", F.col("leaf"), F.lit(high) - F.col("depth"))
        )
        fits = up.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes")).filter(F.col("shard_bytes") <= max_bytes)
        settled = (
            up.join(fits, ["depth", "prefix"]).groupBy("leaf")
            .agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("s")).select("leaf", "s.*")
        )
        placed = left.withColumn("leaf", _prefix(F.lit(high))).join(materialize(settled, "settled"), "leaf", "left")
        placed = materialize(placed, "placed")
        label = _label(F.col("depth"), F.col("prefix")).alias("shard")
        done.append(placed.filter("depth is not null").select(*names, label, "depth", "shard_bytes"))
        left = placed.filter("depth is null").select(*names)
        if left.isEmpty():
            break
    else:
        done.append(_by_rank(left, max_bytes, names))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("h")


def _by_rank(left: DataFrame, max_bytes: int, names: list[str]) -> DataFrame:
    """Shards for rows that no hash bit separates: the bucket's label, a dot and a number.

    In rank order each shard takes as many rows as fit even if all were as large
    as the bucket's largest."""
    ranked = materialize(global_rank(left, ["h", "n_bytes", *names[:-2]]), "ranked")
    per = ranked.groupBy(F.col("h").alias("g")).agg(
        F.min("rank").alias("first"), F.greatest(F.floor(F.lit(max_bytes) / F.max("n_bytes")), F.lit(1)).alias("per")
    )
    number = F.floor((F.col("rank") - F.col("first")) / F.col("per"))
    rows = ranked.join(per, F.col("h") == F.col("g")).withColumn("number", number)
    rows = materialize(rows, "numbered")
    total = rows.groupBy(F.col("h").alias("g2"), F.col("number").alias("n2")).agg(F.sum("n_bytes").alias("shard_bytes"))
    label = F.concat(_label(F.lit(HASH_BITS), F.col("h")), F.lit("."), F.col("number").cast("string"))
    return rows.join(total, (F.col("h") == F.col("g2")) & (F.col("number") == F.col("n2"))).select(
        *names, label.alias("shard"), F.lit(HASH_BITS).alias("depth"), "shard_bytes"
    )


def directory(assigned: DataFrame) -> DataFrame:
    """The shards of ``assign_shards``: ``shard``, ``depth``, ``n_docs``, ``shard_bytes``."""
    return assigned.groupBy("shard", "depth", "shard_bytes").agg(F.count("*").alias("n_docs"))


def write_shards(docs: DataFrame, path: str, max_bytes: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """Write the input as Parquet, one folder ``shard=<label>`` per shard; returns the directory."""
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("the input already has a column called shard")
    num = fresh_name("row_num", docs.columns)
    keyed = materialize(docs.withColumn(num, F.monotonically_increasing_id()), "numbered")
    assigned = materialize(assign_shards(keyed, max_bytes, id_col, text_col, seed, (num,)), "shards")
    where = assigned.select(F.col(num).alias("_n"), F.concat(F.lit("s"), "shard").alias("shard"))
    out = keyed.join(where, keyed[num] == where["_n"]).select(*[keyed[c] for c in docs.columns], "shard")
    out.repartition("shard").write.partitionBy("shard").parquet(path)  # a shard is bounded by max_bytes
    return directory(assigned)
