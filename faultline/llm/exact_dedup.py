"""Exact deduplication by a 128-bit content hash, confirmed on the bytes.

Native DataFrame operations only.  Rows are grouped by ``(md5(text), text)``:
the fixed-width hash leads the key, and the text behind it makes the aggregate
compare bytes, so a hash collision cannot merge two texts.  Copies collapse in
the map-side half of the aggregate; each task sends one row per distinct text,
so a group of copies holding a third of all rows is a handful of rows after
that.

Defined cases
- null text counts as the empty text (empty texts are copies of one another);
- a null id loses against any other id; if all ids of a group are null,
  ``keep_id`` is null;
- rows that repeat both id and text are all marked ``kept`` by
  ``mark_copies``; ``drop_copies`` returns exactly one row per text;
- an empty table gives an empty result;
- columns of the input never clash with working columns: the result of
  ``mark_copies`` has only its own columns, ``drop_copies`` carries the input
  row in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(df: DataFrame, text_col: str) -> Column:
    return F.coalesce(df[text_col], F.lit(""))


def _hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def copy_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: ``h`` (128-bit hash), ``sha``, ``keep_id``, ``group_size``."""
    text = _text(df, text_col)
    return (
        df.select(df[id_col].alias("id"), _hash128(text).alias("h"), text.alias("t"))
        .groupBy("h", "t")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", F.sha2("t", 256).alias("sha"), "keep_id", "group_size")
    )


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The texts themselves are shuffled once, by the aggregate.  Its classes are
    brought back to the rows over ``(h, sha)``, a key of fixed width; Spark
    splits that join where one text has very many copies."""
    text = _text(df, text_col)
    rows = df.select(df[id_col].alias(id_col), _hash128(text).alias("h"), F.sha2(text, 256).alias("sha"))
    out = rows.join(copy_classes(df, id_col, text_col), ["h", "sha"])
    return out.select(
        id_col,
        "keep_id",
        "group_size",
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without copies: per distinct text the row with the largest id.

    One shuffle: the whole row travels through the aggregate."""
    hashable = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    text = _text(df, text_col)
    picked = (
        df.select(
            F.struct(*[df[c] for c in df.columns]).alias("r"),
            F.struct(df[id_col].alias("id"), F.xxhash64(*[df[c] for c in hashable]).alias("tie")).alias("o"),
            _hash128(text).alias("h"),
            text.alias("t"),
        )
        .groupBy("h", "t")
        .agg(F.max_by("r", "o").alias("r"))
    )
    return picked.select("r.*")


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)
