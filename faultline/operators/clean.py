"""Projection and cleaning operators for the raw sensor table.

All rewrites are single ``select`` projections (no chains of ``withColumn``),
so a 170-column table stays one cheap analysis and one codegen stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.labels import decode_label, encode_label
from faultline.operators.ranking import number_rows
from faultline.session import shared_table
from faultline.spec import MISSING_TOKEN, ColumnSpec


def with_row_key(df: DataFrame, out: str) -> DataFrame:
    """Append a row key that depends on the rows alone, not on files or partitions:
    ``<md5 of the row>:<n>``, n numbering equal rows (which are interchangeable).

    The rows are range-partitioned by their md5 and a running id, so equal rows, however
    many, are spread over tasks; n is a row's place among all rows less that of its md5's first."""
    null = F.lit("\\N")
    content = F.md5(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), null) for c in sorted(df.columns)]))
    by = ["_fl_md5", "_fl_uid"]
    ordered = df.withColumns({"_fl_md5": content, "_fl_uid": F.monotonically_increasing_id()})
    placed = number_rows(ordered.repartitionByRange(*by).sortWithinPartitions(*by), "_fl_place")
    # only values that occur more than once need their first place
    first = placed.groupBy("_fl_md5").agg(F.min("_fl_place").alias("_fl_first"), F.count("*").alias("_fl_n"))
    first = shared_table(first.filter("_fl_n > 1").drop("_fl_n"), "repeated")
    nth = F.coalesce(F.col("_fl_place") - F.col("_fl_first"), F.lit(0)) + 1
    return placed.join(first, "_fl_md5", "left").select(
        *[placed[c] for c in df.columns], F.concat_ws(":", "_fl_md5", nth.cast("string")).alias(out)
    )


def drop_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns, failing when one is absent (Spark's ``drop`` is lenient)."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise KeyError(f"columns not found: {absent}")
    return df.drop(*cols)


def drop_lenient(df: DataFrame, cols: Sequence[str], id_col: str = "_id") -> DataFrame:
    """Drop the listed columns if present, plus the document-store id."""
    return df.drop(*cols, id_col)


def missing_to_null(df: DataFrame, token: str = MISSING_TOKEN, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace the exact string ``token`` with NULL in every string column."""
    targets = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and (targets is None or f.name in targets):
            out.append(F.nullif(F.col(f.name), F.lit(token)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def cast_features(df: DataFrame, features: Sequence[str], strict: bool = True) -> DataFrame:
    """Cast feature columns to double.

    ``strict`` fails on text that is not a number (ANSI cast); otherwise such
    values become NULL (``try_cast``) and can be counted with
    ``validation.non_numeric_counts``.  NaN becomes NULL either way.
    """
    feats = set(features)

    def conv(c: str) -> Column:
        v = F.col(c).cast("double") if strict else F.expr(f"try_cast(`{c}` AS DOUBLE)")
        return F.nanvl(v, F.lit(None).cast("double")).alias(c)

    return df.select(*[conv(c) if c in feats else F.col(c) for c in df.columns])


def clean_sensor_table(
    df: DataFrame,
    spec: ColumnSpec,
    with_label: bool = True,
    strict_drop: bool = False,
    strict_cast: bool = True,
) -> DataFrame:
    """Drop unused columns, turn ``"na"`` into NULL and cast features to double."""
    df = drop_strict(df, spec.drop) if strict_drop else drop_lenient(df, spec.drop)
    df = missing_to_null(df)
    present = [c for c in spec.features if c in df.columns]
    df = cast_features(df, present, strict=strict_cast)
    if with_label and spec.label not in df.columns:
        raise KeyError(f"label column {spec.label!r} missing")
    return df


def with_label_code(df: DataFrame, label_col: str, out: str = "label", strict: bool = True) -> DataFrame:
    """Append the integer label (``neg`` -> 0, ``pos`` -> 1)."""
    return df.select("*", encode_label(label_col, strict=strict).alias(out))


def split_features_target(df: DataFrame, spec: ColumnSpec, keys: Sequence[str] = (), out: str = "label") -> DataFrame:
    """Keep keys and features, replacing the label text with its code (one frame)."""
    return df.select(*keys, *spec.features, encode_label(spec.label).alias(out))


def filter_class(df: DataFrame, label_col: str, value: str) -> DataFrame:
    return df.filter(F.col(label_col) == F.lit(value))


def assemble_array(df: DataFrame, features: Sequence[str], out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Features as one ``array<double>`` column (the dense-matrix form)."""
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in features]).alias(out))


def prepend_prediction(
    df: DataFrame, prediction_col: str, features: Sequence[str], label_col: str = "class"
) -> DataFrame:
    """Decoded prediction as the first column, followed by the features."""
    return df.select(decode_label(F.col(prediction_col)).alias(label_col), *features)
