"""Schema checks that collect every violation before failing.

Column-count and column-name checks read only metadata.  The value check
(text that does not parse as a number) is one aggregate over all columns.
Violations come back as a DataFrame ``(frame, check, detail)``;
``assert_valid`` raises once with all of them, like the reference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.spec import ColumnSpec

VIOLATION_SCHEMA = "frame string, check string, detail string"


def column_count_ok(df: DataFrame, spec: ColumnSpec, expect_label: bool = True) -> bool:
    """Training tables carry the label (features + 1); scoring input must not."""
    return len(df.columns) == spec.n_columns(with_label=expect_label)


def missing_features(df: DataFrame, spec: ColumnSpec) -> list[str]:
    """Declared features absent from the frame (extra columns are allowed)."""
    present = set(df.columns)
    return [c for c in spec.features if c not in present]


def metadata_violations(name: str, df: DataFrame, spec: ColumnSpec, expect_label: bool = True) -> list[tuple]:
    out = []
    if not column_count_ok(df, spec, expect_label):
        out.append(
            (name, "column_count", f"expected {spec.n_columns(with_label=expect_label)} columns, found {len(df.columns)}")
        )
    for c in missing_features(df, spec):
        out.append((name, "missing_numeric_column", c))
    return out


def non_numeric_counts(name: str, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(frame, check, detail)`` rows for string features holding text that is
    not a number, one aggregate pass over all columns."""
    text_cols = [f.name for f in df.schema.fields if f.name in set(features) and isinstance(f.dataType, T.StringType)]
    spark = df.sparkSession
    if not text_cols:
        return spark.createDataFrame([], VIOLATION_SCHEMA)
    aggs = [
        F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS DOUBLE)").isNull()).alias(c) for c in text_cols
    ]
    counts = df.agg(*aggs).unpivot([], text_cols, "column", "n_bad")
    return counts.filter(F.col("n_bad") > 0).select(
        F.lit(name).alias("frame"),
        F.lit("non_numeric_values").alias("check"),
        F.concat(F.col("column"), F.lit(": "), F.col("n_bad").cast("string")).alias("detail"),
    )


def violations(
    frames: Mapping[str, DataFrame],
    spec: ColumnSpec,
    expect_label: bool = True,
    check_values: bool = True,
) -> DataFrame:
    """All violations of all frames as one DataFrame."""
    spark: SparkSession = next(iter(frames.values())).sparkSession
    meta = []
    for name, df in frames.items():
        meta.extend(metadata_violations(name, df, spec, expect_label))
    out = spark.createDataFrame(meta, VIOLATION_SCHEMA)
    if check_values:
        for name, df in frames.items():
            present = [c for c in spec.features if c in df.columns]
            out = out.unionByName(non_numeric_counts(name, df, present))
    return out


class ValidationError(Exception):
    pass


def assert_valid(violations_df: DataFrame) -> None:
    """Raise once with every violation message (bounded: one row per column at most)."""
    rows = violations_df.collect()  # bounded: a few checks per column and frame
    if rows:
        raise ValidationError("\n".join(f"{r['frame']}: {r['check']}: {r['detail']}" for r in rows))
