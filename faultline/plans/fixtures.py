"""Sensor-style views derived from the driver's tables.

The reference's truck-sensor file is not shipped, so its shapes are rebuilt
from the given tables (definitions in FIXTURES.md).  Each view is a plain
projection that scales with its source table and has a DuckDB twin in
``oracle.py``, so results can be checked row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.spec import ColumnSpec

# --- Fixed values: bindings of the sensor roles to the driver's tables. -------
SENSOR_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SENSOR_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SENSOR_SPEC = ColumnSpec(features=tuple(SENSOR_MEASURES), label="class", keys=tuple(SENSOR_KEYS))
DRIFT_CUTOFF = "1998-06-01"
EVENTS_CUTOFF = "2024-01-16"
SQL_PVALUE = "stephens"  # the p-value formula that SQL can state; the operators' default is the finite-sample law
VEC_DIMS = 64  # the whole embedding vector
VEC_FEATURES = [f"f{i}" for i in range(1, VEC_DIMS + 1)]
# trees that SQL can state: two levels, three rounds
TREES = {"learning_rate": 0.9, "max_depth": 2, "n_estimators": 3, "max_bins": 16}
SEARCH_GRID = {"learning_rate": [0.5, 0.9], "max_depth": [1, 2], "n_estimators": [2, 4], "max_bins": [16]}
VEC_SPEC = ColumnSpec(features=tuple(VEC_FEATURES), label="class", keys=("vec_id",))
# -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a raw sensor file: keys, text ``class``, measures as text
    with ``"na"`` where ``md5('na:<column>:<key>')`` starts with ``0``."""
    li = table(spark, sf_dir, "lineitem")
    key = [F.col(k).cast("string") for k in SENSOR_KEYS]

    def masked(c: str):
        h = F.md5(F.concat_ws(":", F.lit("na"), F.lit(c), *key))
        return F.when(F.substring(h, 1, 1) == "0", F.lit("na")).otherwise(F.col(c).cast("string")).alias(c)

    label = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), "pos").otherwise("neg")
    return li.select(*SENSOR_KEYS, label.alias("class"), *[masked(c) for c in SENSOR_MEASURES])


def lineitem_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with ``late``: whether the row is of the current period."""
    return table(spark, sf_dir, "lineitem").withColumn("late", F.col("l_shipdate") >= F.lit(DRIFT_CUTOFF).cast("timestamp_ntz"))


def events_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("late", F.col("ts") >= F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))


def vec_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding dimension as a double column; ``pos`` when label = 0."""
    emb = table(spark, sf_dir, "embeddings")
    feats = [F.element_at("embedding", i).cast("double").alias(f"f{i}") for i in range(1, VEC_DIMS + 1)]
    label = F.when(F.col("label") == 0, "pos").otherwise("neg")
    return emb.select("vec_id", label.alias("class"), *feats)


def vec_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_wide`` with NULL where ``md5('miss:<column>:<vec_id>')`` starts with ``0``."""
    w = vec_wide(spark, sf_dir)

    def masked(c: str):
        h = F.md5(F.concat_ws(":", F.lit("miss"), F.lit(c), F.col("vec_id").cast("string")))
        return F.when(F.substring(h, 1, 1) == "0", F.lit(None).cast("double")).otherwise(F.col(c)).alias(c)

    return w.select("vec_id", "class", *[masked(c) for c in VEC_FEATURES])
