"""Nearest-neighbour imputation (fit on training rows, apply to any rows).

Each missing value becomes the mean of that column over the ``k`` nearest
training rows that have it (NaN-aware Euclidean distance, uniform weights,
ties broken by key).  When no training row has a defined distance to the
receiver, the column's training mean is used.  NaN counts as missing, like NULL.  Complete rows pass through
untouched and are never shuffled.  Donors are always the fitted training rows
with their original NULLs, also when scoring new data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.neighbors import DEFAULT_BLOCK_ROWS, knn_impute_candidates
from faultline.session import shared_table


def _any_null(features: Sequence[str]):
    """At least one feature is missing: one flat expression, whatever the width."""
    return F.exists(F.array(*[F.col(c) for c in features]), lambda x: x.isNull())


def _nan_to_null(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, NaN taken as missing like NULL."""
    feats = set(features)
    null = F.lit(None).cast("double")
    return df.select(*[F.nanvl(F.col(c).cast("double"), null).alias(c) if c in feats else F.col(c) for c in df.columns])


@dataclass
class KNNImputerModel:
    donors: DataFrame  # key + features of the training rows
    key: str
    features: list[str]
    means: dict[str, float]
    k: int = 5
    block_rows: int = DEFAULT_BLOCK_ROWS

    def transform(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Impute ``df``; ``key`` (default: the training key) must identify its rows."""
        feats = self.features
        key = key or self.key
        # Written once with its flag: both branches read it, and their filters name one
        # boolean column instead of an expression over every feature.
        flagged = shared_table(_nan_to_null(df, feats).withColumn("_fl_missing", _any_null(feats)), "rows")
        complete_rows = flagged.filter(~F.col("_fl_missing")).drop("_fl_missing")
        receivers = flagged.filter("_fl_missing").drop("_fl_missing")
        key_type = df.schema[key].dataType
        donors = self.donors.select(F.col(self.key).cast(key_type).alias(key), *feats)
        fill = [self.means[c] for c in feats]
        cand = knn_impute_candidates(receivers, donors, key, feats, self.k, self.block_rows, fill)
        # One map column -> value per receiver, not one column per feature: the plan
        # stays as small for 163 features as for 4.
        means = cand.groupBy("q_key", "column").agg(F.avg("value").alias("value"))
        filled = means.groupBy(F.col("q_key").alias("_fl_key")).agg(
            F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("_fl_imp")  # at most one entry per feature
        )
        filled = shared_table(filled, "filled")  # the search is done once, however often the result is read
        joined = receivers.join(filled, receivers[key] == filled["_fl_key"], "left")
        out_cols = [
            F.coalesce(F.col(c), F.try_element_at("_fl_imp", F.lit(c)), F.lit(self.means[c])).alias(c)
            if c in self.means
            else F.col(c)
            for c in df.columns
        ]
        return complete_rows.unionByName(joined.select(*out_cols))

    def save(self, spark: SparkSession, path: str) -> None:
        self.donors.write.mode("overwrite").parquet(f"{path}/donors")
        rows = [(c, self.means[c]) for c in self.features]
        spark.createDataFrame(rows, "column string, mean double").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/means"
        )
        spark.createDataFrame([(self.key, self.k)], "key string, k int").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/meta"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str]) -> "KNNImputerModel":
        meta = spark.read.parquet(f"{path}/meta").first()
        means = {r["column"]: r["mean"] for r in spark.read.parquet(f"{path}/means").collect()}  # per column
        donors = spark.read.parquet(f"{path}/donors")
        return cls(donors, meta["key"], list(features), means, meta["k"])


class KNNImputer:
    def __init__(self, n_neighbors: int = 5, block_rows: int = DEFAULT_BLOCK_ROWS):
        self.k = n_neighbors
        self.block_rows = block_rows

    def fit(self, df: DataFrame, key: str, features: Sequence[str]) -> KNNImputerModel:
        feats = list(features)
        # The donor rows are the fitted state; written once, then read by every block.
        donors = shared_table(_nan_to_null(df.select(key, *feats), feats), "donors")
        row = donors.agg(*[F.avg(c).alias(c) for c in feats]).first()  # one value per column
        empty = [c for c in feats if row[c] is None]
        if empty:
            raise ValueError(f"columns with no observed value in the training rows: {empty}")
        return KNNImputerModel(donors, key, feats, {c: float(row[c]) for c in feats}, self.k, self.block_rows)
