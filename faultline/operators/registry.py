"""Versioned model registry: saved model directories plus a registry table.

Layout under ``root`` (any Hadoop-compatible URI):
``version=<epoch>/model`` (Spark ML ``PipelineModel``: imputer, scaler and trees as one
object), ``version=<epoch>/preprocessor`` (only where a preprocessor is saved
apart) and ``_registry`` (Parquet, one row per promoted version).  "Latest" is the
largest version number (recency, not score), as in the reference; model and
preprocessor always come from the same version.

A version is claimed before anything is written under it, by creating its marker file; the
file system lets one writer create it, so two promotions at one time get two versions.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources.reports import claim, path_exists, read_or_empty

REGISTRY_SCHEMA = "version long, model_path string, preprocessor_path string, created_at timestamp, f1_score double, roc_auc_score double"


@dataclass
class ModelRegistry:
    spark: SparkSession
    root: str

    @property
    def table_path(self) -> str:
        return f"{self.root.rstrip('/')}/_registry"

    def version_dir(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/version={version}"

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, self.table_path, REGISTRY_SCHEMA)

    def latest(self) -> DataFrame:
        """One row (or none): the entry with the largest version."""
        e = self.entries()
        return e.agg(
            F.max("version").alias("version"),
            F.max_by("model_path", "version").alias("model_path"),
            F.max_by("preprocessor_path", "version").alias("preprocessor_path"),
        ).filter(F.col("version").isNotNull())

    def has_model(self) -> bool:
        """A version is registered and its model folder is there."""
        row = self.latest().first()
        if row is None:
            return False
        return path_exists(self.spark, f"{row['model_path']}/metadata")

    def newest_run(self) -> DataFrame:
        """One row (or none): the entry created last."""
        e = self.entries()
        return e.agg(
            F.max_by("version", "created_at").alias("version"),
            F.max_by("preprocessor_path", "created_at").alias("preprocessor_path"),
        ).filter(F.col("version").isNotNull())

    def best_model_path(self) -> str:
        row = self.latest().first()
        if row is None:
            raise FileNotFoundError(f"no model registered under {self.root}")
        return row["model_path"]

    def load_latest(self) -> tuple[PipelineModel, str | None, int]:
        """The model, the path of a preprocessor saved apart (null if the model has it in itself), the version."""
        row = self.latest().first()
        if row is None:
            raise FileNotFoundError(f"no model registered under {self.root}")
        return PipelineModel.load(row["model_path"]), row["preprocessor_path"], row["version"]

    def promote(self, model: PipelineModel, save_preprocessor=None, scores: dict | None = None, version: int | None = None) -> int:
        """Save the model under a new version and append the registry row.
        ``save_preprocessor(path)`` writes a fitted state that the model does not hold itself."""
        version = version or int(time.time())
        newest = self.entries().agg(F.max("version")).first()[0]
        version = max(version, (newest or 0) + 1)
        while not claim(self.spark, f"{self.root.rstrip('/')}/_claims", str(version)):
            version += 1
        vdir = self.version_dir(version)
        model.write().overwrite().save(f"{vdir}/model")
        if save_preprocessor is not None:
            save_preprocessor(f"{vdir}/preprocessor")
        apart = f"{vdir}/preprocessor" if save_preprocessor is not None else None
        scores = scores or {}
        row = [(version, f"{vdir}/model", apart, None, scores.get("f1_score"), scores.get("roc_auc_score"))]
        self.spark.createDataFrame(row, REGISTRY_SCHEMA).withColumn("created_at", F.current_timestamp()).coalesce(
            1
        ).write.mode("append").parquet(self.table_path)
        return version
