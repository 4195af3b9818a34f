"""Fit-on-train preprocessing: nearest-neighbour imputation then robust scaling.

Fitted on the training rows only and replayed unchanged on test and scoring
data.  The state is small (donor table reference, one mean and one
center/scale pair per column) and is saved next to the model of the same
version, so scoring never mixes a model with another run's preprocessor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faultline.operators.impute import KNNImputer, KNNImputerModel
from faultline.operators.neighbors import DEFAULT_BLOCK_ROWS
from faultline.operators.scaling import RobustScaler, RobustScalerModel
from faultline.session import shared_table


@dataclass
class PreprocessorModel:
    imputer: KNNImputerModel
    scaler: RobustScalerModel
    features: list[str]

    def transform(self, df: DataFrame, key: str | None = None) -> DataFrame:
        return self.scaler.transform(self.imputer.transform(df, key))

    def save(self, path: str) -> None:
        spark = self.imputer.donors.sparkSession
        self.imputer.save(spark, f"{path}/imputer")
        self.scaler.save(spark, f"{path}/scaler")

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str]) -> "PreprocessorModel":
        imp = KNNImputerModel.load(spark, f"{path}/imputer", features)
        sc = RobustScalerModel.load(spark, f"{path}/scaler", order=features)
        return cls(imp, sc, list(features))


class Preprocessor:
    def __init__(self, n_neighbors: int = 5, quantile_range=(25.0, 75.0), block_rows: int = DEFAULT_BLOCK_ROWS):
        self.imputer = KNNImputer(n_neighbors, block_rows)
        self.scaler = RobustScaler(quantile_range)

    def fit(self, df: DataFrame, key: str, features: Sequence[str]) -> PreprocessorModel:
        """Imputer donors are the raw training rows; the scaler is fitted on
        the imputed training rows (as a two-step pipeline does)."""
        return self.fit_transform(df, key, features)[0]

    def fit_transform(self, df: DataFrame, key: str, features: Sequence[str]) -> tuple[PreprocessorModel, DataFrame]:
        """The fitted model and ``df`` (all its columns) transformed by it; the training rows
        are imputed once, written, and read by the scaler's fit and by the result."""
        imp = self.imputer.fit(df, key, features)
        imputed = shared_table(imp.transform(df), "imputed")
        sc = self.scaler.fit(imputed, features)
        return PreprocessorModel(imp, sc, list(features)), sc.transform(imputed)


@dataclass
class SensorModel:
    """A fitted preprocessor and classifier used as one object: ``predict``
    transforms once, then predicts (0/1 in ``prediction``)."""

    preprocessor: PreprocessorModel
    model: object  # pyspark.ml.PipelineModel

    def predict(self, df: DataFrame, key: str, out: str = "prediction") -> DataFrame:
        from faultline.operators.training import predict

        return predict(self.model, self.preprocessor.transform(df, key), out)
