"""Imputer, scaler and boosted trees as Spark ML stages.

Each estimator and model keeps its parameters as ML params and can be written and read, so
``Pipeline([imputer, scaler, trees]).fit(train)`` is one ``PipelineModel`` that preprocesses
and predicts, and is saved and loaded as one object.  The fitted state lies beside the
stage's metadata: donors and means, one row per column, one row per tree.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from faultline.operators import boosting
from faultline.operators.boosting import BoostedTrees, Tree
from faultline.operators.impute import KNNImputer, KNNImputerModel
from faultline.operators.scaling import RobustScaler, RobustScalerModel


class _StateWriter(MLWriter):
    def __init__(self, instance: "_StateModel") -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance._save_state(self.sparkSession, f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        instance._load_state(self.sparkSession, f"{path}/state")
        return instance


class _StateModel(Model, HasInputCols, MLReadable, MLWritable):
    """A model with ``state`` of its own, besides its params."""

    state = None

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.state = self.state
        return out


# -- imputer -------------------------------------------------------------------------------
class _ImputerParams(HasInputCols):
    keyCol = Param(Params._dummy(), "keyCol", "column that identifies a row", TypeConverters.toString)
    nNeighbors = Param(Params._dummy(), "nNeighbors", "donors whose mean fills a value", TypeConverters.toInt)


class NeighborImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, keyCol=None, nNeighbors=5):
        super().__init__()
        self._setDefault(nNeighbors=5)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NeighborImputerModel":
        state = KNNImputer(self.getOrDefault("nNeighbors")).fit(dataset, self.getOrDefault("keyCol"), self.getInputCols())
        return self._copyValues(NeighborImputerModel(state))


class NeighborImputerModel(_StateModel, _ImputerParams):
    def __init__(self, state: KNNImputerModel | None = None) -> None:
        super().__init__()
        self._setDefault(nNeighbors=5)
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.state.transform(dataset, self.getOrDefault("keyCol"))

    def _save_state(self, spark, path: str) -> None:
        self.state.save(spark, path)

    def _load_state(self, spark, path: str) -> None:
        self.state = KNNImputerModel.load(spark, path, self.getInputCols())


# -- scaler --------------------------------------------------------------------------------
class _ScalerParams(HasInputCols):
    lower = Param(Params._dummy(), "lower", "lower quantile in percent", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile in percent", TypeConverters.toFloat)


class QuantileScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, lower=25.0, upper=75.0):
        super().__init__()
        self._setDefault(lower=25.0, upper=75.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "QuantileScalerModel":
        state = RobustScaler((self.getOrDefault("lower"), self.getOrDefault("upper"))).fit(dataset, self.getInputCols())
        return self._copyValues(QuantileScalerModel(state))


class QuantileScalerModel(_StateModel, _ScalerParams):
    def __init__(self, state: RobustScalerModel | None = None) -> None:
        super().__init__()
        self._setDefault(lower=25.0, upper=75.0)
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.state.transform(dataset)

    def _save_state(self, spark, path: str) -> None:
        self.state.save(spark, path)

    def _load_state(self, spark, path: str) -> None:
        self.state = RobustScalerModel.load(spark, path, order=self.getInputCols())


# -- trees ---------------------------------------------------------------------------------
class _TreeParams(HasInputCols, HasLabelCol, HasPredictionCol):
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability of class 1 ('': none)", TypeConverters.toString)
    treeParams = Param(Params._dummy(), "treeParams", "parameters of the trees as JSON", TypeConverters.toString)


class BoostedTreesClassifier(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """``treeParams``: a JSON object with names of ``boosting.DEFAULTS``."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", predictionCol="prediction", probabilityCol="", treeParams="{}"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", probabilityCol="", treeParams="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        params = json.loads(self.getOrDefault("treeParams"))
        state = boosting.fit(dataset, self.getInputCols(), self.getLabelCol(), params)
        return self._copyValues(BoostedTreesModel(state))


class BoostedTreesModel(_StateModel, _TreeParams):
    def __init__(self, state: BoostedTrees | None = None) -> None:
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", probabilityCol="", treeParams="{}")
        self.state = state
        if state is not None:
            self._set(inputCols=state.features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.state.predict(dataset, self.getPredictionCol(), self.getOrDefault("probabilityCol") or None)

    def _save_state(self, spark, path: str) -> None:
        head = json.dumps({"features": self.state.features, "cuts": self.state.cuts, "start": self.state.start})
        spark.createDataFrame([(head,)], "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")
        rows = [(i, t.to_json()) for i, t in enumerate(self.state.trees)]
        spark.createDataFrame(rows, "tree int, nodes string").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    def _load_state(self, spark, path: str) -> None:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()  # one row per tree
        self.state = BoostedTrees(head["features"], head["cuts"], [Tree.from_json(r["nodes"]) for r in rows], head["start"])


def sensor_pipeline(preprocessor, model: PipelineModel, key: str) -> PipelineModel:
    """A fitted preprocessor (``preprocess.PreprocessorModel``) and a fitted model as one ``PipelineModel``.
    ``key`` is the column that identifies rows when it is applied."""
    imputer = NeighborImputerModel(preprocessor.imputer)
    imputer._set(inputCols=preprocessor.features, keyCol=key, nNeighbors=preprocessor.imputer.k)
    scaler = QuantileScalerModel(preprocessor.scaler)
    scaler._set(inputCols=preprocessor.features)
    return PipelineModel([imputer, scaler, *model.stages])
