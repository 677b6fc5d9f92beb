"""A user-written estimator in the Spark ML form: parameters, fit, and a model with transform."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRegParam, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.linear import gd_linear


class _DescentParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasRegParam, HasStepSize):
    """Shared by the estimator and its model."""


class DescentRegressor(Estimator, _DescentParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression by batch gradient descent (see ``gd_linear``)."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, regParam=0.0, stepSize=0.01):
        super().__init__()
        self._setDefault(maxIter=100, regParam=0.0, stepSize=0.01)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "DescentModel":
        features, label = self.getFeaturesCol(), self.getLabelCol()
        width = dataset.select(F.size(vector_to_array(features))).first()[0]
        names = [f"x{i}" for i in range(width)]
        wide = dataset.select(F.col(label).alias("_y"), vector_to_array(features).alias("_v")).select(
            "_y", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)]
        )
        fitted = gd_linear(wide, "_y", names, self.getStepSize(), self.getMaxIter() + 1, self.getRegParam())
        model = DescentModel(theta=[float(t) for t in fitted.history[-1][2]])
        model.history = [loss for _, loss, _ in fitted.history]
        return self._copyValues(model)


class DescentModel(Model, _DescentParams, DefaultParamsReadable, DefaultParamsWritable):
    theta = Param(Params._dummy(), "theta", "bias and weights", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, theta=None):
        super().__init__()
        self.history: list[float] = []
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bias, *weights = self.getOrDefault(self.theta)
        products = F.zip_with(
            vector_to_array(self.getFeaturesCol()), F.array(*[F.lit(w) for w in weights]), lambda a, b: a * b
        )
        return dataset.withColumn(self.getPredictionCol(), F.aggregate(products, F.lit(bias), lambda s, p: s + p))
