"""Logistic regression with a penalized intercept as a fitted stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.newton import Problem, fit_together


class RidgeLogistic(
    Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Minimizes sum(weight * log loss) + penalty / 2 * |coefficients and intercept|**2.

    Labels are 0 and 1; rows without label or features are left out. Row weights are those of
    classes: rows of a class with unlike weights are an error. A step is one scan.
    """

    penalty = Param(Params._dummy(), "penalty", "strength of the penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, maxIter=100,
                 penalty=1.0):
        super().__init__()
        self._setDefault(maxIter=100, penalty=1.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> RidgeLogisticModel:
        weighted = self.isDefined(self.weightCol)
        weight = F.col(self.getWeightCol()) if weighted else F.lit(1.0)
        rows = df.select(
            vector_to_array(self.getFeaturesCol()).alias("features"),
            F.col(self.getLabelCol()).cast("double").alias("label"),
            F.lit(0).alias("fold"),
            weight.cast("double").alias("weight"),
        ).where("features is not null and label is not null")
        found = rows.groupBy("label").agg(  # two rows
            F.count("*").alias("n"), F.min("weight").alias("least"),
            F.max("weight").alias("weight"), F.max(F.size("features")).alias("width"),
        ).limit(3).collect()
        if {r.label for r in found} - {0.0, 1.0}:
            raise ValueError("labels must be 0 or 1")
        if any(r.least != r.weight for r in found):
            raise ValueError("rows of a class have different weights")
        weights = {r.label: r.weight for r in found}
        problem = Problem(
            self.getOrDefault(self.penalty), (weights.get(0.0, 1.0), weights.get(1.0, 1.0)),
            penalize_intercept=True,
        )
        width = max((r.width for r in found), default=0)
        fit, = fit_together(
            rows.drop("weight"), [problem], width, {None: {r.label: r.n for r in found}},
            self.getMaxIter(),
        )
        *coefficients, intercept = (float(v) for v in fit.path[-1])
        return RidgeLogisticModel(
            featuresCol=self.getFeaturesCol(), weights=coefficients, intercept=intercept
        )


class RidgeLogisticModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction, as column expressions."""

    weights = Param(Params._dummy(), "weights", "coefficients", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", weights=None, intercept=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights))

    def _transform(self, df: DataFrame) -> DataFrame:
        weights = F.lit(self.getOrDefault(self.weights)).cast("array<double>")
        products = F.zip_with(
            vector_to_array(self.getFeaturesCol()), weights, lambda x, w: x * w
        )
        start = F.lit(self.getOrDefault(self.intercept))
        margin = F.aggregate(products, start, lambda total, product: total + product)
        up = 1 / (1 + F.exp(-margin))
        return df.withColumns({
            "rawPrediction": array_to_vector(F.array(-margin, margin)),
            "probability": array_to_vector(F.array(1 - up, up)),
            "prediction": (margin > 0).cast("double"),
        })
