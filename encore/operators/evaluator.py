"""The exact curve areas as an evaluator for model selection."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.metrics import curve_areas, threshold_table

METRICS = ("average_precision", "roc_auc", "prc_auc")


class RankingEvaluator(Evaluator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Average precision, ROC area or PR area of a score, exact also where scores tie.

    The score is a number or a vector (probability, raw prediction), of which the entry of
    class 1 counts. Rows without label or score are left out. A part in which a metric is not
    defined, as without positives, counts 0, so means over folds are always numbers.
    """

    scoreCol = Param(Params._dummy(), "scoreCol", "number or vector", TypeConverters.toString)
    metricName = Param(Params._dummy(), "metricName", " | ".join(METRICS), TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol="label", scoreCol="probability",
                 metricName="average_precision"):
        super().__init__()
        if metricName not in METRICS:
            raise ValueError(f"the metric is one of {METRICS}, not {metricName}")
        self._setDefault(scoreCol="probability", metricName="average_precision")
        self._set(**self._input_kwargs)

    def isLargerBetter(self) -> bool:
        return True

    def _evaluate(self, dataset: DataFrame) -> float:
        name, score = self.getLabelCol(), F.col(self.getOrDefault(self.scoreCol))
        if isinstance(dataset.select(score).schema[0].dataType, VectorUDT):
            score = F.get(vector_to_array(score), F.lit(1))
        rows = dataset.select(F.col(name).alias("label"), score.alias("score"))
        areas = curve_areas(threshold_table(rows, "label", "score")).first()
        return areas[self.getOrDefault(self.metricName)] or 0.0
