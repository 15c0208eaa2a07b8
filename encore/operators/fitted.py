"""Statistics of a table as fitted stages: learned on one table, stored, applied to others.

``PercentileCap`` and ``MedianOffsetFill`` are estimators whose models hold the statistic as
a parameter, so they are saved and loaded like every stage and fit into a ``Pipeline``.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.times import micros
from encore.operators.caps import lower_bounded, upper_bounded
from encore.operators.order_stats import column_quantiles, quantile


class _Percentiles(HasInputCols):
    """Percentiles, given in percent, below and above which values are capped (none: not)."""

    lower = Param(Params._dummy(), "lower", "percentile of the lower cap", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "percentile of the upper cap", TypeConverters.toFloat)


class PercentileCap(
    _Percentiles, Estimator, DefaultParamsReadable, DefaultParamsWritable
):
    """Learns exact percentiles of columns; its model caps values at them.

    A column without values has no bounds and stays as it is; null stays null.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, lower=None, upper=None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        for name in ("lower", "upper"):
            if not 0 <= given.get(name, 0) <= 100:
                raise ValueError(f"a percentile lies between 0 and 100, not {given[name]}")
        self._set(**given)

    def _fit(self, df: DataFrame) -> PercentileCapModel:
        columns = self.getInputCols()
        wanted = {
            p.name: self.getOrDefault(p) / 100 for p in (self.lower, self.upper)
            if self.isDefined(p)
        }
        found = column_quantiles(df, columns, wanted) if wanted else {}
        bounds = {
            f"{name}Bounds": [found.get(c, {}).get(name, math.nan) for c in columns]
            for name in ("lower", "upper")
        }
        return PercentileCapModel(inputCols=columns, **bounds)


class PercentileCapModel(HasInputCols, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Caps columns at stored bounds; NaN is no bound."""

    lowerBounds = Param(
        Params._dummy(), "lowerBounds", "lower bound per column", TypeConverters.toListFloat
    )
    upperBounds = Param(
        Params._dummy(), "upperBounds", "upper bound per column", TypeConverters.toListFloat
    )

    @keyword_only
    def __init__(self, *, inputCols=None, lowerBounds=None, upperBounds=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        capped = {}
        columns = self.getInputCols()
        ends = zip(
            columns, self.getOrDefault(self.lowerBounds), self.getOrDefault(self.upperBounds)
        )
        for column, low, high in ends:
            value = F.col(column)
            if not math.isnan(low):
                value = lower_bounded(value, low)
            if not math.isnan(high):
                value = upper_bounded(value, high)
            capped[column] = value
        return df.withColumns(capped)


class _Offset(Params):
    """Two timestamp columns."""

    target = Param(Params._dummy(), "target", "column to fill", TypeConverters.toString)
    anchor = Param(Params._dummy(), "anchor", "column to count from", TypeConverters.toString)


class MedianOffsetFill(_Offset, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of ``anchor - target``; its model fills a missing target by the anchor
    less that. Without a row that has both, nothing is filled."""

    @keyword_only
    def __init__(self, *, target=None, anchor=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> MedianOffsetFillModel:
        target, anchor = self.getOrDefault(self.target), self.getOrDefault(self.anchor)
        offset = quantile(df, micros(F.col(anchor)) - micros(F.col(target)), 0.5)
        return MedianOffsetFillModel(
            target=target, anchor=anchor, offset=math.nan if offset is None else float(offset)
        )


class MedianOffsetFillModel(_Offset, Model, DefaultParamsReadable, DefaultParamsWritable):
    offset = Param(Params._dummy(), "offset", "microseconds", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, target=None, anchor=None, offset=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        offset = self.getOrDefault(self.offset)
        if math.isnan(offset):
            return df
        target, anchor = self.getOrDefault(self.target), self.getOrDefault(self.anchor)
        estimate = F.timestamp_micros(micros(F.col(anchor)) - F.lit(int(offset)))
        return df.withColumn(target, F.coalesce(F.col(target), estimate))
