"""Caps and flags whose bound is a statistic of the column.

The statistic is computed by a job of its own and enters the expression as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.times import micros
from encore.operators.filters import true_only
from encore.operators.order_stats import column_quantiles, quantile


def _bound_literal(bound: float | None) -> Column:
    """The bound, or null for a column without values (then nothing compares as beyond it)."""
    return F.lit(bound).cast("double")


def upper_bounded(value: Column, bound: float | None) -> Column:
    """Values above the bound become the bound; null stays null (``least`` would not)."""
    limit = _bound_literal(bound)
    return F.when(value > limit, limit).otherwise(value)


def lower_bounded(value: Column, bound: float | None) -> Column:
    limit = _bound_literal(bound)
    return F.when(value < limit, limit).otherwise(value)


def cap_at_percentile(df: DataFrame, columns: list[str], percent: float) -> DataFrame:
    """Cap each column at its own percentile, given in percent (99.9, not 0.999)."""
    if not 0 <= percent <= 100:
        raise ValueError(f"a percentile lies between 0 and 100, not {percent}")
    bounds = column_quantiles(df, columns, {"cap": percent / 100})
    return df.withColumns(
        {c: upper_bounded(F.col(c), bounds.get(c, {}).get("cap")) for c in columns}
    )


def clip_at_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Cap one column at a quantile given as a fraction."""
    return df.withColumn(column, upper_bounded(F.col(column), quantile(df, column, p)))


def cap_outliers(
    df: DataFrame,
    column: str,
    lower: float | bool | None = None,
    upper: float | bool | None = None,
) -> DataFrame:
    """General cap. A bound is a number, ``True`` for the 1st/99th percentile, or nothing."""
    wanted = {}
    if lower is True:
        wanted["lower"] = 0.01
    if upper is True:
        wanted["upper"] = 0.99
    found = column_quantiles(df, [column], wanted).get(column, {}) if wanted else {}
    # bool is a number in Python, so it is told apart before anything is used as a bound.
    low = found.get("lower") if isinstance(lower, bool) else lower
    high = found.get("upper") if isinstance(upper, bool) else upper
    value = F.col(column)
    if low is not None:
        value = lower_bounded(value, float(low))
    if high is not None:
        value = upper_bounded(value, float(high))
    return df.withColumn(column, value)


def above_iqr(df: DataFrame, column: str, reach: float = 1.5) -> Column:
    """True where the value exceeds q3 + reach * (q3 - q1) of the whole column."""
    found = column_quantiles(df, [column], {"q1": 0.25, "q3": 0.75}).get(column)
    bound = found["q3"] + reach * (found["q3"] - found["q1"]) if found else None
    return true_only(F.col(column) > _bound_literal(bound))


def above_quantile_multiple(
    df: DataFrame, column: str, p: float = 0.75, factor: float = 1.5
) -> Column:
    return true_only(F.col(column) > _bound_literal(quantile(df, column, p)) * factor)


def at_least_quantile(df: DataFrame, column: str, p: float) -> Column:
    return true_only(F.col(column) >= _bound_literal(quantile(df, column, p)))


def fill_by_median_offset(df: DataFrame, target: str, anchor: str) -> DataFrame:
    """Fill a missing timestamp by ``anchor`` minus the median of ``anchor - target``."""
    offset = quantile(df, micros(F.col(anchor)) - micros(F.col(target)), 0.5)
    if offset is None:
        return df
    estimate = F.timestamp_micros(micros(F.col(anchor)) - F.lit(int(offset)))
    return df.withColumn(target, F.coalesce(F.col(target), estimate))
