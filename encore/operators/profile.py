"""Table profiles: nulls, duplicates, summary statistics, histograms."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.times import hours_apart
from encore.operators.filters import any_null
from encore.operators.order_stats import long_format, quantile, quantiles, value_frequencies
from encore.operators.ranking import value_counts


def null_profile(df: DataFrame) -> DataFrame:
    """One row: rows with a null (count and percent) and nulls per column, in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(any_null(df.columns)).alias("rows_with_null"),
        *counts,
    ).withColumn(
        "rows_with_null_pct",
        F.coalesce(F.try_divide(F.col("rows_with_null") * 100.0, F.col("n_rows")), F.lit(0.0)),
    )


def _copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows beyond the first of their kind (count and percent)."""
    return (
        _copies(df, columns or df.columns)
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        )
        .withColumn(
            "duplicate_pct",
            F.coalesce(F.try_divide(F.col("duplicate_rows") * 100.0, F.col("n_rows")), F.lit(0.0)),
        )
    )


def duplicated_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All members of groups of duplicates.

    Groups are counted first and their keys joined back, which adaptive execution can split
    when one group is very large; a window would put the group into one task.
    """
    columns = list(columns or df.columns)
    repeated = _copies(df, columns).where(F.col("_copies") > 1)
    keys = repeated.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns)]
    return df.join(keys, same, "left_semi")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    values = long_format(df, columns or numeric_columns(df)).where(F.col("value").isNotNull())
    moments = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles(values, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["column"])
    return moments.join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def box_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles and outer percentiles, one row per numeric column."""
    values = long_format(df, columns or numeric_columns(df))
    wanted = {"q1": 0.25, "q3": 0.75, "p01": 0.01, "p99": 0.99}
    return quantiles(values, "value", wanted, by=["column"])


def table_info(df: DataFrame) -> DataFrame:
    """Name, type, non-null count per column and the row count, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(dtype).alias("type"),
            F.col(f"_n{i}").alias("non_null"),
            F.col("_rows").alias("n_rows"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*entries)))


_ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
            T.TimestampNTZType)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The table with counts and extremes that are taken while it is next written.

    The result belongs to a new session with the same settings: where a session has observed
    anything, Spark 4.1.2 cannot send a logistic model fitted in it to tasks.
    """
    spark = df.sparkSession
    apart = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            apart.conf.set(key, value)
    view = f"observed_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    rows = apart.table(f"global_temp.{view}")
    spark.catalog.dropGlobalTempView(view)
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        wanted.append(F.count(column).alias(f"n{i}"))
        if isinstance(field.dataType, _ORDERED):
            wanted += [F.min(column).cast("string").alias(f"lo{i}"),
                       F.max(column).cast("string").alias(f"hi{i}")]
    seen = Observation()
    return rows.observe(seen, *wanted), seen


def observed_info(df: DataFrame, seen: Observation) -> DataFrame:
    """One row per column of a written table: type, values, nulls, extremes as text, rows.

    Columns without an order, as arrays, have no extremes; nor have columns without values.
    """
    found = seen.get
    rows = found["rows"]
    return df.sparkSession.createDataFrame(
        [
            (i, name, dtype, found[f"n{i}"], rows - found[f"n{i}"], found.get(f"lo{i}"),
             found.get(f"hi{i}"), rows)
            for i, (name, dtype) in enumerate(df.dtypes)
        ],
        "position int, column string, type string, non_null long, nulls long, minimum string, "
        "maximum string, n_rows long",
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts between minimum and maximum: (bin, lower, upper, n, density).

    There are always ``bins`` rows. The maximum is in the last bin. If all values are equal the
    range reaches half a unit to both sides; without values it goes from 0 to 1. ``density`` is
    the share of the values per unit, so the areas of all bins sum to 1 (null without values).
    """
    ends = df.agg(
        F.min(column).cast("double").alias("lo"),
        F.max(column).cast("double").alias("hi"),
        F.count(column).alias("n"),
    ).first()
    lo, hi, rows = ends["lo"], ends["hi"], ends["n"]
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    share = (F.col(column) - F.lit(lo)) / F.lit(hi - lo)
    place = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    n = F.coalesce("n", F.lit(0))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        n.alias("n"),
        (n / F.lit(float(rows * width) or None)).alias("density"),
    )


def duration_summary(df: DataFrame, start: str, end: str) -> DataFrame:
    """Mean, median and most frequent (lowest on ties) distance in hours."""
    hours = df.select(hours_apart(F.col(start), F.col(end)).alias("hours")).where(
        F.col("hours").isNotNull()
    )
    commonest = value_frequencies(hours, "hours").agg(
        F.min(F.struct((-F.col("_n")).alias("rank"), "_v"))["_v"].alias("mode")
    )
    return hours.agg(F.avg("hours").alias("mean_hours")).select(
        "mean_hours",
        F.lit(quantile(hours, "hours", 0.5)).cast("double").alias("median_hours"),
        commonest.scalar().alias("mode_hours"),
    )


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value as text, in text order."""
    text = df.select(F.col(column).cast("string").alias(column))
    return value_counts(text, column).orderBy(column)
