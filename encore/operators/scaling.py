"""Scaling and encoding as plain columns (the fitted form is in ``plans.preprocessing``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.session import stored


def standard_scale(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0.

    Means and deviations come from one job over ``fit_on`` (by default the table itself).
    """
    stats = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        stats += [F.avg(value).alias(f"mean_{i}"), F.stddev_pop(value).alias(f"std_{i}")]
    fitted = (df if fit_on is None else fit_on).agg(*stats).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean = F.lit(fitted[f"mean_{i}"]).cast("double")
        scaled[c] = (F.col(c).cast("double") - mean) / F.lit(fitted[f"std_{i}"] or 1.0)
    return df.withColumns(scaled)


def category_slots(df: DataFrame, column: str) -> DataFrame:
    """(value, slot): one slot per distinct value, in alphabetical order.

    Values are sorted into ranges by a shuffle and written with the number of their range; a
    slot is the number of values in earlier ranges plus the place inside its own.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    placed = stored(
        values.repartitionByRange(column).withColumn("_range", F.spark_partition_id()), "slots"
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(  # a row per shuffle partition
        "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return placed.withColumn("_place", place).join(F.broadcast(sizes), "_range").select(
        column, (F.col("_before") + F.col("_place") - 1).cast("int").alias("slot")
    )


def one_hot_long(df: DataFrame, key: str, column: str, fit_on: DataFrame) -> DataFrame:
    """(key, slot): the slot that is 1 for each row; categories not seen in ``fit_on`` have
    none (slot null), which stands for all zeros."""
    slots = category_slots(fit_on, column)
    return df.join(slots, column, "left").select(key, "slot")


def align_columns(
    df: DataFrame, columns: Sequence[str], indicators: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Bring a table to a fixed list of columns.

    ``indicators`` maps an output name to (source column, value) and yields 1 or 0; a column
    the table does not have becomes 0; other columns are dropped.
    """
    def aligned(name: str):
        if name in indicators and indicators[name][0] in df.columns:
            source, value = indicators[name]
            return F.coalesce((F.col(source) == value).cast("int"), F.lit(0)).alias(name)
        if name in df.columns:
            return F.col(name)
        return F.lit(0).alias(name)

    return df.select(*[aligned(c) for c in columns])
