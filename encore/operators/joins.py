"""Join shapes. Sides are left to adaptive execution unless their size is bounded by k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prepare the grouped side of a join, so that a hot key of the other side can be split.

    Adaptive execution reads a skewed partition in pieces only if both join inputs come
    straight from a shuffle of their own. The result of an aggregation (or join) by the same
    keys is used in place, without one. Passing the keys through an expression (the condition
    always holds) makes Spark shuffle this side again; it has one row per key, so that is
    cheap next to a third of all rows in one task.
    """
    always = F.hash(*keys) <= F.lit(2**31 - 1)
    return side.withColumns({k: F.when(always, F.col(k)) for k in keys})


def lookup_replace(
    df: DataFrame, column: str, table: DataFrame, key: str, value: str
) -> DataFrame:
    """Replace a value by its entry in a table; values without an entry become null.

    Where the table has a key twice, the greatest entry is used (files have no row order here).
    """
    entries = (
        table.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(value).alias("_entry"))
    )
    entries = splittable(entries, ["_key"])
    order = df.columns
    return (
        df.join(entries, F.col(column) == F.col("_key"), "left")
        .withColumn(column, F.col("_entry"))
        .select(*order)
    )


def keep_listed(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(splittable(keys.select(column), [column]), column, "left_semi")


def drop_listed(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is not in ``keys``; null keys stay."""
    return df.join(splittable(keys.select(column), [column]), column, "left_anti")


def coordinates(
    places: DataFrame, geolocation: DataFrame, zip_column: str, prefix: str, keep: list[str]
) -> DataFrame:
    """Attach coordinates by zip; places without any are dropped (so the join is inner)."""
    points = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )
    columns = [keep[0], f"{prefix}_lat", f"{prefix}_lng", *keep[1:]]
    return places.join(splittable(points, [zip_column]), zip_column).select(*columns).na.drop()
