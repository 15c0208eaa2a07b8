"""Grouped aggregates used by cleaning and feature jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_per_key(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Distinct values per non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(counted).alias(name))


def keys_with_many_values(df: DataFrame, key: str, counted: str, more_than: int) -> DataFrame:
    return distinct_per_key(df, key, counted, "n_values").where(F.col("n_values") > more_than)


def zip_spread(df: DataFrame, zip_column: str, lat: str, lng: str, city: str) -> DataFrame:
    """Extent, sample deviation and number of cities per zip."""
    return (
        df.where(F.col(zip_column).isNotNull())
        .groupBy(zip_column)
        .agg(
            F.min(lat).alias("lat_min"),
            F.max(lat).alias("lat_max"),
            F.stddev_samp(lat).alias("lat_std"),
            F.min(lng).alias("lng_min"),
            F.max(lng).alias("lng_max"),
            F.stddev_samp(lng).alias("lng_std"),
            F.countDistinct(city).alias("n_cities"),
        )
        .withColumns(
            {
                "lat_range": F.col("lat_max") - F.col("lat_min"),
                "lng_range": F.col("lng_max") - F.col("lng_min"),
            }
        )
    )


def zip_centroids(
    df: DataFrame, zip_column: str, lat: str, lng: str, max_range: float | None = None
) -> DataFrame:
    """Mean coordinates per zip; with ``max_range``, zips spread wider than that are left out.

    The spread is a statistic of the same group, so one aggregation does both.
    """
    grouped = (
        df.where(F.col(zip_column).isNotNull())
        .groupBy(zip_column)
        .agg(
            F.avg(lat).alias("_lat"),
            F.avg(lng).alias("_lng"),
            (F.max(lat) - F.min(lat)).alias("_lat_range"),
            (F.max(lng) - F.min(lng)).alias("_lng_range"),
        )
    )
    if max_range is not None:
        too_wide = (F.col("_lat_range") > max_range) | (F.col("_lng_range") > max_range)
        grouped = grouped.where(~F.coalesce(too_wide, F.lit(False)))
    return grouped.select(zip_column, F.col("_lat").alias(lat), F.col("_lng").alias(lng))


def payments_per_order(
    payments: DataFrame, types: Sequence[str], with_shares: bool = True
) -> DataFrame:
    """One row per order: amount (or share of the total) by payment type, total, installments.

    All figures come from one pass over the payments. Orders whose payments all lack a type
    have no amounts, only installments.
    """
    typed = F.col("payment_type").isNotNull()
    sums = {
        t: F.sum(F.when(F.col("payment_type") == t, F.col("payment_value"))) for t in types
    }
    grouped = (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            *[F.coalesce(s, F.lit(0.0)).alias(t) for t, s in sums.items()],
            F.coalesce(F.sum(F.when(typed, F.col("payment_value"))), F.lit(0.0)).alias(
                "total_spent"
            ),
            F.count_if(typed).alias("_typed"),
            F.coalesce(F.sum("payment_installments"), F.lit(0)).alias("installment"),
        )
    )
    has_amounts = F.col("_typed") > 0
    columns = {}
    for t in types:
        amount = F.col(t)
        if with_shares:
            amount = F.coalesce(F.try_divide(amount, F.col("total_spent")), F.lit(0.0))
        columns[t] = F.when(has_amounts, amount)
    columns["total_spent"] = F.when(has_amounts, F.col("total_spent"))
    return grouped.withColumns(columns).select(
        "order_id", *types, "total_spent", F.col("installment").cast("bigint").alias("installment")
    )


def pair_counts(items: DataFrame) -> DataFrame:
    """Rows per (order, product)."""
    return (
        items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("order_id", "product_id")
        .agg(F.count(F.lit(1)).alias("product_qty"))
    )


# Sums of money are compared as decimals: with doubles, three equal prices of 0.1 would have a
# mean above each of them.
EXACT = "decimal(18,6)"


def price_totals(items: DataFrame) -> DataFrame:
    """Exact price total and number of prices per product."""
    return (
        items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.sum(F.col("price").cast(EXACT)).alias("_price_sum"),
            F.count("price").alias("_price_n"),
        )
    )


def below_mean():
    """Flag of ``price`` below its product's mean, over columns of ``price_totals``."""
    scaled = F.col("price").cast(EXACT) * F.col("_price_n")
    return F.coalesce(scaled < F.col("_price_sum"), F.lit(False))


def repeat_rate_per_seller(orders: DataFrame) -> DataFrame:
    """Share of a seller's distinct buyers that are repeat buyers.

    Counting buyers in two steps (seller and buyer, then seller) needs no row expansion.
    """
    buyers = (
        orders.where(F.col("seller_id").isNotNull() & F.col("customer_unique_id").isNotNull())
        .groupBy("seller_id", "customer_unique_id")
        .agg(F.max(F.col("is_repeat_buyer").cast("int")).alias("_repeat"))
    )
    return buyers.groupBy("seller_id").agg(
        (
            F.coalesce(F.sum("_repeat"), F.lit(0)).cast("double") / F.count(F.lit(1))
        ).alias("seller_repeat_buyer_rate")
    )
