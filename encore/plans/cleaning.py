"""Cleaning jobs, one per raw table, and the labelled order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.text import identifier
from encore.functions.times import parse_timestamp, within_years
from encore.operators.aggregates import distinct_per_key, zip_centroids
from encore.operators.caps import cap_at_percentile, clip_at_quantile, fill_by_median_offset
from encore.operators.filters import (
    fill_missing,
    inside_box,
    keep_unless_equal,
    keep_unless_in,
    standardize_location,
)
from encore.operators.joins import splittable
from encore.operators.ranking import first_per_key
from encore.plans.settings import DEFAULTS, Settings
from encore.session import stored


def clean_orders(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Parse dates and null those outside the years, drop unpaid orders, estimate missing
    deliveries by the median offset of the paid ones, require an approval."""
    kept = orders.drop(*settings.order_drop)
    dates = [c for c in settings.order_dates if c in kept.columns]
    # Two steps, so that a text is parsed once although its value is looked at several times.
    parsed = kept.withColumns({c: parse_timestamp(F.col(c)) for c in dates})
    clipped = parsed.withColumns(
        {c: within_years(F.col(c), settings.first_year, settings.last_year) for c in dates}
    )
    paid = keep_unless_in(clipped, "order_status", settings.unpaid_statuses)
    filled = fill_by_median_offset(
        paid, "order_delivered_customer_date", "order_estimated_delivery_date"
    )
    return filled.where(F.col("order_approved_at").isNotNull())


def clean_items(items: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return cap_at_percentile(
        items.drop(*settings.item_drop), settings.item_capped, settings.item_cap_percent
    )


def clean_payments(payments: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Drop one payment type, then clip installments at a quantile of what is left."""
    known = keep_unless_equal(payments, "payment_type", settings.payment_unwanted)
    return clip_at_quantile(
        known, "payment_installments", settings.installment_quantile
    ).drop(*settings.payment_drop)


def clean_customers(customers: DataFrame) -> DataFrame:
    return standardize_location(
        customers, "customer_zip_code_prefix", "customer_city", "customer_state"
    )


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return standardize_location(sellers, "seller_zip_code_prefix", "seller_city", "seller_state")


def format_customers(customers: DataFrame) -> DataFrame:
    """Clean locations and trimmed text ids."""
    ids = ["customer_id", "customer_unique_id"]
    return clean_customers(customers).withColumns({c: identifier(F.col(c)) for c in ids})


def format_sellers(sellers: DataFrame) -> DataFrame:
    return clean_sellers(sellers).withColumn("seller_id", identifier(F.col("seller_id")))


def standardized_points(geolocation: DataFrame) -> DataFrame:
    """Standardized locations without exact duplicates."""
    return standardize_location(
        geolocation, "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    ).distinct()


def format_geolocation(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates per zip, noisy zips included."""
    return zip_centroids(
        standardized_points(geolocation),
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
    )


def clean_geolocation(geolocation: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Mean coordinates per zip from points inside the box; zips spread too wide are dropped."""
    inside = inside_box(
        geolocation, "geolocation_lat", "geolocation_lng", settings.lat_range, settings.lng_range
    )
    return zip_centroids(
        standardized_points(inside),
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        settings.max_zip_range,
    )


def clean_reviews(reviews: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return reviews.drop(*settings.review_drop)


def clean_products(products: DataFrame) -> DataFrame:
    """Fill descriptive columns, require the dimensions, fix names and types."""
    described = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
    filled = fill_missing(
        products, {"product_category_name": "unknown", **{c: 0.0 for c in described}}
    )
    sized = filled.na.drop(
        subset=["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    )
    return sized.withColumns({c: F.col(c).cast("int") for c in described}).withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )


# Files have no row order on a cluster, so "first item" needs an explicit one.
ITEM_ORDER = ["order_item_id", "product_id", "seller_id"]


def first_items(items: DataFrame) -> DataFrame:
    """Product and seller of the first item per order."""
    return first_per_key(items, "order_id", ITEM_ORDER, ["product_id", "seller_id"])


def repeat_labels(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their person, the person's number of orders and the repeat flag."""
    persons = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id", "left"
    )
    persons = stored(persons, "persons")  # read twice; the joins before are not made again
    per_person = distinct_per_key(
        persons, "customer_unique_id", "order_id", "num_orders"
    ).withColumn("is_repeat_buyer", F.col("num_orders") > 1)
    per_person = splittable(per_person, ["customer_unique_id"])
    return persons.join(per_person, "customer_unique_id", "left")


def mega_id_labels(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """One labelled row per order that has a known person and an item.

    Rows lacking one of these are dropped at the end, so the join that brings items is inner.
    """
    labelled = repeat_labels(orders, customers)
    return (
        labelled.join(first_items(items), "order_id")
        .select(
            "order_id", "customer_id", "customer_unique_id", "product_id", "seller_id",
            "num_orders", "is_repeat_buyer",
        )
        .na.drop()
    )
