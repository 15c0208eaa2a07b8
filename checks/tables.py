"""Queries over tables: sources, row operators, statistics, joins, aggregates, jobs."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import SETTINGS, Fixture
from checks.twins import clipped, days, haversine, stamp
from encore.functions import sentiment, text, times
from encore.functions.geo import haversine_km
from encore.operators import (
    aggregates, caps, filters, fitted, joins, order_stats, profile, ranking,
)
from encore.plans import cleaning, features
from encore.session import scratch_folder, stored
from encore.sources.catalog import Catalog, read_csv, write_csv
from encore.sources.schemas import RAW

Query = Callable[[Fixture], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(key: str, query: Query, sql: str | None = None, doubles: str = "", stamps: str = ""):
    """Register a query and its SQL; the named columns are rounded or printed on the SQL side."""
    assert key not in QUERIES, key
    QUERIES[key] = query
    if sql is None:
        return
    changes = [f"round({c}, 6) + 0.0 as {c}" for c in doubles.split()]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in stamps.split()]
    SQL[key] = f"select * replace ({', '.join(changes)}) from ({sql})" if changes else sql


WS = text.WHITESPACE
ORDER_STAMPS = (
    "order_purchase_timestamp order_approved_at order_delivered_customer_date "
    "order_estimated_delivery_date"
)
BAD_STATUS = "('canceled', 'created', 'invoiced', 'unavailable')"

# --------------------------------------------------------------------------- sources and sinks


def _csv_round_trip(f: Fixture) -> DataFrame:
    path = scratch_folder(f.spark, "reviews_csv")
    write_csv(
        f.reviews.select(
            "review_id", "order_id", "review_score", F.lit(None).cast("string").alias("review_comment_title"),
            "review_comment_message",
        ),
        path,
    )
    back = read_csv(f.spark, path, RAW["reviews"], multi_line=True)
    return back.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "review_score",
        F.md5("review_comment_message").alias("comment_hash"),
    )


register(
    "scan_csv", _csv_round_trip,
    "select order_id, review_score, md5(review_comment_message) as comment_hash from fx_reviews",
)


def _parquet_round_trip(f: Fixture) -> DataFrame:
    catalog = Catalog(f.spark, scratch_folder(f.spark, "layers"))
    return catalog.save(f.clean_items, "clean_items")


ORDER_LAYERS = {
    "clean_orders": "clean_orders", "clean_items": "clean_items",
    "clean_payments": "clean_payments", "mega_id_labels": "labels",
}


def _bucketed_facts(f: Fixture) -> DataFrame:
    """What items take from their orders, from layers in buckets by order."""
    catalog = Catalog(f.spark, scratch_folder(f.spark, "buckets"), buckets=16)
    layers = {name: catalog.save(f.stored(view), name) for name, view in ORDER_LAYERS.items()}
    facts = features.order_facts(
        layers["clean_orders"], layers["clean_payments"], layers["mega_id_labels"], SETTINGS
    )
    return layers["clean_items"].select("order_id", "order_item_id").join(facts, "order_id").select(
        "order_id", "order_item_id", "customer_id", "deli_duration_exp", "deli_duration_paid",
        "is_repeat_buyer", "total_spent",
    )


register(
    "bucketed_layers", _bucketed_facts,
    f"""select i.order_id, i.order_item_id, l.customer_id,
 {days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} as deli_duration_exp,
 {days('o.order_delivered_customer_date', 'o.order_approved_at')} as deli_duration_paid,
 l.is_repeat_buyer, p.total_spent
 from tw_clean_items i join tw_clean_orders o on i.order_id = o.order_id
 join tw_labels l on i.order_id = l.order_id join tw_order_payments p on i.order_id = p.order_id""",
    "total_spent",
)


def _layer_summary(f: Fixture) -> DataFrame:
    """Counts and extremes taken while a layer is written."""
    catalog = Catalog(f.spark, scratch_folder(f.spark, "layers"), summaries=True)
    catalog.save(f.clean_items.select("order_id", "order_item_id", "seller_id"), "clean_items")
    catalog.save(f.reviews, "clean_reviews")
    found = [
        catalog.summary(name).select(F.lit(name).alias("layer"), "*")
        for name in ("clean_items", "clean_reviews")
    ]
    return found[0].unionByName(found[1]).where(
        F.col("column").isin("order_id", "order_item_id", "seller_id", "review_score",
                             "review_comment_message")
    ).select("layer", "column", "non_null", "nulls", "minimum", "maximum", "n_rows")


register(
    "layer_summary", _layer_summary,
    " union all ".join(
        f"select '{layer}' as layer, '{c}' as \"column\", count({c}) as non_null, "
        f"count(*) - count({c}) as nulls, cast(min({c}) as varchar) as minimum, "
        f"cast(max({c}) as varchar) as maximum, count(*) as n_rows from {view}"
        for layer, view, columns in [
            ("clean_items", "tw_clean_items", ["order_id", "order_item_id", "seller_id"]),
            ("clean_reviews", "fx_reviews",
             ["order_id", "review_score", "review_comment_message"]),
        ]
        for c in columns
    ),
)
register("sink_parquet", _parquet_round_trip, "select * from tw_clean_items",
         "price freight_value")
register(
    "scan_parquet",
    lambda f: f.raw("lineitem").where(F.col("l_returnflag") == "R")
    .select("l_orderkey", "l_partkey", "l_quantity"),
    "select l_orderkey, l_partkey, l_quantity from lineitem where l_returnflag = 'R'", "l_quantity",
)


def _cached(f: Fixture) -> DataFrame:
    """A result used twice is persisted, used, and freed."""
    from pyspark import StorageLevel

    items = f.clean_items.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if items.isEmpty():
            raise ValueError("there are no items")
        return stored(
            items.groupBy("seller_id")
            .agg(F.count(F.lit(1)).alias("n_items"), F.max("price").alias("max_price")),
            "per_seller",
        )
    finally:
        items.unpersist()


register(
    "cache_intermediate", _cached,
    "select seller_id, count(*) as n_items, max(price) as max_price from tw_clean_items group by 1",
    "max_price",
)

# ------------------------------------------------------------------------------- row operators

register(
    "drop_columns", lambda f: f.items.drop("shipping_limit_date"),
    "select * exclude (shipping_limit_date) from fx_items", "price freight_value",
)
register(
    "rename_columns",
    lambda f: f.products.withColumnsRenamed(
        {"product_name_lenght": "product_name_length",
         "product_description_lenght": "product_description_length"}
    ).select("product_id", "product_name_length", "product_description_length"),
    "select product_id, product_name_lenght as product_name_length, "
    "product_description_lenght as product_description_length from fx_products",
    "product_name_length product_description_length",
)
register(
    "select_final", lambda f: f.items.select("order_id", "product_id", "seller_id", "price"),
    "select order_id, product_id, seller_id, price from fx_items", "price",
)
register(
    "parse_timestamp",
    lambda f: f.orders.select(
        "order_id", times.parse_timestamp(F.col("order_approved_at")).alias("approved")
    ),
    f"select order_id, {stamp('order_approved_at')} as approved from fx_orders", stamps="approved",
)
register(
    "clip_timestamp_years",
    lambda f: f.orders.select(
        "order_id",
        times.within_years(times.parse_timestamp(F.col("order_approved_at")), 1995, 2001)
        .alias("approved"),
    ),
    f"select order_id, {clipped('order_approved_at')} as approved from fx_orders",
    stamps="approved",
)
register(
    "filter_year_in",
    lambda f: filters.keep_years(f.items, "shipping_limit_date", [1996, 1997, 1998])
    .select("order_id", "order_item_id", "shipping_limit_date"),
    "select order_id, order_item_id, shipping_limit_date from fx_items "
    "where year(shipping_limit_date) in (1996, 1997, 1998)", stamps="shipping_limit_date",
)
register(
    "filter_status_not_in",
    lambda f: filters.keep_unless_in(f.orders, "order_status", SETTINGS.unpaid_statuses)
    .select("order_id", "order_status"),
    "select order_id, order_status from fx_orders "
    f"where order_status is null or order_status not in {BAD_STATUS}",
)
register(
    "filter_not_equal",
    lambda f: filters.keep_unless_equal(f.payments, "payment_type", "not_defined")
    .select("order_id", "payment_sequential", "payment_type"),
    "select order_id, payment_sequential, payment_type from fx_payments "
    "where payment_type is distinct from 'not_defined'",
)
register(
    "filter_bbox",
    lambda f: filters.inside_box(
        f.geolocation, "geolocation_lat", "geolocation_lng", SETTINGS.lat_range, SETTINGS.lng_range
    ),
    "select * from fx_geolocation where geolocation_lat between -33.75116944 and 5.27438888 "
    "and geolocation_lng between -73.98283055 and -34.79314722",
    "geolocation_lat geolocation_lng",
)
register(
    "fill_nulls",
    lambda f: filters.fill_missing(
        f.products, {"product_category_name": "unknown", "product_name_lenght": 0.0}
    ).select("product_id", "product_category_name", "product_name_lenght"),
    "select product_id, coalesce(product_category_name, 'unknown') as product_category_name, "
    "coalesce(product_name_lenght, 0) as product_name_lenght from fx_products",
    "product_name_lenght",
)
register(
    "drop_null_rows",
    lambda f: f.products.na.drop(subset=["product_weight_g", "product_length_cm"])
    .select("product_id", "product_weight_g"),
    "select product_id, product_weight_g from fx_products "
    "where product_weight_g is not null and product_length_cm is not null", "product_weight_g",
)
register(
    "filter_any_null",
    lambda f: filters.rows_with_nulls(f.products).select("product_id", "product_category_name"),
    "select product_id, product_category_name from fx_products where product_category_name is null "
    "or product_name_lenght is null or product_weight_g is null",
)
register(
    "cast_columns",
    lambda f: f.products.select(
        "product_id",
        F.coalesce(F.col("product_name_lenght"), F.lit(0.0)).cast("int").alias("name_length"),
        F.col("product_id").cast("string").alias("id_text"),
    ),
    "select product_id, cast(coalesce(product_name_lenght, 0) as integer) as name_length, "
    "cast(product_id as varchar) as id_text from fx_products",
)
register("standardize_location", lambda f: f.clean_customers, "select * from tw_clean_customers")
register(
    "trim_ids",
    lambda f: cleaning.format_customers(
        f.customers.withColumn("customer_id", F.concat(F.lit(" \t"), "customer_id", F.lit("  ")))
    ).select("customer_id", "customer_unique_id", "customer_zip_code_prefix"),
    "select cast(customer_id as varchar) as customer_id, "
    "cast(customer_unique_id as varchar) as customer_unique_id, customer_zip_code_prefix "
    "from tw_clean_customers",
)
register(
    "day_difference",
    lambda f: f.stored("clean_orders").select(
        "order_id",
        times.whole_days(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ).alias("days_exp"),
        times.whole_days(
            F.col("order_delivered_customer_date"), F.col("order_approved_at")
        ).alias("days_paid"),
    ),
    f"select order_id, {days('order_delivered_customer_date', 'order_estimated_delivery_date')} "
    f"as days_exp, {days('order_delivered_customer_date', 'order_approved_at')} as days_paid "
    "from tw_clean_orders",
)


def _parsed_delivery(f: Fixture) -> DataFrame:
    return f.orders.select(
        "order_id",
        times.parse_timestamp(F.col("order_delivered_customer_date")).alias("delivered"),
        times.parse_timestamp(F.col("order_estimated_delivery_date")).alias("estimated"),
    )


HOURS_SQL = (
    f"select order_id, abs(epoch_us({stamp('order_estimated_delivery_date')}) - "
    f"epoch_us({stamp('order_delivered_customer_date')})) / 3.6e9 as hours from fx_orders"
)
register(
    "duration_hours_abs",
    lambda f: _parsed_delivery(f).select(
        "order_id", times.hours_apart(F.col("delivered"), F.col("estimated")).alias("hours")
    ),
    HOURS_SQL, "hours",
)
register(
    "flag_equals_zero",
    lambda f: f.items.select(
        "order_id", "order_item_id", "product_id",
        filters.true_only(F.col("freight_value") == 0.0).alias("free_delivery"),
    ),
    "select order_id, order_item_id, product_id, coalesce(freight_value = 0, false) "
    "as free_delivery from fx_items",
)
register(
    "copy_column",
    lambda f: f.items.select(
        "order_id", "order_item_id",
        F.col("freight_value").alias("deli_cost"), F.col("price").alias("item_price"),
    ),
    "select order_id, order_item_id, freight_value as deli_cost, price as item_price from fx_items",
    "deli_cost item_price",
)
register(
    "haversine_km",
    lambda f: f.geolocation.select(
        "geolocation_zip_code_prefix",
        haversine_km(
            F.col("geolocation_lat"), F.col("geolocation_lng"), F.lit(-23.5), F.lit(-46.6)
        ).alias("km"),
    ),
    "select geolocation_zip_code_prefix, "
    + haversine("geolocation_lat", "geolocation_lng", "-23.5e0", "-46.6e0")
    + " as km from fx_geolocation", "km",
)
MODEL_LABEL = "case review_score when 5 then 'POS' when 1 then 'NEG' when 3 then 'NEU' else 'X' end"
NAMED = ("case review_score when 5 then 'positive' when 1 then 'negative' when 3 then 'neutral' "
         "else 'neutral' end")
register(
    "map_sentiment_label",
    lambda f: f.reviews.select(
        "review_id", sentiment.sentiment_name(F.expr(MODEL_LABEL)).alias("sentiment")
    ),
    f"select review_id, {NAMED} as sentiment from fx_reviews",
)
PLAIN = f"lower(trim(coalesce(review_comment_message, ''), '{WS}'))"


def _mentions(phrases: list[str]) -> str:
    return "(" + " or ".join(f"contains({PLAIN}, '{p}')" for p in phrases) + ")"


def override_sql(current: str) -> str:
    return (
        f"case when {current} = 'neutral' and ({_mentions(sentiment.POSITIVE_KEYWORDS)} or "
        f"(len(regexp_extract_all({PLAIN}, '[^{WS}]+')) <= 5 and "
        f"{_mentions(sentiment.SHORT_COMMENT_PHRASES)})) then 'positive' else {current} end"
    )


register(
    "sentiment_keyword_override",
    lambda f: f.reviews.withColumn(
        "plain",
        sentiment.plain_text(F.coalesce(F.col("review_comment_message"), F.lit(""))),
    ).select(
        "review_id",
        sentiment.keyword_override(
            F.col("plain"),
            sentiment.sentiment_name(F.expr(MODEL_LABEL)),
        ).alias("sentiment"),
    ),
    f"select review_id, {override_sql(NAMED)} as sentiment from fx_reviews",
)
register(
    "blank_comment_label",
    lambda f: f.reviews.select(
        "review_id",
        sentiment.blank_label(F.col("review_comment_message"), F.lit("neutral")).alias("sentiment"),
    ),
    f"select review_id, case when {PLAIN} = '' then 'No comment' else 'neutral' end as sentiment "
    "from fx_reviews",
)
VERIFIED = (
    "case when sentiment <> 'No comment' then (sentiment in ('positive', 'neutral') and "
    "review_score in (4, 5)) or (sentiment = 'neutral' and review_score = 3) or "
    "(sentiment = 'negative' and review_score in (1, 2)) end"
)
FOUR_SENTIMENTS = ("case review_id % 4 when 0 then 'positive' when 1 then 'neutral' "
                   "when 2 then 'negative' else 'No comment' end")
register(
    "verified_rating",
    lambda f: f.reviews.withColumn("sentiment", F.expr(FOUR_SENTIMENTS)).select(
        "review_id",
        sentiment.verified_rating(F.col("sentiment"), F.col("review_score")).alias("is_verified"),
    ),
    f"select review_id, {VERIFIED} as is_verified from "
    f"(select *, {FOUR_SENTIMENTS} as sentiment from fx_reviews)",
)

# ---------------------------------------------------------------------- statistics, caps, flags

register(
    "cap_at_percentile",
    lambda f: caps.cap_at_percentile(f.items, ["price", "freight_value"], 99.9)
    .select("order_id", "order_item_id", "price", "freight_value"),
    "select order_id, order_item_id, price, freight_value from tw_clean_items",
    "price freight_value",
)
register(
    "clip_at_quantile",
    lambda f: caps.clip_at_quantile(f.payments, "payment_installments", 0.99)
    .select("order_id", "payment_sequential", "payment_installments"),
    "select order_id, payment_sequential, case when payment_installments > q then q "
    "else payment_installments end as payment_installments from fx_payments, "
    "(select quantile_cont(payment_installments, 0.99) as q from fx_payments)",
    "payment_installments",
)
register(
    "cap_outliers",
    lambda f: caps.cap_outliers(
        caps.cap_outliers(f.items, "price", lower=True, upper=True), "freight_value",
        lower=False, upper=2500,
    ).select("order_id", "order_item_id", "price", "freight_value"),
    "select order_id, order_item_id, case when price < lo then lo when price > hi then hi "
    "else price end as price, case when freight_value > 2500 then 2500 else freight_value end "
    "as freight_value from fx_items, (select quantile_cont(price, 0.01) as lo, "
    "quantile_cont(price, 0.99) as hi from fx_items)",
    "price freight_value",
)
register(
    "impute_by_median_offset",
    lambda f: caps.fill_by_median_offset(_parsed_delivery(f), "delivered", "estimated"),
    f"""select order_id, coalesce(d, make_timestamp(epoch_us(e) - off)) as delivered, e as estimated
 from (select order_id, {stamp('order_delivered_customer_date')} as d,
   {stamp('order_estimated_delivery_date')} as e from fx_orders),
  (select cast(trunc(quantile_cont(epoch_us({stamp('order_estimated_delivery_date')})
    - epoch_us({stamp('order_delivered_customer_date')}), 0.5)) as bigint) as off from fx_orders)""",
    stamps="delivered estimated",
)


def _fitted_stages(f: Fixture) -> DataFrame:
    """Caps learned on the items, stored and read back, applied to dearer items."""
    catalog = Catalog(f.spark, scratch_folder(f.spark, "models"))
    cap = fitted.PercentileCap(inputCols=["price", "freight_value"], lower=1.0, upper=99.0)
    catalog.save_model(Pipeline(stages=[cap]).fit(f.items), "caps")
    dearer = f.items.withColumns(
        {c: F.col(c).cast("double") * 1.5 for c in ("price", "freight_value")}
    )
    return catalog.load_model("caps").transform(dearer).select(
        "order_id", "order_item_id", "price", "freight_value"
    )


register(
    "fitted_caps", _fitted_stages,
    "select order_id, order_item_id, least(greatest(price * 1.5e0, pl), ph) as price, "
    "least(greatest(freight_value * 1.5e0, fl), fh) as freight_value from fx_items, "
    "(select quantile_cont(price, 0.01) as pl, quantile_cont(price, 0.99) as ph, "
    "quantile_cont(freight_value, 0.01) as fl, quantile_cont(freight_value, 0.99) as fh "
    "from fx_items)",
    "price freight_value",
)
register(
    "flag_iqr_high",
    lambda f: f.items.select(
        "order_id", "order_item_id", "price", caps.above_iqr(f.items, "price", 0.05).alias("high")
    ),
    "select order_id, order_item_id, price, price > q3 + 0.05 * (q3 - q1) as high from fx_items, "
    "(select quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.75) as q3 from fx_items)",
    "price",
)
register(
    "flag_q75_multiple",
    lambda f: f.items.select(
        "order_id", "order_item_id", "freight_value",
        caps.above_quantile_multiple(f.items, "freight_value").alias("high"),
    ),
    "select order_id, order_item_id, freight_value, freight_value > 1.5 * q as high from fx_items, "
    "(select quantile_cont(freight_value, 0.75) as q from fx_items)", "freight_value",
)
register(
    "flag_quantile_threshold",
    lambda f: f.raw("orders").select(
        "o_orderkey", caps.at_least_quantile(f.raw("orders"), "o_totalprice", 0.8).alias("high")
    ),
    "select o_orderkey, o_totalprice >= (select quantile_cont(o_totalprice, 0.8) from orders) "
    "as high from orders",
)

# --------------------------------------------------------------------------------------- joins

register(
    "join_orders_customers",
    lambda f: f.stored("clean_orders").select("order_id", "customer_id").join(
        f.customers.select("customer_id", "customer_unique_id"), "customer_id", "left"
    ),
    "select order_id, customer_id, customer_unique_id from tw_persons",
)
register(
    "join_repeat_flags_back",
    lambda f: cleaning.repeat_labels(f.stored("clean_orders"), f.clean_customers).select(
        "order_id", "customer_unique_id", "num_orders", "is_repeat_buyer"
    ),
    "select order_id, customer_unique_id, num_orders, num_orders > 1 as is_repeat_buyer "
    "from tw_persons left join (select customer_unique_id, count(distinct order_id) as num_orders "
    "from tw_persons where customer_unique_id is not null group by 1) using (customer_unique_id)",
)
register(
    "join_first_item",
    lambda f: f.orders.select("order_id").join(
        cleaning.first_items(f.items), "order_id", "left"
    ),
    "select o.order_id, product_id, seller_id from fx_orders o "
    "left join tw_first_items using (order_id)",
)
register(
    "join_items_orders",
    lambda f: f.items.select("order_id", "order_item_id", "product_id").join(
        f.stored("clean_orders").select("order_id", "order_approved_at", "order_delivered_customer_date"),
        "order_id", "left",
    ),
    "select order_id, order_item_id, product_id, order_approved_at, order_delivered_customer_date "
    "from fx_items left join tw_clean_orders using (order_id)",
    stamps="order_approved_at order_delivered_customer_date",
)
register(
    "join_items_labels",
    lambda f: f.items.select("order_id", "order_item_id", "product_id").join(
        f.stored("labels").select("order_id", "customer_unique_id", "is_repeat_buyer"), "order_id", "left"
    ),
    "select i.order_id, i.order_item_id, i.product_id, customer_unique_id, is_repeat_buyer "
    "from fx_items i left join tw_labels l using (order_id)",
)
register(
    "join_bulk_flag",
    lambda f: f.items.select("order_id", "order_item_id", "product_id")
    .join(
        joins.splittable(
            aggregates.pair_counts(f.items).where("product_qty > 1"), ["order_id", "product_id"]
        ).select("order_id", "product_id", F.lit(True).alias("is_bulk")),
        ["order_id", "product_id"], "left",
    ).withColumn("is_bulk", filters.true_only(F.col("is_bulk"))),
    "select order_id, order_item_id, product_id, "
    "count(*) over (partition by order_id, product_id) > 1 as is_bulk from fx_items",
)
register(
    "join_avg_price",
    lambda f: f.items.select("order_id", "order_item_id", "product_id", "price").join(
        joins.splittable(
            f.items.groupBy("product_id").agg(F.avg("price").alias("avg_price")), ["product_id"]
        ),
        "product_id", "left",
    ),
    "select order_id, order_item_id, product_id, price, "
    "avg(price) over (partition by product_id) as avg_price from fx_items", "price avg_price",
)
PAY_COLUMNS = "credit_card voucher debit_card boleto total_spent"
register(
    "join_payments_wide",
    lambda f: f.items.select("order_id", "order_item_id", "product_id").join(
        joins.splittable(
            aggregates.payments_per_order(
                f.stored("clean_payments"), SETTINGS.payment_types, False
            ).drop("installment"),
            ["order_id"],
        ),
        "order_id", "left",
    ),
    "select i.order_id, i.order_item_id, i.product_id, credit_card, voucher, debit_card, boleto, "
    "total_spent from fx_items i left join tw_order_payments using (order_id)", PAY_COLUMNS,
)
register(
    "join_installments",
    lambda f: f.items.select("order_id", "order_item_id", "product_id").join(
        joins.splittable(
            aggregates.payments_per_order(
                f.stored("clean_payments"), SETTINGS.payment_types
            ).select("order_id", "installment"),
            ["order_id"],
        ),
        "order_id", "left",
    ).withColumn("installment", F.coalesce("installment", F.lit(0))),
    "select i.order_id, i.order_item_id, i.product_id, coalesce(installment, 0) as installment "
    "from fx_items i left join tw_order_payments using (order_id)",
)
register(
    "join_customer_coords",
    lambda f: joins.coordinates(
        f.tagged_customers, f.clean_geolocation, "customer_zip_code_prefix", "customer",
        ["customer_id", "high_density_customer_area"],
    ),
    "select customer_id, geolocation_lat as customer_lat, geolocation_lng as customer_lng, "
    "high_density_customer_area from tw_tagged_customers join tw_clean_geolocation "
    "on geolocation_zip_code_prefix = customer_zip_code_prefix", "customer_lat customer_lng",
)
register(
    "join_seller_coords",
    lambda f: joins.coordinates(
        f.clean_sellers, f.clean_geolocation, "seller_zip_code_prefix", "seller", ["seller_id"]
    ),
    "select seller_id, geolocation_lat as seller_lat, geolocation_lng as seller_lng "
    "from tw_clean_sellers join tw_clean_geolocation "
    "on geolocation_zip_code_prefix = seller_zip_code_prefix", "seller_lat seller_lng",
)


def _order_details(f: Fixture) -> DataFrame:
    buyers = joins.coordinates(
        f.tagged_customers, f.clean_geolocation, "customer_zip_code_prefix", "customer",
        ["customer_id", "high_density_customer_area"],
    )
    shops = joins.coordinates(
        f.clean_sellers, f.clean_geolocation, "seller_zip_code_prefix", "seller", ["seller_id"]
    )
    return (
        f.items.select("order_id", "order_item_id", "product_id", "seller_id")
        .join(shops, "seller_id")
        .join(f.stored("clean_orders").select("order_id", "customer_id"), "order_id")
        .join(buyers, "customer_id")
        .select("order_id", "order_item_id", "product_id", "seller_id", "customer_lat",
                "seller_lat", "high_density_customer_area")
    )


register(
    "join_order_details", _order_details,
    "select order_id, order_item_id, product_id, seller_id, customer_lat, seller_lat, "
    "high_density_customer_area from tw_located_items", "customer_lat seller_lat",
)
register(
    "join_distance_to_labels",
    lambda f: f.distances.select("order_id", "customer_unique_id", "distance_km"),
    "select order_id, customer_unique_id, distance_km from tw_distances", "distance_km",
)
register(
    "join_seller_rate",
    lambda f: f.seller_stats.select("order_id", "seller_id", "seller_repeat_buyer_rate"),
    "select order_id, seller_id, seller_repeat_buyer_rate from tw_seller_stats",
    "seller_repeat_buyer_rate",
)


def _feature_tables(f: Fixture) -> DataFrame:
    """All joins by order before the one by product, so that items are shuffled once here."""
    keys = ["order_id", "product_id", "seller_id"]
    stats = f.seller_stats.select(*[F.col(c).alias(f"_{c}") for c in keys], "distance_km")
    same = F.col("order_id") == F.col("_order_id")
    for c in keys[1:]:
        same = same & F.col(c).between(F.col(f"_{c}"), F.col(f"_{c}"))
    return (
        f.transactions.select(*keys, "item_price")
        .join(stats, same, "left")
        .join(f.review_features.select("order_id", "review_score"), "order_id", "left")
        .join(f.product_features.select("product_id", "product_category_name"), "product_id", "left")
        .select(*keys, "item_price", "distance_km", "product_category_name", "review_score")
    )


register(
    "join_feature_tables",
    _feature_tables,
    "select t.order_id, t.product_id, t.seller_id, t.item_price, s.distance_km, "
    "p.product_category_name, r.review_score from tw_transactions t left join tw_seller_stats s "
    "on s.order_id = t.order_id and s.product_id = t.product_id and s.seller_id = t.seller_id "
    "left join tw_product_features p on p.product_id = t.product_id "
    "left join fx_reviews r on r.order_id = t.order_id", "item_price distance_km",
)
register(
    "lookup_translate",
    lambda f: joins.lookup_replace(
        f.products.select("product_id", "product_category_name"), "product_category_name",
        f.translation, "product_category_name", "product_category_name_english",
    ),
    "select product_id, t.product_category_name_english as product_category_name "
    "from fx_products p left join fx_translation t using (product_category_name)",
)
MANY_INSTALLMENTS = (
    "select order_id from fx_payments group by 1 having count(distinct payment_installments) > 2"
)
register(
    "semi_join_isin",
    lambda f: joins.keep_listed(
        f.payments,
        aggregates.keys_with_many_values(f.payments, "order_id", "payment_installments", 2),
        "order_id",
    ),
    f"select * from fx_payments where order_id in ({MANY_INSTALLMENTS})", "payment_value",
)


def _noisy_zips(f: Fixture) -> DataFrame:
    spread = aggregates.zip_spread(
        _inside(f), "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city",
    )
    return spread.where("lat_range > 0.5 or lng_range > 0.5")


def _inside(f: Fixture) -> DataFrame:
    return cleaning.standardized_points(
        filters.inside_box(
            f.geolocation, "geolocation_lat", "geolocation_lng", SETTINGS.lat_range,
            SETTINGS.lng_range,
        )
    )


register(
    "anti_join_isin",
    lambda f: joins.drop_listed(_inside(f), _noisy_zips(f), "geolocation_zip_code_prefix"),
    "select * from tw_points_inside where geolocation_zip_code_prefix not in "
    "(select geolocation_zip_code_prefix from tw_noisy_zips)", "geolocation_lat geolocation_lng",
)
register(
    "member_of_topk",
    lambda f: ranking.in_top_values(
        f.clean_customers.select("customer_id", "customer_city"), "customer_city", 10, "in_top"
    ),
    "select customer_id, customer_city, coalesce(customer_city in (select customer_city from "
    "tw_clean_customers where customer_city is not null group by 1 order by count(*) desc, "
    "customer_city limit 10), false) as in_top from tw_clean_customers",
)

# ---------------------------------------------------------------------------------- aggregates

register(
    "agg_count_distinct",
    lambda f: aggregates.distinct_per_key(
        f.stored("clean_orders").join(f.customers, "customer_id"), "customer_unique_id", "order_id",
        "num_orders",
    ).withColumn("is_repeat_buyer", F.col("num_orders") > 1),
    "select customer_unique_id, count(distinct order_id) as num_orders, "
    "count(distinct order_id) > 1 as is_repeat_buyer from tw_persons group by 1",
)
register("agg_zip_centroid", lambda f: f.clean_geolocation, "select * from tw_clean_geolocation",
         "geolocation_lat geolocation_lng")
register(
    "agg_format_geolocation", lambda f: cleaning.format_geolocation(f.geolocation),
    "select geolocation_zip_code_prefix, avg(geolocation_lat) as geolocation_lat, "
    "avg(geolocation_lng) as geolocation_lng from tw_points group by 1",
    "geolocation_lat geolocation_lng",
)
register(
    "agg_geo_ranges",
    lambda f: aggregates.zip_spread(
        f.geolocation, "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city",
    ),
    "select geolocation_zip_code_prefix, min(geolocation_lat) as lat_min, "
    "max(geolocation_lat) as lat_max, stddev_samp(geolocation_lat) as lat_std, "
    "min(geolocation_lng) as lng_min, max(geolocation_lng) as lng_max, "
    "stddev_samp(geolocation_lng) as lng_std, count(distinct geolocation_city) as n_cities, "
    "max(geolocation_lat) - min(geolocation_lat) as lat_range, "
    "max(geolocation_lng) - min(geolocation_lng) as lng_range from fx_geolocation group by 1",
    "lat_min lat_max lat_std lng_min lng_max lng_std lat_range lng_range",
)
register(
    "agg_pivot_sum",
    lambda f: aggregates.payments_per_order(f.stored("clean_payments"), SETTINGS.payment_types, False)
    .drop("total_spent", "installment"),
    "select order_id, credit_card, voucher, debit_card, boleto from tw_order_payments",
    "credit_card voucher debit_card boleto",
)
SHARES = ", ".join(
    f"case when total_spent = 0 then 0 else {t} / total_spent end as {t}"
    for t in ["credit_card", "voucher", "debit_card", "boleto"]
)
register(
    "agg_row_total_ratio",
    lambda f: aggregates.payments_per_order(f.stored("clean_payments"), SETTINGS.payment_types)
    .drop("installment"),
    f"select order_id, {SHARES}, total_spent from tw_order_payments", PAY_COLUMNS,
)
register(
    "agg_count_pair",
    lambda f: aggregates.pair_counts(f.items).withColumn("is_bulk", F.col("product_qty") > 1),
    "select order_id, product_id, count(*) as product_qty, count(*) > 1 as is_bulk "
    "from fx_items group by 1, 2",
)
register(
    "agg_mean_compare",
    lambda f: f.items.join(
        joins.splittable(aggregates.price_totals(f.items), ["product_id"]), "product_id", "left"
    ).select(
        "order_id", "order_item_id", "product_id", aggregates.below_mean().alias("discount")
    ),
    "select order_id, order_item_id, product_id, cast(price as decimal(18,6)) * "
    "count(price) over (partition by product_id) < sum(cast(price as decimal(18,6))) "
    "over (partition by product_id) as discount from fx_items",
)
register(
    "agg_sum_per_order",
    lambda f: aggregates.payments_per_order(f.stored("clean_payments"), SETTINGS.payment_types)
    .select("order_id", "installment"),
    "select order_id, installment from tw_order_payments",
)
register(
    "agg_ratio_of_distincts", lambda f: aggregates.repeat_rate_per_seller(f.stored("distances")),
    "select distinct seller_id, seller_repeat_buyer_rate from tw_seller_stats",
    "seller_repeat_buyer_rate",
)
register(
    "agg_value_counts", lambda f: ranking.value_counts(f.products, "product_category_name"),
    "select product_category_name, count(*) as n from fx_products "
    "where product_category_name is not null group by 1",
)
register(
    "agg_value_share", lambda f: ranking.value_shares(f.raw("events"), "event_type"),
    "select event_type, count(*) * 1.0e0 / (select count(*) from events) as share "
    "from events group by 1", "share",
)
register(
    "agg_having_distinct",
    lambda f: aggregates.keys_with_many_values(f.payments, "order_id", "payment_installments", 2),
    "select order_id, count(distinct payment_installments) as n_values from fx_payments "
    "group by 1 having count(distinct payment_installments) > 2",
)
register(
    "profile_nulls", lambda f: profile.null_profile(
        f.products.select("product_id", "product_category_name", "product_name_lenght",
                          "product_weight_g")
    ),
    "select count(*) as n_rows, count(*) filter (product_category_name is null or "
    "product_name_lenght is null or product_weight_g is null) as rows_with_null, "
    "0::bigint as nulls_product_id, "
    "count(*) filter (product_category_name is null) as nulls_product_category_name, "
    "count(*) filter (product_name_lenght is null) as nulls_product_name_lenght, "
    "count(*) filter (product_weight_g is null) as nulls_product_weight_g, "
    "100.0e0 * count(*) filter (product_category_name is null or product_name_lenght is null "
    "or product_weight_g is null) / count(*) as rows_with_null_pct from fx_products",
    "rows_with_null_pct",
)
LINE_KEY = ["l_orderkey", "l_linenumber"]
register(
    "profile_duplicates", lambda f: profile.duplicate_profile(f.raw("lineitem"), LINE_KEY),
    "select cast(sum(n) as bigint) as n_rows, cast(sum(n - 1) as bigint) as duplicate_rows, "
    "100.0e0 * sum(n - 1) / sum(n) as duplicate_pct from "
    "(select count(*) as n from lineitem group by l_orderkey, l_linenumber)", "duplicate_pct",
)
register(
    "list_duplicates",
    lambda f: profile.duplicated_rows(f.raw("lineitem"), LINE_KEY)
    .select("l_orderkey", "l_linenumber", "l_partkey"),
    "select l_orderkey, l_linenumber, l_partkey from lineitem "
    "qualify count(*) over (partition by l_orderkey, l_linenumber) > 1",
)


def _describe_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 3) as mean, "
        f"round(stddev_samp({c}), 3) as std, cast(min({c}) as double) as min, "
        f"quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, "
        f"quantile_cont({c}, 0.75) as q75, cast(max({c}) as double) as max from {table}"
        for c in columns
    )


register(
    "describe_stats",
    lambda f: profile.describe_numeric(
        f.items.select("order_item_id", "price", "freight_value")
    ).withColumns({"mean": F.round("mean", 3), "std": F.round("std", 3)}),
    _describe_sql("fx_items", ["order_item_id", "price", "freight_value"]),
    "mean std min q25 q50 q75 max",
)
register(
    "table_info", lambda f: profile.table_info(f.raw("orders")).select(
        "position", "column", "non_null", "n_rows"
    ),
    " union all ".join(
        f"select {i} as position, '{c}' as \"column\", count({c}) as non_null, "
        "count(*) as n_rows from orders"
        for i, c in enumerate(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                               "o_orderdate", "o_orderpriority"])
    ),
)
register(
    "duration_summary",
    lambda f: profile.duration_summary(_parsed_delivery(f), "delivered", "estimated"),
    "select avg(hours) as mean_hours, median(hours) as median_hours, (select hours from "
    f"({HOURS_SQL}) where hours is not null group by 1 order by count(*) desc, hours limit 1) "
    f"as mode_hours from ({HOURS_SQL})", "mean_hours median_hours mode_hours",
)
register(
    "histogram_bins",
    lambda f: profile.histogram(
        _parsed_delivery(f).select(
            times.hours_apart(F.col("delivered"), F.col("estimated")).alias("hours")
        ), "hours", 30,
    ),
    f"with h as ({HOURS_SQL}), e as (select min(hours) as lo, max(hours) as hi, count(hours) as c "
    "from h), c as (select cast(least(floor((hours - lo) / (hi - lo) * 30), 29) as integer) as bin, "
    "count(*) as n from h, e where hours is not null group by 1) "
    "select cast(b.bin as integer) as bin, lo + b.bin * ((hi - lo) / 30) as lower, "
    "lo + (b.bin + 1) * ((hi - lo) / 30) as upper, coalesce(n, 0) as n, "
    "coalesce(n, 0) / (e.c * ((hi - lo) / 30)) as density "
    "from range(30) b(bin) cross join e left join c on b.bin = c.bin", "lower upper density",
)
register(
    "boxplot_stats",
    lambda f: profile.box_statistics(f.items.select("price", "freight_value", "order_item_id")),
    " union all ".join(
        f"select '{c}' as \"column\", quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3, "
        f"quantile_cont({c}, 0.01) as p01, quantile_cont({c}, 0.99) as p99 from fx_items"
        for c in ["price", "freight_value", "order_item_id"]
    ), "q1 q3 p01 p99",
)
register(
    "quantile_value",
    lambda f: order_stats.quantiles(f.items, "price", {"q999": 0.999, "median": 0.5}),
    "select quantile_cont(price, 0.999) as q999, quantile_cont(price, 0.5) as median from fx_items",
    "q999 median",
)
register(
    "category_counts", lambda f: profile.category_counts(f.reviews, "review_score"),
    "select cast(review_score as varchar) as review_score, count(*) as n from fx_reviews group by 1",
)

# -------------------------------------------------------------------- dedup, sort, limit, top-k

register(
    "dedup_all_columns", lambda f: f.geolocation.distinct(),
    "select distinct * from fx_geolocation", "geolocation_lat geolocation_lng",
)
register("dedup_keep_first", lambda f: cleaning.first_items(f.items), "select * from tw_first_items")
register(
    "topk_frequent_values", lambda f: ranking.top_values(f.clean_customers, "customer_city", 20),
    "select customer_city, count(*) as n from tw_clean_customers where customer_city is not null "
    "group by 1 order by n desc, customer_city limit 20",
)
register(
    "high_density_flag",
    lambda f: f.tagged_customers.select("customer_id", "high_density_customer_area"),
    "select customer_id, high_density_customer_area from tw_tagged_customers",
)
register(
    "top_fraction_by_score",
    lambda f: ranking.top_share(f.scores, "score", "row_id", 0.1).select("row_id", "label", "score"),
    "select row_id, label, score from fx_scores order by score desc, row_id "
    "limit (select cast(floor(count(*) * 0.1) as bigint) from fx_scores)", "score",
)
register(
    "sorted_distinct", lambda f: profile.sorted_distinct(f.products, "product_category_name"),
    "select distinct product_category_name from fx_products where product_category_name is not null",
)
register(
    "random_sample",
    lambda f: ranking.sample_rows(f.reviews, "review_id", 100, 42).select("review_id", "order_id"),
    "select review_id, order_id from fx_reviews "
    "order by md5(concat(cast(review_id as varchar), '|42')) limit 100",
)
register(
    "head_n",
    lambda f: f.customers.orderBy("customer_id").limit(5).select("customer_id", "customer_city"),
    "select customer_id, customer_city from fx_customers order by customer_id limit 5",
)

# ----------------------------------------------------------------------------------- table jobs

register("clean_orders", lambda f: f.clean_orders, "select * from tw_clean_orders",
         stamps=ORDER_STAMPS)
register("clean_items", lambda f: f.clean_items, "select * from tw_clean_items",
         "price freight_value")
register("clean_payments", lambda f: f.clean_payments, "select * from tw_clean_payments",
         "payment_value payment_installments")
register("clean_customers", lambda f: f.clean_customers, "select * from tw_clean_customers")
register("clean_sellers", lambda f: f.clean_sellers, "select * from tw_clean_sellers")
register("clean_geolocation", lambda f: f.clean_geolocation, "select * from tw_clean_geolocation",
         "geolocation_lat geolocation_lng")
register(
    "clean_reviews", lambda f: f.clean_reviews,
    "select order_id, review_score, review_comment_message from fx_reviews",
)
register("clean_products", lambda f: f.clean_products, "select * from tw_clean_products",
         "product_weight_g product_length_cm product_height_cm product_width_cm")
register("mega_id_labels", lambda f: f.labels, "select * from tw_labels")
register(
    "transaction_features", lambda f: f.transactions, "select * from tw_transactions",
    f"deli_cost item_price {PAY_COLUMNS}",
)
register(
    "review_features", lambda f: f.review_features.select("order_id", "review_score"),
    "select order_id, review_score from fx_reviews",
)


def delay_is_negative(texts: pd.Series) -> pd.Series:
    """A stand-in for a language model: comments about delays are negative."""
    return texts.str.contains("atraso", regex=False).map({True: "NEG", False: "NEU"})


SCORED = (
    f"select review_id, order_id, review_score, case when {PLAIN} = '' then 'No comment' else "
    + override_sql("(case when contains(review_comment_message, 'atraso') then 'negative' "
                   "else 'neutral' end)")
    + " end as sentiment from fx_reviews"
)


def _words_sql(stems: list[str], negated: bool) -> str:
    stems_ = f"(?:{'|'.join(stems)})"
    turned = f"[^\\p{{L}}](?:{'|'.join(sentiment.NEGATIONS)})[ \\t\\r\\n]+{stems_}"
    count = "len(regexp_extract_all(' ' || " + PLAIN + ", '{}'))"
    if negated:
        return count.format(turned)
    return f"({count.format(f'[^\\p{{L}}]{stems_}')} - {count.format(turned)})"


CONTENT, DISCONTENT = (
    f"({_words_sql(a, False)} + {_words_sql(b, True)})"
    for a, b in (
        (sentiment.CONTENT_STEMS, sentiment.DISCONTENT_STEMS),
        (sentiment.DISCONTENT_STEMS, sentiment.CONTENT_STEMS),
    )
)
LEXICON = (
    f"(case when {CONTENT} > {DISCONTENT} then 'positive' when {CONTENT} < {DISCONTENT} "
    "then 'negative' else 'neutral' end)"
)
register(
    "sentiment_scoring",
    lambda f: features.review_sentiment(f.reviews).select("review_id", "order_id", "sentiment"),
    f"select review_id, order_id, case when {PLAIN} = '' then 'No comment' else "
    f"{override_sql(LEXICON)} end as sentiment from fx_reviews",
)
register(
    "review_features_sentiment",
    lambda f: features.review_features(f.clean_reviews, True, lambda: delay_is_negative),
    f"select order_id, review_score, sentiment, {VERIFIED} as is_verified from ({SCORED}) "
    "where sentiment <> 'No comment'",
)
register("product_features", lambda f: f.product_features, "select * from tw_product_features",
         "product_weight_g product_length_cm product_height_cm product_width_cm")
register("tagged_customers", lambda f: f.tagged_customers, "select * from tw_tagged_customers")
register("order_distances", lambda f: f.distances, "select * from tw_distances", "distance_km")
register("distance_seller_stats", lambda f: f.seller_stats, "select * from tw_seller_stats",
         "distance_km seller_repeat_buyer_rate")
MODEL_DOUBLES = (
    f"deli_cost item_price {PAY_COLUMNS} distance_km seller_repeat_buyer_rate product_weight_g "
    "product_length_cm product_height_cm product_width_cm"
)
register("model_inputs", lambda f: f.model_inputs, "select * from tw_model_inputs", MODEL_DOUBLES)
