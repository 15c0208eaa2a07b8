"""Feature jobs and the model table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.base import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.geo import haversine_km
from encore.functions.sentiment import (
    NO_COMMENT,
    blank_label,
    is_blank,
    keyword_override,
    lexicon_label,
    plain_text,
    sentiment_name,
    verified_rating,
)
from encore.functions.times import whole_days
from encore.operators.aggregates import (
    below_mean,
    pair_counts,
    payments_per_order,
    price_totals,
    repeat_rate_per_seller,
)
from encore.operators.caps import above_iqr
from encore.operators.filters import true_only
from encore.operators.joins import coordinates, lookup_replace, splittable
from encore.operators.ranking import first_per_key, in_top_values
from encore.plans.cleaning import ITEM_ORDER
from encore.plans.settings import DEFAULTS, Settings
from encore.session import stored
from encore.sources.layers import stored_in_buckets

PredictorFactory = Callable[[], Callable[[pd.Series], pd.Series]]
Predictor = PredictorFactory | Transformer | None


def order_facts(
    orders: DataFrame, payments: DataFrame, labels: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Everything an item takes from its order: durations, person and label, payments.

    The final table keeps only rows in which all of these are known, so the joins are inner.
    All sides are keyed by order, so each is shuffled once.
    """
    durations = orders.select(
        "order_id",
        whole_days(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ).alias("deli_duration_exp"),
        whole_days(F.col("order_delivered_customer_date"), F.col("order_approved_at")).alias(
            "deli_duration_paid"
        ),
    )
    persons = labels.select("order_id", "customer_id", "customer_unique_id", "is_repeat_buyer")
    return durations.join(persons, "order_id").join(
        payments_per_order(payments, settings.payment_types), "order_id"
    )


def transaction_features(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    labels: DataFrame,
    settings: Settings = DEFAULTS,
    wanted: DataFrame | None = None,
    bucketed: bool = False,
    deal_prices: bool = False,
) -> DataFrame:
    """Item-level features; rows with a missing value are dropped.

    ``price`` and ``freight_value`` are the capped ones. Only pairs that occur more than once
    are joined for the bulk flag; all other items are not bulk.

    Items move by order alone, and not at all from a layer in buckets of it. To their product go
    order, product and price only; back come the pairs with an item below its product's mean,
    with the dearest such price, at or below which all items of a pair are discounts. As in
    ``model_inputs`` a pair's product is compared as a range, to keep the order as only key.

    ``wanted``: where the caller goes on to join (order_id, product_id, seller_id) of this table,
    items without a match there are left out before anything is joined to them. Quartiles, means
    and pairs are those of all items. ``bucketed``: the items lie in buckets, which are even, so
    that there is no hot order for adaptive execution to split. ``deal_prices``: for the means,
    products and prices of all items are written in buckets of the product instead of shuffled.
    """
    chosen = items.select("order_id", "product_id", "seller_id", "price", "freight_value")
    if wanted is not None:
        keys = ["order_id", "product_id", "seller_id"]
        match = wanted.select(*[F.col(c).alias(f"_{c}") for c in keys])
        same = F.col("order_id") == F.col("_order_id")
        for c in keys[1:]:
            same = same & F.col(c).between(F.col(f"_{c}"), F.col(f"_{c}"))
        chosen = chosen.join(match, same, "left_semi")
    pair = [F.col("order_id").alias("_order"), F.col("product_id").alias("_product")]
    same_pair = (F.col("order_id") == F.col("_order")) & F.col("product_id").between(
        F.col("_product"), F.col("_product")
    )
    bulk = pair_counts(items).where(F.col("product_qty") > 1)
    bulk = bulk.select(*pair, F.lit(True).alias("is_bulk"))
    prices = items.select("product_id", "price")
    if deal_prices:
        prices = stored_in_buckets(prices, "prices", "product_id")
    totals = splittable(price_totals(prices), ["product_id"])
    cheap = (
        chosen.select("order_id", "product_id", "price")
        .join(totals, "product_id")
        .where(below_mean())
        .groupBy("order_id", "product_id")
        .agg(F.max("price").alias("_cheap"))
        .select(*pair, "_cheap")
    )
    facts = order_facts(orders, payments, labels, settings)
    if not bucketed:
        facts = splittable(facts, ["order_id"])
    flagged = (
        chosen.withColumns(
            {
                "free_delivery": true_only(F.col("freight_value") == 0.0),
                "high_price": above_iqr(items, "price"),
            }
        )
        .join(bulk, same_pair, "left")
        .drop("_order", "_product")
        .withColumn("is_bulk", true_only(F.col("is_bulk")))
        .join(cheap, same_pair, "left")
        .withColumn("discount", true_only(F.col("price") <= F.col("_cheap")))
    )
    return (
        flagged.join(facts, "order_id")
        .select(
            "order_id", "product_id", "seller_id", "customer_id", "customer_unique_id",
            "deli_duration_exp", "deli_duration_paid",
            F.col("freight_value").alias("deli_cost"),
            "free_delivery",
            F.col("price").alias("item_price"),
            "high_price", "discount", "is_bulk", "is_repeat_buyer", "installment",
            *settings.payment_types,
            "total_spent",
        )
        .na.drop()
    )


def score_texts(
    texts: DataFrame, column: str, key: str, predictor: PredictorFactory
) -> DataFrame:
    """(key, plain, label) of a table with one text per key.

    The factory is called once per partition, on the executor, and returns a function from a
    batch of texts to labels; what it loads is not sent with the tasks.
    """
    schema = f"`{key}` {texts.schema[key].dataType.simpleString()}, _plain string, model_label string"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = None
        for batch in batches:
            predict = predict or predictor()
            yield batch[[key, "_plain"]].assign(model_label=predict(batch[column]))

    return texts.select(key, column, plain_text(F.col(column)).alias("_plain")).mapInPandas(
        score, schema
    )


def label_texts(
    texts: DataFrame, column: str, key: str, predictor: Predictor
) -> DataFrame:
    """(key, _plain, model_label) by a predictor of any kind.

    None is the built-in lexicon; a fitted ``PipelineModel`` reads the column ``text`` (plain
    text) and gives a string column ``label``; both run as column expressions. Anything else is
    a factory of a function on pandas series, for models that need Python.
    """
    if predictor is not None and not isinstance(predictor, Transformer):
        return score_texts(texts, column, key, predictor)
    plain = texts.select(key, plain_text(F.col(column)).alias("_plain"))
    if predictor is None:
        return plain.withColumn("model_label", lexicon_label(F.col("_plain")))
    scored = predictor.transform(plain.withColumn("text", F.col("_plain")))
    return scored.select(key, "_plain", F.col("label").alias("model_label"))


def review_sentiment(reviews: DataFrame, predictor: Predictor = None) -> DataFrame:
    """Add ``sentiment``: model label of the comment, lifted by keywords; blank has its own.

    Without a predictor the built-in lexicon labels (see ``label_texts`` for others). Each
    distinct comment is scored and looked through once, under a 256-bit digest, so texts are
    shuffled once and joins carry digests. Blank comments reach neither model nor join.
    """
    comment = "review_comment_message"
    known = reviews.withColumn(comment, F.coalesce(F.col(comment), F.lit("")))
    blank = is_blank(F.col(comment))
    asked = known.where(~blank).withColumn("_digest", F.sha2(comment, 256))
    texts = asked.groupBy("_digest").agg(F.min(comment).alias(comment))
    scored = label_texts(texts, comment, "_digest", predictor)
    override = keyword_override(F.col("_plain"), sentiment_name(F.col("model_label")))
    decided = scored.select("_digest", blank_label(F.col("_plain"), override).alias("sentiment"))
    labelled = asked.join(splittable(decided, ["_digest"]), "_digest").drop("_digest")
    silent = known.where(blank).withColumn(
        "sentiment", blank_label(plain_text(F.col(comment)), F.lit(None).cast("string"))
    )
    return labelled.unionByName(silent)


def review_features(
    reviews: DataFrame, run_sentiment: bool = False, predictor: Predictor = None
) -> DataFrame:
    """Review scores per order; with sentiment, also whether score and comment agree.

    Without sentiment the comment is just dropped. With it, reviews without a comment go. The
    default predictor is the built-in lexicon.
    """
    if not run_sentiment:
        return reviews.drop("review_comment_message")
    checked = review_sentiment(reviews, predictor).where(F.col("sentiment") != NO_COMMENT)
    return checked.withColumn(
        "is_verified", verified_rating(F.col("sentiment"), F.col("review_score"))
    ).drop("review_comment_message")


def product_features(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; an unknown category becomes null."""
    return lookup_replace(
        products,
        "product_category_name",
        translation,
        "product_category_name",
        "product_category_name_english",
    )


def tagged_customers(customers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Customers with 1 where their city is among the most frequent, else 0."""
    flag = "high_density_customer_area"
    tagged = in_top_values(customers, "customer_city", settings.dense_cities, flag)
    return tagged.select(*customers.columns, F.col(flag).cast("int").alias(flag))


def first_located(items: DataFrame, shops: DataFrame) -> DataFrame:
    """(order_id, seller_lat, seller_lng) of each order's first item whose seller has coordinates.

    The first item of all settles nearly every order, so one short row per order goes to the
    sellers, not all items. Only orders whose first seller has no coordinates bring all of their
    items. A seller that occurs twice has its smallest coordinates.
    """
    place = ["seller_lat", "seller_lng"]
    shops = shops.groupBy("seller_id").agg(F.min(F.struct(*place)).alias("_place"))
    shops = splittable(shops.select("seller_id", *[F.col(f"_place.{c}") for c in place]), ["seller_id"])
    first = first_per_key(items, "order_id", ITEM_ORDER, ["seller_id"])
    tried = stored(first.join(shops, "seller_id", "left").select("order_id", *place), "tried")
    settled = F.col("seller_lat").isNotNull()
    open_orders = tried.where(~settled).select("order_id")
    others = items.join(open_orders, "order_id", "left_semi").join(shops, "seller_id")
    return tried.where(settled).unionByName(first_per_key(others, "order_id", ITEM_ORDER, place))


def order_distances(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    geolocation: DataFrame,
    labels: DataFrame,
) -> DataFrame:
    """Labelled orders with the distance between buyer and seller.

    The seller is the one of the first item whose seller has coordinates. Since the buyer is
    the same for all items of an order, items are reduced to that one before orders and
    customers are joined.
    """
    buyers = coordinates(
        customers, geolocation, "customer_zip_code_prefix", "customer",
        ["customer_id", "high_density_customer_area"],
    )
    shops = coordinates(sellers, geolocation, "seller_zip_code_prefix", "seller", ["seller_id"])
    first = first_located(items, shops)
    distances = (
        orders.select("order_id", "customer_id")
        .join(first, "order_id")
        .join(buyers, "customer_id")
        .select(
            "order_id",
            haversine_km(
                F.col("customer_lat"), F.col("customer_lng"),
                F.col("seller_lat"), F.col("seller_lng"),
            ).alias("distance_km"),
            "high_density_customer_area",
        )
    )
    return labels.join(distances, "order_id").select(
        *labels.columns, "distance_km", "high_density_customer_area"
    )


def distance_seller_stats(order_distances: DataFrame, bucketed: bool = False) -> DataFrame:
    """Add each seller's share of repeat buyers.

    ``bucketed``: the orders lie in buckets and stay there. Only order and seller go to the
    rates, which come back by order; the seller is compared as a range, as in ``model_inputs``.
    """
    rates = splittable(repeat_rate_per_seller(order_distances), ["seller_id"])
    rate = "seller_repeat_buyer_rate"
    if not bucketed:
        return order_distances.join(rates, "seller_id", "left").select(
            *order_distances.columns, rate
        )
    found = (
        order_distances.select("order_id", "seller_id")
        .join(rates, "seller_id")
        .groupBy("order_id", "seller_id")
        .agg(F.max(rate).alias(rate))
        .select(F.col("order_id").alias("_order"), F.col("seller_id").alias("_seller"), rate)
    )
    same = (F.col("order_id") == F.col("_order")) & F.col("seller_id").between(
        F.col("_seller"), F.col("_seller")
    )
    return order_distances.join(found, same, "left").select(*order_distances.columns, rate)


# The columns of the model table.
MODEL_COLUMNS = [
    "deli_duration_exp", "deli_duration_paid", "deli_cost", "free_delivery",
    "is_bulk", "discount", "item_price", "high_price",
    "credit_card", "voucher", "debit_card", "boleto",
    "total_spent", "installment",
    "distance_km", "high_density_customer_area", "seller_repeat_buyer_rate",
    "review_score",
    "product_category_name", "product_name_length", "product_description_length",
    "product_photos_qty", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm",
    "is_repeat_buyer",
]


def described_classes(products: DataFrame, described: list[str]) -> tuple[DataFrame, DataFrame]:
    """Products without a missing value by their description: (product_id, product_class) and
    (product_class, description). A class is a number; it stands for one description.

    The classes are written once, so a number means the same wherever it is read.
    """
    known = products.select("product_id", *described).na.drop()
    classes = known.select(*described).distinct()
    classes = stored(
        classes.withColumn("product_class", F.monotonically_increasing_id()), "classes"
    )
    members = known.join(splittable(classes, described), described)
    return members.select("product_id", "product_class"), classes


def model_inputs(
    transactions: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    seller_stats: DataFrame,
) -> DataFrame:
    """Distinct complete feature rows.

    An item gets a distance only if it is its order's first (same product and seller). Rows
    with a missing value are dropped in the end, so every join may be inner; several reviews
    of an order still multiply its rows. All joins by order come first and have the order as
    their only key, so layers in buckets of it need no shuffle; the other keys are compared as
    ranges, which Spark leaves to the join's condition.

    Whole rows move once, to become distinct. Only order and product go to the products and come
    back with the number of the product's description, which stands for it in the rows until
    they are distinct; items of products without a full description leave before they move.
    """
    same = ["product_id", "seller_id", "customer_id", "customer_unique_id"]
    columns = MODEL_COLUMNS + (["is_verified"] if "is_verified" in reviews.columns else [])
    review_columns = [c for c in ("review_score", "is_verified") if c in reviews.columns]
    described = [c for c in MODEL_COLUMNS if c in products.columns]
    members, classes = described_classes(products, described)
    found = (
        seller_stats.select("order_id", "product_id")
        .distinct()
        .join(splittable(members, ["product_id"]), "product_id")
        .select(
            F.col("order_id").alias("_order"), F.col("product_id").alias("_product"),
            "product_class",
        )
    )
    same_pair = (F.col("order_id") == F.col("_order")) & F.col("product_id").between(
        F.col("_product"), F.col("_product")
    )
    distances = seller_stats.drop("num_orders", "is_repeat_buyer").withColumnsRenamed(
        {c: f"_{c}" for c in same}
    )
    joined = transactions.join(distances, "order_id")
    for c in same:
        joined = joined.where(F.col(c).between(F.col(f"_{c}"), F.col(f"_{c}")))
    joined = joined.join(reviews.select("order_id", *review_columns), "order_id").join(
        found, same_pair
    )
    own = [c for c in columns if c not in described]
    rows = joined.select("product_class", *own).na.drop().distinct()
    return rows.join(splittable(classes, ["product_class"]), "product_class").select(*columns)
