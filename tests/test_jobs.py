"""Table jobs on small hand-made shops."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from encore.plans import cleaning, features
from encore.plans.settings import Settings

ORDER = ("order_id int, customer_id int, order_status string, order_purchase_timestamp string, "
         "order_approved_at string, order_delivered_carrier_date string, "
         "order_delivered_customer_date string, order_estimated_delivery_date string")


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, c, s, "2017-01-01 00:00:00", a, "2017-01-02 00:00:00", d, e) for i, c, s, a, d, e in rows],
        ORDER)


def test_clean_orders_runs_its_steps_in_order(spark):
    ok, due = "2017-01-01 10:00:00", "2017-01-20 00:00:00"
    got = cleaning.clean_orders(orders(spark, [
        (1, 1, "delivered", ok, "2017-01-10 00:00:00", due),
        (2, 2, None, ok, None, due),                          # kept, delivery estimated
        (3, 3, "canceled", ok, "2017-01-19 00:00:00", due),   # must not move the median
        (4, 4, "delivered", "2001-01-01 00:00:00", "2017-01-14 00:00:00", due),  # moves it, then goes
        (5, 5, "delivered", "bad", "2017-01-12 00:00:00", due),
    ]))
    assert "order_delivered_carrier_date" not in got.columns
    days = {r.order_id: r.d for r in got.select(
        "order_id", F.date_format("order_delivered_customer_date", "dd").alias("d")).collect()}
    assert days == {1: "10", 2: "12"}


def test_clean_geolocation(spark):
    schema = ("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
              "geolocation_city string, geolocation_state string")
    geo = spark.createDataFrame([
        ("1", -10.0, -50.0, "A", "x"), ("00001", -10.0, -50.0, "a ", "X"),  # duplicates once clean
        ("1", -10.4, -50.0, "a", "x"),
        ("2", -10.0, -50.0, "b", "x"), ("2", -10.6, -50.0, "b", "x"),       # too wide
        ("3", 60.0, -50.0, "c", "x"),                                       # outside
        ("4", -33.75116944, -50.0, "d", "x"),                               # on the edge
    ], schema)
    got = {r[0]: r[1] for r in cleaning.clean_geolocation(geo).collect()}
    assert got == {"00001": pytest.approx(-10.2), "00004": -33.75116944}
    assert cleaning.format_geolocation(geo).count() == 4


def test_clean_products(spark):
    schema = ("product_id int, product_category_name string, product_name_lenght double, "
              "product_description_lenght double, product_photos_qty double, product_weight_g double, "
              "product_length_cm double, product_height_cm double, product_width_cm double")
    df = spark.createDataFrame([
        (1, None, None, 10.0, None, 1.0, 1.0, 1.0, 1.0), (2, "c", 5.0, 1.0, 2.0, None, 1.0, 1.0, 1.0),
    ], schema)
    got = cleaning.clean_products(df).collect()
    assert [(r.product_id, r.product_category_name, r.product_name_length, r.product_photos_qty)
            for r in got] == [(1, "unknown", 0, 0)]


def shop(spark):
    """Two orders of one person, one of another; order 1 has three items."""
    items = spark.createDataFrame([
        (1, 2, "p2", "s1", 20.0, 1.0), (1, 1, "p1", "s2", 10.0, 0.0), (1, 3, "p1", "s2", 10.0, 2.0),
        (2, 1, "p1", "s1", 12.0, 3.0), (3, 1, "p2", "s1", 20.0, 1.0),
    ], "order_id int, order_item_id int, product_id string, seller_id string, price double, freight_value double")
    o = cleaning.clean_orders(orders(spark, [
        (i, 10 + i, "delivered", "2017-01-01 10:00:00", "2017-01-10 00:00:00", "2017-01-20 00:00:00")
        for i in (1, 2, 3)]))
    customers = spark.createDataFrame(
        [(11, "ann", "1", "x", "sp"), (12, "ann", "1", "x", "sp"), (13, "bob", "2", "y", "rj")],
        "customer_id int, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string")
    return items, o, cleaning.clean_customers(customers)


def test_labels_have_one_row_per_order(spark):
    items, o, customers = shop(spark)
    got = {r.order_id: r for r in cleaning.mega_id_labels(o, items, customers).collect()}
    assert {k: (r.product_id, r.seller_id, r.num_orders, r.is_repeat_buyer) for k, r in got.items()} == {
        1: ("p1", "s2", 2, True), 2: ("p1", "s1", 2, True), 3: ("p2", "s1", 1, False)}


def test_transaction_features(spark):
    items, o, customers = shop(spark)
    labels = cleaning.mega_id_labels(o, items, customers)
    payments = spark.createDataFrame(
        [(1, "voucher", 2, 30.0), (1, "boleto", 1, 10.0), (2, "credit_card", 3, 12.0)],
        "order_id int, payment_type string, payment_installments int, payment_value double")
    got = features.transaction_features(o, items, payments, labels).collect()
    assert sorted(r.order_id for r in got) == [1, 1, 1, 2]  # order 3 has no payment
    first = [r for r in got if r.order_id == 1 and r.product_id == "p1"]
    assert all(r.is_bulk and r.discount and r.deli_duration_exp == -10 for r in first)
    assert {r.free_delivery for r in first} == {True, False}
    assert (first[0].voucher, first[0].boleto, first[0].credit_card, first[0].installment) == (0.75, 0.25, 0.0, 3)


def test_distance_uses_first_item_with_coordinates(spark):
    items, o, customers = shop(spark)
    labels = cleaning.mega_id_labels(o, items, customers)
    geo = spark.createDataFrame(
        [("00001", -10.0, -50.0), ("00009", -11.0, -50.0)],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double")
    sellers = spark.createDataFrame([("s1", "00009"), ("s2", "00077")], "seller_id string, seller_zip_code_prefix string")
    got = features.order_distances(
        items, o, features.tagged_customers(customers), sellers, geo, labels).collect()
    # Order 1's first item is of s2, which has no coordinates: s1 counts. Bob's zip has none.
    assert {r.order_id: r.seller_id for r in got} == {1: "s2", 2: "s1"}
    assert all(r.distance_km == pytest.approx(111.195, abs=0.01) for r in got)


def test_first_located_settles_orders_by_few_rows(spark):
    items = spark.createDataFrame(
        [(1, 1, "p", "none"), (1, 2, "p", "far"), (1, 3, "p", "near"), (2, 2, "p", "far"),
         (2, 1, "p", "near"), (3, 1, "p", "none"), (4, 1, "p", None), (4, 2, "p", "twice")],
        "order_id int, order_item_id int, product_id string, seller_id string")
    shops = spark.createDataFrame(
        [("far", 5.0, 6.0), ("near", 1.0, 2.0), ("twice", 4.0, 1.0), ("twice", 3.0, 9.0)],
        "seller_id string, seller_lat double, seller_lng double")
    got = features.first_located(items, shops).collect()
    assert sorted(map(tuple, got)) == [(1, 5.0, 6.0), (2, 1.0, 2.0), (4, 3.0, 9.0)]


@pytest.mark.parametrize("bucketed", [False, True])
def test_items_that_nobody_joins_leave_early_and_change_nothing(spark, bucketed):
    items = spark.createDataFrame(
        [(1, 1, "p", "s", 1.0, 0.0), (1, 2, "p", "t", 3.0, 1.0), (1, 3, "p", "s", 2.0, 1.0),
         (2, 1, "p", "s", 2.5, 1.0), (2, 2, "q", "s", 7.0, 1.0), (3, 1, "q", "t", 8.0, 2.0)],
        "order_id int, order_item_id int, product_id string, seller_id string, price double, "
        "freight_value double")
    paid = spark.createDataFrame(
        [(i, "voucher", 1, 5.0) for i in (1, 2, 3)],
        "order_id int, payment_type string, payment_installments int, payment_value double")
    _, orders_, _ = shop(spark)
    some = orders_.limit(1).drop("order_id")
    orders_ = some.crossJoin(spark.createDataFrame([(1,), (2,), (3,)], "order_id int"))
    labels = spark.createDataFrame(
        [(i, i, "x", "p", "s", 1, False) for i in (1, 2, 3)],
        "order_id int, customer_id int, customer_unique_id string, product_id string, "
        "seller_id string, num_orders long, is_repeat_buyer boolean")
    whole = features.transaction_features(orders_, items, paid, labels, bucketed=bucketed)
    flags = {(r.order_id, r.product_id, r.item_price): (r.is_bulk, r.discount)
             for r in whole.collect()}
    assert flags == {  # the mean of p is 2.125, that of q 7.5
        (1, "p", 1.0): (True, True), (1, "p", 3.0): (True, False), (1, "p", 2.0): (True, True),
        (2, "p", 2.5): (False, False), (2, "q", 7.0): (False, True), (3, "q", 8.0): (False, False)}
    wanted = spark.createDataFrame(
        [(1, "p", "s"), (1, "p", "s"), (2, "p", "s"), (3, "q", "s")],
        "order_id int, product_id string, seller_id string")
    few = features.transaction_features(
        orders_, items, paid, labels, wanted=wanted, bucketed=bucketed)
    keys = {(1, "p", "s"), (2, "p", "s")}
    assert sorted(map(str, few.collect())) == sorted(
        str(r) for r in whole.collect() if (r.order_id, r.product_id, r.seller_id) in keys)
    assert few.count() == 3


def test_seller_rate_counts_people_not_orders(spark):
    df = spark.createDataFrame(
        [("s", "ann", True), ("s", "ann", True), ("s", "bob", False), ("t", "bob", False)],
        "seller_id string, customer_unique_id string, is_repeat_buyer boolean")
    got = {r.seller_id: r.seller_repeat_buyer_rate for r in features.distance_seller_stats(df).collect()}
    assert got == {"s": 0.5, "t": 0.0}


def test_seller_rates_come_back_by_order(spark):
    df = spark.createDataFrame(
        [(1, "s", "ann", True), (2, "s", "ann", True), (3, "s", "bob", False), (4, "t", "bob", False)],
        "order_id int, seller_id string, customer_unique_id string, is_repeat_buyer boolean")
    lost = df.unionByName(df.limit(1).withColumn("seller_id", F.lit(None).cast("string")))
    lost = lost.unionByName(df.limit(1))  # rows may repeat, too
    wanted = sorted(map(str, features.distance_seller_stats(lost).collect()))
    assert sorted(map(str, features.distance_seller_stats(lost, True).collect())) == wanted


def test_model_inputs_rules(spark):
    keys = dict(order_id=1, product_id="p", seller_id="s", customer_id=1, customer_unique_id="a")
    base = {c: 1.0 for c in features.MODEL_COLUMNS if c not in (
        "distance_km", "high_density_customer_area", "seller_repeat_buyer_rate", "review_score",
        "product_category_name") and not c.startswith("product_")}
    twin = spark.createDataFrame(pd.DataFrame([
        {**keys, **base}, {**keys, **base},                     # equal items collapse
        {**keys, **base, "product_id": "other"},                # not the first item: no distance
        {**keys, **base, "order_id": 2},                        # untranslated category
    ]).assign(product_id=["p", "p", "other", "q"]))
    stats = spark.createDataFrame(
        [(1, "p", "s", 1, "a", 2, True, 5.0, 1, 0.5), (2, "q", "s", 1, "a", 2, True, 5.0, 1, 0.5)],
        "order_id long, product_id string, seller_id string, customer_id long, customer_unique_id string, "
        "num_orders int, is_repeat_buyer boolean, distance_km double, high_density_customer_area int, "
        "seller_repeat_buyer_rate double")
    products = spark.sql(
        "select * from values ('p', 'cat', 1, 1, 1, 1D, 1D, 1D, 1D), ('other', 'cat', 1, 1, 1, 1D, 1D, 1D, 1D), "
        "('q', null, 1, 1, 1, 1D, 1D, 1D, 1D) t(product_id, product_category_name, product_name_length, "
        "product_description_length, product_photos_qty, product_weight_g, product_length_cm, "
        "product_height_cm, product_width_cm)")
    reviews = spark.createDataFrame([(1, 5), (1, 3), (2, 4)], "order_id long, review_score int")
    got = features.model_inputs(twin, products, reviews, stats)
    assert sorted(r.review_score for r in got.collect()) == [3, 5]  # two reviews, two rows
    assert got.columns == features.MODEL_COLUMNS
    verified = reviews.withColumn("is_verified", F.lit(True))
    assert features.model_inputs(twin, products, verified, stats).columns[-1] == "is_verified"


def test_model_inputs_of_products_with_equal_and_repeated_ids(spark):
    made = features.MODEL_COLUMNS
    late = [c for c in made if c.startswith("product_")]
    stat = ["distance_km", "high_density_customer_area", "seller_repeat_buyer_rate"]
    own = [c for c in made if c not in late + stat + ["review_score"]]
    same = ["order_id", "product_id", "seller_id", "customer_id", "customer_unique_id"]
    orders = [(n, p, 1, n, n) for n, p in enumerate([1, 1, 2, 3, 3, 4, 5, None, 9, 6, 7])]
    orders += [(0, 1, 1, 0, 0), (1, 2, 1, 1, 1), (None, 1, 1, 1, 1)]
    keys = spark.createDataFrame(orders, ", ".join(f"{c} long" for c in same))
    twin = keys.select("*", *[F.lit(1.0).alias(c) for c in own])
    stats = keys.dropDuplicates(["order_id"]).select(
        "*", F.lit(1).alias("num_orders"), F.lit(False).alias("is_repeat_buyer"),
        *[F.lit(2.0).alias(c) for c in stat])
    shapes = [(1, "a", 1.0), (1, "b", 1.0), (2, "a", 1.0), (3, "a", 1.0), (3, "a", 1.0), (4, None, 1.0),
              (5, "a", float("nan")), (None, "a", 1.0), (6, "a", 0.0), (7, "a", -0.0)]
    products = spark.createDataFrame(shapes, "product_id long, product_category_name string, w double")
    products = products.select(
        "product_id", "product_category_name", *[F.col("w").alias(c) for c in late[1:]])
    reviews = spark.createDataFrame([(n, n % 2) for n in range(9)] * 2 + [(9, 1), (10, 1)],
                                    "order_id long, review_score int")
    plain = (
        twin.join(stats.drop("num_orders", "is_repeat_buyer"), same)
        .join(reviews, "order_id").join(products, "product_id").select(*made).na.drop().distinct())
    got = features.model_inputs(twin, products, reviews, stats).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.collect())) and len(got) == 5


def test_review_features(spark):
    df = spark.createDataFrame(
        [(1, 5, "Tudo certo"), (2, 1, "ruim"), (3, 4, " "), (4, 4, None), (5, 5, "ruim")],
        "order_id int, review_score int, review_comment_message string")
    assert features.review_features(df).columns == ["order_id", "review_score"]

    def predict(texts):
        return texts.map(lambda t: "NEG" if "ruim" in t else "NEU")

    got = {r.order_id: (r.sentiment, r.is_verified)
           for r in features.review_features(df, True, lambda: predict).collect()}
    assert got == {1: ("positive", True), 2: ("negative", True), 5: ("negative", False)}
    default = {r.order_id: r.sentiment for r in features.review_features(df, True).collect()}
    assert default.keys() == got.keys() and set(default.values()) <= {"positive", "neutral", "negative"}


def test_defaults_are_usable():
    assert Settings().first_year == 2016 and len(Settings().numeric) == 17


def test_sentiment_predictors(spark):
    """The lexicon by default, a fitted pipeline, or a function on series; each in one label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IndexToString, Tokenizer

    rows = [("r1", 5, "Produto ótimo"), ("r2", 1, "chegou quebrado"), ("r3", 3, " "),
            ("r4", 4, "entrega normal"), ("r5", 2, None), ("r6", 1, "chegou quebrado")]
    reviews = spark.createDataFrame(
        rows, "order_id string, review_score int, review_comment_message string")

    def labels(predictor=None):
        return {r.order_id: r.sentiment
                for r in features.review_sentiment(reviews, predictor).collect()}

    assert labels() == {"r1": "positive", "r2": "negative", "r3": "No comment", "r4": "neutral",
                        "r5": "No comment", "r6": "negative"}
    train = spark.createDataFrame(
        [("produto ótimo", 0.0), ("chegou quebrado", 1.0), ("entrega normal", 1.0)],
        "text string, y double")
    model = Pipeline(stages=[
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="x", numFeatures=256),
        LogisticRegression(featuresCol="x", labelCol="y", maxIter=50),
        IndexToString(inputCol="prediction", outputCol="label", labels=["POS", "NEG"]),
    ]).fit(train)
    found = labels(model)
    assert (found["r1"], found["r2"], found["r4"]) == ("positive", "negative", "negative")
    plan = features.review_sentiment(reviews, model)._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan
    checked = features.review_features(reviews, True).collect()
    assert {(r.order_id, r.is_verified) for r in checked} == {
        ("r1", True), ("r2", True), ("r4", True), ("r6", True)}
