"""Layers in buckets, and what is counted while they are written."""

import re

import pytest
from pyspark.sql import functions as F

from checks.fixture import SETTINGS, Fixture
from checks.tables import QUERIES
from encore.operators import profile
from encore.plans import features
from encore.sources.catalog import Catalog
from encore.sources import layers
from encore.sources.layers import (
    read_buckets, scanned, stored_in_buckets, uneven, write_buckets,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df, key):
    return re.findall(rf"Exchange hashpartitioning\({key}#", plan(df))


def rows(df):
    return sorted(map(str, df.collect()))


def saved(f, catalog):
    return {
        name: catalog.save(f.stored(view), name)
        for name, view in {
            "clean_orders": "clean_orders", "clean_payments": "clean_payments",
            "mega_id_labels": "labels", "transaction_features": "transactions",
            "distance_seller_stats": "seller_stats", "review_features": "review_features",
            "product_features": "product_features",
        }.items()
    }


def test_joins_by_order_read_buckets_without_a_shuffle(spark, tmp_path, no_broadcast):
    f = Fixture(spark, SF)
    plain = saved(f, Catalog(spark, str(tmp_path / "plain")))
    lay = saved(f, Catalog(spark, str(tmp_path / "lay"), buckets=6))

    def inputs(t):
        return features.model_inputs(
            t["transaction_features"], t["product_features"], t["review_features"],
            t["distance_seller_stats"])

    def facts(t):
        return features.order_facts(
            t["clean_orders"], t["clean_payments"], t["mega_id_labels"], SETTINGS)

    for job in (inputs, facts):
        assert len(shuffles(job(plain), "order_id")) >= 2
        assert not shuffles(job(lay), "order_id")
        assert rows(job(lay)) == rows(job(plain)) and job(lay).count() > 100
    assert "SelectedBucketsCount" in plan(inputs(lay)) or "Bucketed: true" in inputs(
        lay)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_items_are_shuffled_whole_only_when_their_layer_is_written(spark, no_broadcast):
    f = Fixture(spark, SF)
    assert f.in_buckets("clean_items") and f.in_buckets("distances")
    for df in (f.transactions, f.model_inputs):
        moved = re.findall(r"Exchange hashpartitioning.*\n(.*)", plan(df))
        assert len(moved) > 3 and not [x for x in moved if "seller_id" in x and "price" in x]
    assert not re.findall(r"Exchange hashpartitioning.*\n.*order_item_id", plan(f.labels))
    for name in ("labels", "distances"):  # their last join has dealt them out
        keyed = plan(getattr(f, name).repartition(
            int(spark.conf.get("spark.sql.shuffle.partitions")), "order_id"))
        assert "REPARTITION_BY_NUM" not in keyed


def test_scanning_tasks_write_the_buckets(spark, tmp_path, no_broadcast, monkeypatch):
    n = 900
    raw = spark.range(n, numPartitions=3).selectExpr(
        "if(id % 50 = 0, null, id % 300) as order_id", "id as order_item_id", "'x' || id as note")
    raw.write.parquet(str(tmp_path / "raw"))
    df = spark.read.parquet(str(tmp_path / "raw"))
    path = str(tmp_path / "lay")
    assert "Exchange" not in plan(scanned(df, "order_id", 6))
    write_buckets(scanned(df, "order_id", 6), path, "order_id", 6)
    files = spark.read.parquet(path)
    assert len(files.inputFiles()) > 6 and uneven(files, 6) < 4
    back = read_buckets(spark, path, files, "order_id", 6)
    joined = back.join(back.groupBy("order_id").agg(F.count("*").alias("n")), "order_id")
    assert not shuffles(joined, "order_id") and rows(back) == rows(df)
    known = df.where("order_id is not null")
    assert rows(joined) == rows(
        known.join(known.groupBy("order_id").agg(F.count("*").alias("n")), "order_id"))
    monkeypatch.setattr(layers, "MOST_FILES", 6)
    assert "REBALANCE" in plan(scanned(df, "order_id", 6))


def test_layers_without_rows_are_read(spark, tmp_path):
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(
            str(tmp_path / f"{name}.parquet"))
    f = Fixture(spark, str(tmp_path))
    for name in ("clean_orders", "clean_items", "clean_payments"):
        assert f.stored(name).count() == 0 and f.stored(name).columns == getattr(f, name).columns


def test_orders_join_by_order_as_they_lie(spark, no_broadcast):
    f = Fixture(spark, SF)
    facts = features.order_facts(
        f.stored("clean_orders"), f.stored("clean_payments"), f.stored("labels"), SETTINGS)
    assert not shuffles(facts, "order_id") and facts.count() > 100


def test_feature_tables_are_shuffled_by_product_only(spark, no_broadcast):
    joined = plan(QUERIES["join_feature_tables"](Fixture(spark, SF)))
    assert not re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, product_id", joined)
    last = re.findall(r"Exchange hashpartitioning\(\w+#\d+L?, \d+\).*\n(.*item_price.*)", joined)
    assert len(last) == 1 and "review_score" in last[0]


def test_prices_and_rows_are_not_shuffled_by_product(spark, no_broadcast):
    text = plan(Fixture(spark, SF).model_inputs)
    by_product = r"Exchange hashpartitioning\(product_id#\d+L?, \d+\).*\n"
    assert not re.search(by_product + ".*partial_sum", text)
    assert not re.search(by_product + ".*(item_price|total_spent)", text)
    whole = [
        keys for keys in re.findall(r"Exchange hashpartitioning\((.*)\), ENSURE", text)
        if "item_price" in keys
    ]
    assert len(whole) == 1 and "product_class" in whole[0] and "category" not in whole[0]


@pytest.mark.parametrize("hot", [False, True])
def test_a_table_in_buckets_of_a_key(spark, hot):
    df = spark.range(4000).selectExpr(
        f"if({str(hot).lower()} or id % 9 = 0, 7, id) as k", "if(id % 5 = 0, null, id) as v")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        back = stored_in_buckets(df, "test", "k")
        sums = back.groupBy("k").agg(F.sum("v").alias("v"))
        assert bool(shuffles(sums, "k")) == hot
        assert rows(back) == rows(df) and rows(sums) == rows(
            df.groupBy("k").agg(F.sum("v").alias("v")))
        none = stored_in_buckets(df.limit(0), "test", "k")
        assert none.count() == 0 and none.dtypes == df.dtypes
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_hot_key_makes_a_plain_layer(spark, tmp_path, no_broadcast):
    n = 6000
    orders = spark.range(n).selectExpr(
        "if(id % 3 = 0, 7, id) as order_id", "id as order_item_id", "cast(null as string) as note")
    catalog = Catalog(spark, str(tmp_path), buckets=20)
    back = catalog.save(orders, "clean_items")
    assert rows(back) == rows(orders)
    assert uneven(back, 20) > 4
    joined = back.join(back.groupBy("order_id").agg(F.count("*").alias("n")), "order_id")
    assert shuffles(joined, "order_id")  # so that adaptive execution can split the key
    even = catalog.save(orders.withColumn("order_id", F.col("order_item_id")), "clean_items")
    joined = even.join(even.groupBy("order_id").agg(F.count("*").alias("n")), "order_id")
    assert not shuffles(joined, "order_id") and joined.count() == n


def test_catalogs_with_other_buckets_read_rightly(spark, tmp_path):
    a = spark.range(1000).selectExpr("id as order_id", "id * 2 as v")
    Catalog(spark, str(tmp_path), buckets=7).save(a, "clean_orders")
    for buckets in (None, 3, 20):
        catalog = Catalog(spark, str(tmp_path), buckets=buckets)
        assert rows(catalog.load("clean_orders")) == rows(a)
        assert catalog.load("clean_orders").where("order_id = 77").first().v == 154
    b = a.where("order_id < 500")
    Catalog(spark, str(tmp_path)).save(b, "clean_orders")  # a plain folder again
    assert rows(Catalog(spark, str(tmp_path), buckets=7).load("clean_orders")) == rows(b)
    none = Catalog(spark, str(tmp_path), buckets=7).save(a.limit(0), "clean_orders")
    assert none.count() == 0 and none.dtypes == a.dtypes
    nulls = a.withColumn("order_id", F.when(F.col("v") > 100, F.col("order_id")))
    back = Catalog(spark, str(tmp_path), buckets=7).save(nulls, "clean_orders")
    assert rows(back) == rows(nulls)


@pytest.mark.parametrize("buckets", [None, 5])
def test_summary_is_taken_while_writing(spark, tmp_path, buckets):
    df = spark.createDataFrame(
        [(3, "b", None, [1]), (1, None, 2.5, None), (2, "a", None, [2])] * 5,
        "order_id long, s string, d double, l array<int>")
    catalog = Catalog(spark, str(tmp_path), buckets, summaries=True)
    catalog.save(df, "clean_orders")
    got = {r.column: r for r in catalog.summary("clean_orders").collect()}
    wanted = {r.column: r for r in profile.table_info(df).collect()}
    for name, r in wanted.items():
        assert (got[name].position, got[name].type, got[name].non_null, got[name].n_rows) == (
            r.position, r.type, r.non_null, r.n_rows)
        assert got[name].nulls == r.n_rows - r.non_null
    assert (got["order_id"].minimum, got["order_id"].maximum) == ("1", "3")
    assert (got["s"].minimum, got["s"].maximum) == ("a", "b")
    assert (got["d"].minimum, got["l"].minimum, got["l"].non_null) == ("2.5", None, 10)
    catalog.save(df.limit(0), "clean_orders")
    empty = catalog.summary("clean_orders").first()
    assert (empty.n_rows, empty.non_null, empty.minimum) == (0, 0, None)
