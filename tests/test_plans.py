"""Physical plans and the registered queries."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from checks.fixture import Fixture
from encore.operators import aggregates, joins, ranking

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_jobs_stay_in_the_jvm_without_nested_loops(spark):
    f = Fixture(spark, SF)
    for df in (f.labels, f.transactions, f.distances, f.seller_stats, f.model_inputs):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_data_never_goes_to_one_task(spark):
    f = Fixture(spark, SF)
    text = plan(f.transactions) + plan(f.labels) + plan(f.model_inputs)
    assert "SinglePartition" not in text


def test_scans_are_pruned_and_filters_pushed(spark):
    f = Fixture(spark, SF)
    text = plan(f.raw("lineitem").where("l_returnflag = 'R'").select("l_orderkey"))
    assert "EqualTo(l_returnflag,R)" in text and "l_comment" not in text
    text = plan(f.labels)
    assert "order_estimated_delivery_date" not in text  # labels need none of the dates


def test_registered_queries_have_matching_names():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 130


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "order_id" and df.count() > 1000


def test_a_hot_order_is_split_and_stays_whole(spark):
    """A third of all items belongs to one order: adaptive joins must read it in pieces."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        n = 60_000
        items = spark.range(0, n, 1, 8).selectExpr(
            "if(id % 3 = 0, 7, id) as order_id", "cast(id as int) as order_item_id",
            "if(id % 3 = 0, 1, id % 50) as product_id", "id % 9 as seller_id",
            "cast(pmod(xxhash64(id), 1000000007) as double) as price", "1.0D as freight_value")
        pairs = aggregates.pair_counts(items).where("product_qty > 1")
        joined = items.join(
            joins.splittable(pairs, ["order_id", "product_id"]), ["order_id", "product_id"], "left")
        assert joined.where("product_qty is not null").count() == n // 3
        counted = joined.groupBy("seller_id").agg(F.sum(F.col("price") * F.col("product_qty")).alias("q"),
                                                  F.count("*").alias("n"))
        assert sum(r.n for r in counted.collect()) == n
        assert "skewed" in plan(counted)
        totals = joins.splittable(aggregates.price_totals(items), ["product_id"])
        flags = items.join(totals, "product_id", "left").groupBy(aggregates.below_mean()).count()
        assert sum(r["count"] for r in flags.collect()) == n and "skewed" in plan(flags)
        first = ranking.first_per_key(items, "order_id", ["order_item_id"], ["product_id"])
        assert "partial_min" in plan(first) and first.where("order_id = 7").count() == 1
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
