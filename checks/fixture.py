"""Access to the fixture views and the job results over them.

Results that several jobs read are written once per application and read back, like the
layers of a catalog; the query of a job itself always runs that job.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.local import own_scratch_folder
from checks.twins import FIRST_YEAR, LAST_YEAR
from checks.views import BASE_TABLES, FIXTURE, with_views
from encore.plans import cleaning, features
from encore.plans.settings import Settings
from encore.session import COMPRESSION, configure, scratch_folder
from encore.sources.layers import MOST_UNEVEN, read_buckets, scanned, uneven, write_buckets

SETTINGS = Settings(first_year=FIRST_YEAR, last_year=LAST_YEAR)

# Layers that jobs join by order, in buckets of it: those that come straight from a scan, whose
# tasks write the buckets, and those that come from a join by order, which already deals them
# out like the buckets.
FROM_SCAN = {"clean_orders", "clean_items", "clean_payments"}
BY_ORDER = FROM_SCAN | {"labels", "distances"}

# Tables already written for this application: (application, folder, name) -> path, schema and,
# if the table is read in buckets, their number.
_WRITTEN: dict[tuple[str, str, str], tuple[str, T.StructType, int | None]] = {}


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        own_scratch_folder(spark)
        self.sf_dir = str(sf_dir).rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        """A fixture view as DataFrame."""
        sql = with_views(f"select * from {name}", FIXTURE)
        for table in BASE_TABLES:
            if re.search(rf"\b{table}\b", sql):
                self.raw(table).createOrReplaceTempView(table)
        return self.spark.sql(sql)

    def __getattr__(self, name: str) -> DataFrame:
        if f"fx_{name}" in FIXTURE:
            return self.view(f"fx_{name}")
        raise AttributeError(name)

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Write a shared result once per application and read it back.

        The layers that jobs join by order lie in as many buckets as there are shuffle
        partitions, so their rows are shuffled once at most; with a hot order they are read as
        files.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            path = scratch_folder(self.spark, name)
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            df = build()
            if name in BY_ORDER:
                if name in FROM_SCAN:
                    df = scanned(df, "order_id", buckets)
                else:
                    df = df.repartition(buckets, "order_id")
                write_buckets(df, path, "order_id", buckets)
                files = self.spark.read.schema(df.schema).parquet(path)
                even = uneven(files, buckets) <= MOST_UNEVEN
                _WRITTEN[key] = path, df.schema, buckets if even else None
            else:
                df.write.parquet(path, compression=COMPRESSION)
                _WRITTEN[key] = path, df.schema, None
        path, schema, buckets = _WRITTEN[key]
        files = self.spark.read.schema(schema).parquet(path)  # without rows there is no file
        return read_buckets(self.spark, path, files, "order_id", buckets) if buckets else files

    def in_buckets(self, name: str) -> bool:
        """Whether a layer, once written, is read in buckets."""
        self.stored(name)
        return _WRITTEN[self.spark.sparkContext.applicationId, self.sf_dir, name][2] is not None

    def stored(self, name: str) -> DataFrame:
        """A job's result as its consumers read it: from the files of its layer."""
        return self.written(name, lambda: getattr(self, name))

    @property
    def clean_orders(self) -> DataFrame:
        return cleaning.clean_orders(self.orders, SETTINGS)

    @property
    def clean_items(self) -> DataFrame:
        return cleaning.clean_items(self.items, SETTINGS)

    @property
    def clean_payments(self) -> DataFrame:
        return cleaning.clean_payments(self.payments, SETTINGS)

    @property
    def clean_customers(self) -> DataFrame:
        return cleaning.clean_customers(self.customers)

    @property
    def clean_sellers(self) -> DataFrame:
        return cleaning.clean_sellers(self.sellers)

    @property
    def clean_geolocation(self) -> DataFrame:
        return cleaning.clean_geolocation(self.geolocation, SETTINGS)

    @property
    def clean_reviews(self) -> DataFrame:
        return cleaning.clean_reviews(self.reviews, SETTINGS)

    @property
    def clean_products(self) -> DataFrame:
        return cleaning.clean_products(self.products)

    @property
    def labels(self) -> DataFrame:
        return cleaning.mega_id_labels(
            self.stored("clean_orders"), self.stored("clean_items"),
            self.stored("clean_customers"),
        )

    @property
    def tagged_customers(self) -> DataFrame:
        return features.tagged_customers(self.stored("clean_customers"), SETTINGS)

    @property
    def product_features(self) -> DataFrame:
        return features.product_features(self.clean_products, self.translation)

    @property
    def review_features(self) -> DataFrame:
        return features.review_features(self.clean_reviews)

    def _transactions(self, wanted: DataFrame | None = None) -> DataFrame:
        return features.transaction_features(
            self.stored("clean_orders"), self.stored("clean_items"),
            self.stored("clean_payments"),
            self.stored("labels"), SETTINGS, wanted, self.in_buckets("clean_items"),
            deal_prices=wanted is not None,
        )

    @property
    def transactions(self) -> DataFrame:
        return self._transactions()

    @property
    def distances(self) -> DataFrame:
        return features.order_distances(
            self.stored("clean_items"), self.stored("clean_orders"), self.tagged_customers,
            self.clean_sellers, self.clean_geolocation, self.stored("labels"),
        )

    @property
    def seller_stats(self) -> DataFrame:
        return features.distance_seller_stats(
            self.stored("distances"), self.in_buckets("distances")
        )

    @property
    def model_inputs(self) -> DataFrame:
        return features.model_inputs(
            self._transactions(wanted=self.stored("distances")), self.product_features,
            self.review_features, self.seller_stats,
        )

    @property
    def model_table(self) -> DataFrame:
        """The model table from files, as the training jobs read it."""
        return self.stored("model_inputs")


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles and print timestamps, so that both engines' results compare."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6) + F.lit(0.0)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)
