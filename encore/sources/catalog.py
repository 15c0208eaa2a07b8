"""Reading and writing tables, reports and models by name under one base folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from encore.operators.profile import observed, observed_info
from encore.sources.layers import (
    MOST_UNEVEN, by_bucket, read_buckets, read_layout, uneven, write_buckets, write_layout,
)
from encore.sources.quoted_lines import read_quoted_csv
from encore.sources.schemas import RAW, REPORTS

MODELS = [
    "random_forest", "logistic", "boosted_a", "boosted_b", "tuned_logistic", "ssl_logistic",
]

# Free text may hold line breaks; such files are split where records end.
MULTI_LINE = {"reviews"}

# Name -> (format, path below the base folder).
TABLES: dict[str, tuple[str, str]] = {
    **{name: ("csv", f"raw/{name}") for name in RAW},
    **{
        name: ("parquet", f"{layer}/{name}")
        for layer, names in {
            "intermediate": [
                "clean_orders", "clean_items", "clean_payments", "clean_customers",
                "clean_geolocation", "clean_sellers", "clean_reviews", "clean_products",
            ],
            "primary": ["mega_id_labels"],
            "feature": [
                "transaction_features", "review_features", "product_features",
                "tagged_customers", "order_distances", "distance_seller_stats",
            ],
            "model_input": ["model_inputs", "weak_positive_mask", "pseudo_labeled_data"],
            "model_output": [
                f"{model}_{kind}"
                for model in MODELS
                for kind in ["predictions_test", "top_10_predictions", "pr_curve", "roc_curve"]
            ],
        }.items()
        for name in names
    },
    **{f"{model}_metrics": ("json", f"reporting/{model}_metrics") for model in MODELS},
    "ssl_bias_report": ("csv", "reporting/ssl_bias_report"),
    "train_columns": ("json", "models/train_columns"),
}


# Layers that later jobs join by a key, which a catalog with buckets writes in buckets of it.
BUCKET_KEYS = {
    **dict.fromkeys(
        ["clean_orders", "clean_items", "clean_payments", "clean_reviews", "mega_id_labels",
         "transaction_features", "review_features", "order_distances", "distance_seller_stats"],
        "order_id",
    ),
    **dict.fromkeys(["clean_products", "product_features"], "product_id"),
    **dict.fromkeys(["clean_customers", "tagged_customers"], "customer_id"),
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """Headed CSV; a quote inside quoted text is doubled. Files are read by many tasks, also
    where quoted text may hold line breaks (``multi_line``)."""
    if multi_line:
        return read_quoted_csv(spark, path, schema)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


class Catalog:
    """Tables by name under a base folder, e.g. an object store path.

    With ``buckets`` the layers of BUCKET_KEYS are written in so many buckets of their key, and
    joins by it read them without a shuffle. Choose it so that a bucket of the largest layer
    fits a task. Where a hot key makes a bucket much larger than the mean, its layer is read
    as a plain folder: the join then shuffles, and adaptive execution can split the key. How a
    layer lies is noted beside it, so catalogs with other buckets, or none, read it rightly.
    """

    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None,
                 summaries: bool = False):
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self.summaries = summaries
        self._summaries: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{TABLES[name][1]}"

    def load(self, name: str) -> DataFrame:
        fmt = TABLES[name][0]
        if fmt == "csv" and name in RAW:
            return read_csv(self.spark, self.path(name), RAW[name], name in MULTI_LINE)
        if fmt == "csv":
            return read_csv(self.spark, self.path(name), REPORTS[name])
        found = self.spark.read.format(fmt).load(self.path(name))
        return self._bucketed(found, name) if name in BUCKET_KEYS else found

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and return it as read back: later jobs start from the files.

        It is read with the table's own schema, so nothing is scanned to infer one. JSON keeps
        fields that are null. With ``summaries`` counts and extremes are taken during the write.
        """
        fmt = TABLES[name][0]
        key = BUCKET_KEYS.get(name) if self.buckets else None
        rows, seen = by_bucket(df, key, self.buckets) if key else df, None
        if self.summaries:
            rows, seen = observed(rows)
        if name in BUCKET_KEYS:  # until the new files are complete, nobody may rely on buckets
            write_layout(self.spark, self._layout(name), None, None)
        if fmt == "csv":
            write_csv(rows, self.path(name))
        elif key:
            write_buckets(rows, self.path(name), key, self.buckets)
        else:
            writer = rows.write.mode("overwrite").format(fmt)
            if fmt == "json":
                writer = writer.option("ignoreNullFields", False)
            writer.save(self.path(name))
        if seen:
            self._summaries[name] = observed_info(df, seen)
        if fmt == "csv":
            return read_csv(self.spark, self.path(name), df.schema, name in MULTI_LINE)
        back = self.spark.read.schema(df.schema).format(fmt).load(self.path(name))
        if key and uneven(back, self.buckets) <= MOST_UNEVEN:
            write_layout(self.spark, self._layout(name), key, self.buckets)
        return self._bucketed(back, name) if key else back

    def summary(self, name: str) -> DataFrame:
        """(position, column, type, non_null, nulls, minimum, maximum, n_rows) of a table that
        this catalog has saved with ``summaries``; no scan."""
        return self._summaries[name]

    def _layout(self, name: str) -> str:
        return f"{self.base}/layouts/{name}"

    def _bucketed(self, files: DataFrame, name: str) -> DataFrame:
        key, buckets = read_layout(self.spark, self._layout(name))
        if not key:
            return files
        return read_buckets(self.spark, self.path(name), files, key, buckets)

    def save_model(self, model: PipelineModel, name: str) -> None:
        model.write().overwrite().save(f"{self.base}/models/{name}")

    def load_model(self, name: str) -> PipelineModel:
        return PipelineModel.load(f"{self.base}/models/{name}")
