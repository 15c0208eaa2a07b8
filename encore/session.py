"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on: UTC dates, ANSI errors, adaptive joins that split hot keys also when
# that costs one more shuffle.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Scratch data is written once and read a few times; files are smaller than by the default.
COMPRESSION = "zstd"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/encore/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    """Give iterative trainers a reliable checkpoint folder if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark, "checkpoints"))
