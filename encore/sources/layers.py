"""Layers in buckets: joins by the bucket key read the files as they lie, without a shuffle."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import COMPRESSION, scratch_folder

#: Rows of the largest bucket, as a multiple of the mean, up to which buckets serve joins.
MOST_UNEVEN = 4.0
#: Files up to which the tasks that scan a table write its buckets themselves.
MOST_FILES = 20_000
_LAYOUT = "key string, buckets int"


def _table_name(path: str) -> str:
    return f"encore_layer_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a Parquet folder whose files each hold rows of one bucket of ``key``.

    The shuffle before the write has a partition per bucket, so a bucket is one file; adaptive
    execution splits the partition of a hot key, whose bucket then has several.
    """
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("compression", COMPRESSION)
        .option("path", path)
        .saveAsTable(_table_name(path))
    )


def by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with one partition per bucket, but for hot ones; see ``write_buckets``."""
    return df.hint("rebalance", buckets, F.col(key))


def scanned(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows of a plan without a shuffle, to be written in buckets by the tasks that scan them.

    Each task writes a file per bucket, so no row moves; a hot key comes from several tasks.
    Where that would be more than ``MOST_FILES`` files, rows move to their bucket first.
    """
    few = df.rdd.getNumPartitions() * buckets <= MOST_FILES
    return df if few else by_bucket(df, key, buckets)


def read_buckets(
    spark: SparkSession, path: str, columns: DataFrame, key: str, buckets: int
) -> DataFrame:
    """A bucketed folder as a table whose partitioning Spark knows. ``columns`` has its schema.

    The session's catalog gets an external table; dropping it leaves the files.
    """
    name = _table_name(path)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"drop table if exists {name}")
    spark.sql(
        f"create table {name} ({ddl}) using parquet clustered by (`{key}`) "
        f"into {buckets} buckets location '{place}'"
    )
    return spark.table(name)


def uneven(files: DataFrame, buckets: int) -> float:
    """Rows of the largest bucket over the mean. Only row counts of files are read; the driver
    gets one number. 0 without rows."""
    number = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\.c\d+)?[^_]*$", 1)
    per_bucket = files.groupBy(number.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = per_bucket.agg(F.max("n"), F.sum("n")).first()
    return largest * buckets / rows if rows else 0.0


def stored_in_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write a scanned table to the shared folder in buckets of ``key`` and read it back.

    A grouping by the key then needs no shuffle: rows move once, in compressed columns. There are
    two buckets per core at most, so that files stay large. With a hot key the files are read as
    a plain folder, so that its rows are combined before they move.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(partitions, 2 * spark.sparkContext.defaultParallelism)
    write_buckets(scanned(df, key, buckets), path, key, buckets)
    files = spark.read.schema(df.schema).parquet(path)
    even = uneven(files, buckets) <= MOST_UNEVEN
    return read_buckets(spark, path, files, key, buckets) if even else files


def write_layout(spark: SparkSession, path: str, key: str | None, buckets: int | None) -> None:
    """Note how a layer lies: the key and number of its buckets, null for a plain folder."""
    spark.createDataFrame([(key, buckets)], _LAYOUT).write.mode("overwrite").json(path)


def read_layout(spark: SparkSession, path: str) -> tuple[str | None, int | None]:
    try:
        noted = spark.read.schema(_LAYOUT).json(path).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = None
    return (noted.key, noted.buckets) if noted else (None, None)
