"""Sessions on one machine, for tests, checks and measurements."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from encore.session import configure


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and local measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("encore")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    own_scratch_folder(spark)
    return configure(spark)


def own_scratch_folder(spark: SparkSession) -> None:
    """For tests and checks on one machine: a folder of its own if the session has none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="encore-"))
