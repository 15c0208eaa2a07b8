"""CSV whose quoted text may hold line breaks, read by many tasks per file.

Files are split between tasks as plain lines. Whether a line begins inside quotes follows from
the parity of the quotes before it: inside its block from a running count, and before the block
from one parity per block, of which there is a small table. Only lines of records that span
several lines are gathered by a shuffle; ``from_csv`` parses the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from encore.session import stored


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the records of CSV files; ``first`` marks the first of each file.

    A quote inside quoted text is doubled, so a record ends at the first line break behind an
    even number of quotes. A file with an unbalanced quote ends in one long record, as it does
    for a reader of whole files. A carriage return before the break that ends a record goes.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
            F.regexp_count("value", F.lit('"')).alias("quotes"),
        )
    )
    here = Window.partitionBy("file", "block").orderBy("at")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    # The last line that began a record, for a block that begins outside and inside quotes.
    began = {
        name: F.last(F.when(F.col("before") == parity, F.col("at")), ignorenulls=True).over(upto)
        for name, parity in (("outside", 0), ("inside", 1))
    }
    lines = stored(
        lines.withColumn("before", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        .withColumns(began)
        .withColumn("first", (F.col("block") == 0) & (F.row_number().over(here) == 1)),
        "lines",
    )
    begin = F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside"))
    previous = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        lines.groupBy("file", "block")
        .agg(
            (F.sum("quotes") % 2).alias("turns"),
            F.max("outside").alias("outside"),
            F.max("inside").alias("inside"),
        )
        .withColumn("open", F.coalesce(F.sum("turns").over(previous), F.lit(0)) % 2)
        .withColumn("begun", begin)
        .withColumn("carried", F.last("begun", ignorenulls=True).over(previous))
        .select(F.col("file").alias("file_"), F.col("block").alias("block_"), "open", "carried")
    )
    same = (F.col("file") == F.col("file_")) & (F.col("block") == F.col("block_"))
    after = (F.col("before") + F.col("quotes")) % 2
    placed = lines.join(blocks, same).select(
        "file",
        "at",
        "value",
        "first",
        ((F.col("before") == F.col("open")) & (after == F.col("open"))).alias("whole"),
        F.coalesce(begin, "carried").alias("begun"),
    )
    single = placed.where("whole").select(F.col("value").alias("record"), "first")
    spanning = (
        placed.where("not whole")
        .groupBy("file", "begun")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"),
            F.max("first").alias("first"),
        )
        .select(F.concat_ws("\n", F.col("parts.value")).alias("record"), "first")
    )
    return single.union(spanning).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headed CSV with line breaks in quoted text; rows as the reader of whole files gives them."""
    if isinstance(schema, T.StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    records = quoted_lines(spark, path).where("not first and record <> ''")
    return records.select(F.from_csv("record", schema, {"escape": '"'}).alias("row")).select("row.*")
