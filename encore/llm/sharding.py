"""Range sharding with sampled splitters. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from encore.llm.shared import stored

#: Ranges cut by sampled splitters, expected sample rows, rows above which a range is subdivided.
RANGES = 1024
SAMPLE = 16_384
RANGE_ROWS = 50_000

_CELL_BITS = 12  # ranges are looked up by the leading bits of a key
_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("text_crc32", T.LongType()),
        T.StructField("law", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("slot", T.LongType()),
        T.StructField("grown_shard", T.IntegerType()),
    ]
)


def _ranges(rows: DataFrame, total: int, ranges: int, sample: int) -> DataFrame:
    """(range, lo, hi) by quantiles of a sample that is weighted by size; at most ``ranges``."""
    expected = F.col("size") * F.lit(sample / total)
    draw = F.shiftrightunsigned(F.xxhash64("tie", F.lit("sample")), 33) / F.lit(2.0**31)
    drawn = rows.where(draw < expected).select(
        F.col("key").cast("double").alias("key"),
        F.greatest(F.lit(1), F.round(expected)).cast("long").alias("weight"),
    )
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    last = F.lit(2**63 - 1)
    bounds = drawn.agg(F.percentile("key", shares, F.col("weight")).alias("cut")).select(
        F.array_sort(
            F.array_distinct(
                F.transform(
                    F.coalesce("cut", F.array().cast("array<double>")),
                    lambda x: F.greatest(
                        F.lit(-(2.0**63)), F.least(x, F.lit(2.0**63 - 2048))
                    ).cast("long"),
                )
            )
        ).alias("cut")
    )
    bounds = bounds.select(F.concat(F.array(F.lit(-(2**63))), "cut", F.array(last)).alias("cut"))
    return bounds.select(F.posexplode("cut").alias("range", "lo"), "cut").select(
        "range", "lo", F.get("cut", F.col("range") + 1).alias("hi"), (F.size("cut") - 2).alias("n")
    ).where("range <= n").drop("n")


def balanced_shards(
    docs: DataFrame,
    shards: int = 16,
    ranges: int = RANGES,
    sample: int = SAMPLE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 1; null has none) of the shards
    are near equal, within one document. Records are ordered by a hash of their text, so equal
    texts are neighbours. A sample in which a record appears in proportion to its size gives the
    splitters of ``ranges`` ranges; a range with more than ``range_rows`` records, such as one
    that holds a hot text, is subdivided by a hash of text and id. Exact sums per range, then
    running sums inside each, place every record; slots count from 0 in that order.

    A null text has size 1 and checksum 0. Null ids are ordered like others; rows equal in id
    and text are interchangeable. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("key"),
        ).withColumn("tie", F.xxhash64("doc_id", "key")),
        "records",
    )
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    shift = 64 - _CELL_BITS
    looked_up = _ranges(rows, total, ranges, sample).select(
        "range", "lo", "hi",
        F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift))).alias("cell"),
    )  # at most ranges + 2**_CELL_BITS rows
    placed = (
        rows.withColumn("cell", F.shiftright("key", shift))
        .join(F.broadcast(looked_up), "cell")
        .where("key >= lo and (key < hi or hi = 9223372036854775807)")
        .drop("cell", "lo", "hi")
    )
    counted = placed.groupBy("range").agg(F.count("*").alias("n"))
    parts = counted.select("range", F.ceil(F.col("n") / range_rows).cast("int").alias("parts"))
    placed = stored(
        placed.join(F.broadcast(parts), "range").select(  # at most ``ranges`` rows
            "doc_id", "size", "text_crc32", "key", "tie", "range",
            F.floor(F.shiftrightunsigned("tie", 33) * F.col("parts") / F.lit(2.0**31))
            .cast("int").alias("part"),
        ),
        "placed",
    )
    parts = placed.groupBy("range", "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    whole = parts.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum("n").alias("c"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(  # at most ``ranges`` rows
        "range",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
    )
    inside = (
        Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.join(F.broadcast(whole), "range").select(
        "range",
        "part",
        (F.col("b0") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))).alias("b0"),
        (F.col("c0") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("c0"),
    )
    order = Window.partitionBy("range", "part").orderBy("tie", "key", "doc_id", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * (F.col("b0") + F.col("bytes")) - F.col("size")
    assigned = stored(
        placed.withColumn("bytes", F.sum("size").over(running))
        .withColumn("rank", F.row_number().over(order))
        .join(parts, ["range", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(
                F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * total))
            ).cast("int").alias("shard"),
            (F.col("c0") + F.col("rank")).alias("rank"),
        ),
        "assigned",
    )
    first = assigned.groupBy("shard").agg(F.min("rank").alias("first"))  # ``shards`` rows
    return assigned.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
