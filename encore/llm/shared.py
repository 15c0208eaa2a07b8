"""Helpers of the corpus operators: scratch tables, column names and vectorised word hashes."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are neither space nor U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 1 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="encore-llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there.

    The shuffle files of the write go when it ends. Otherwise they stay until the driver happens
    to collect its garbage, and a job of many writes holds all of them at once.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def words(text: Column | str) -> Column:
    """The words of a text as an array; empty for null."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column | str) -> Column:
    """The number of words; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(texts: list[bytes]) -> list[tuple[int, int]]:
    """Index ranges of consecutive texts with about SLICE_BYTES each."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= SLICE_BYTES:
            out.append((start, i + 1))
            start, size = i + 1, 0
    if start < len(texts):
        out.append((start, len(texts)))
    return out


U = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    x = x + U(salt)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix(np.arange(256, dtype=U), 0x5851F42D4C957F2D)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, base, dtype=U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= SLICE_BYTES + 4096:
            _POWERS[base] = have
    return have[:n]


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def hashed_words(
    texts: list[bytes], separator: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and where each text's words begin.

    ``separator`` tells for every byte whether it separates words; a space always has to.
    """
    buffer = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate(([0], np.cumsum(lengths)))
    space = separator[buffer]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(buffer) + 1, dtype=U)
    np.cumsum(_BYTES[buffer] * _powers(_BASE, len(buffer)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(buffer) + 1)[starts])
    return hashes, np.searchsorted(starts, text_starts)
