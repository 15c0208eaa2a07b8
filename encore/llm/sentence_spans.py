"""Repeated passages, found by hashing runs of consecutive sentences.

Two runs are hashed for every sentence: the shortest with at least ``span_words`` words that begins
there and the shortest that ends there. Together they cover every passage of ``span_words`` words
or more to its last sentence. A text with fewer words is one run. The hashes are joined over all
documents. The first occurrence, by document id and position, stays; sentences that any other
occurrence covers are removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from encore.llm.shared import stored
from encore.operators.joins import splittable

SPAN_WORDS = 20
#: Documents whose runs are sampled for hot ones, and how often a hot run is in the sample.
SAMPLE_DOCS, HOT_IN_SAMPLE = 5000, 10
#: Rows of a hot run are dealt to so many windows.
SPREAD = 4096
_SPANS = "doc_id long, key long, first int, length int, hi long, lo long, hot boolean"
#: A sentence ends after . ! ? or … with closing quotes, before white space, and at line ends.
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?…]+[\"'”’)\]]*(?=\s|$)|(?=\n)|\Z)\s*", re.MULTILINE)


def sentences(text: str) -> list[str]:
    """The text cut into sentences, each with the white space after it."""
    return [s for s in _SENTENCE.findall(text) if s]


def runs(parts: list[str], span_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentences, 128-bit hash) of every run.

    White space before the first word belongs to the run that begins there.
    """
    words = [s.lower().split() for s in parts]
    count = [len(w) for w in words]
    total = sum(count)
    if not total:
        return []
    lead = next(i for i, n in enumerate(count) if n)
    bounds = set()
    if total < span_words:
        bounds.add((lead, len(parts)))
    end, held = 0, 0
    for i in range(len(parts)):
        while end < len(parts) and held < span_words:
            held += count[end]
            end += 1
        if held < span_words:
            break
        if count[i]:
            bounds.add((i, end))
        held -= count[i]
    start, held = 0, 0
    for i in range(len(parts)):
        held += count[i]
        while held - count[start] >= span_words or not count[start] and start < i:
            held -= count[start]
            start += 1
        if held >= span_words and count[i]:
            bounds.add((start, i + 1))
    joined = [" ".join(w) for w in words]
    out = []
    for a, b in sorted(bounds):
        run = " ".join(s for s in joined[a:b] if s)
        digest = hashlib.blake2b(run.encode("utf-8", "replace"), digest_size=16).digest()
        a = 0 if a == lead else a
        out.append((a, b - a, digest))
    return out


def _hash_runs(span_words: int, hot: frozenset[bytes] = frozenset()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            columns: tuple[list, ...] = ([], [], [], [], [], [], [])

            def made():
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.int32()),
                        pa.array(columns[4], pa.int64()),
                        pa.array(columns[5], pa.int64()),
                        pa.array(columns[6], pa.bool_()),
                    ],
                    ["doc_id", "key", "first", "length", "hi", "lo", "hot"],
                )

            for doc_id, key, text in zip(ids, keys, batch.column(2).to_pylist()):
                for first, length, digest in runs(sentences(text), span_words):
                    hi, lo = np.frombuffer(digest, dtype=np.int64)
                    row = (doc_id, key, first, length, int(hi), int(lo), digest in hot)
                    for column, value in zip(columns, row):
                        column.append(value)
                if len(columns[0]) >= 20_000:
                    yield made()
                    for column in columns:
                        column.clear()
            if columns[0]:
                yield made()

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, covered in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            parts = sentences(text or "")
            gone = np.zeros(len(parts), dtype=bool)
            for span in covered or ():
                gone[span["first"] : span["first"] + span["length"]] = True
            if gone.any():
                text = "".join(p for p, g in zip(parts, gone) if not g)
            words = sum(len(p.split()) for p, g in zip(parts, gone) if g)
            texts.append(text)
            counts.append((len(parts), int(gone.sum()), words))
        columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(texts, pa.string())],
            ["doc_id", "n_sentences", "n_removed", "n_words_removed", "text"],
        )


def remove_repeats(docs: DataFrame, span_words: int = SPAN_WORDS) -> DataFrame:
    """(doc_id, n_sentences, n_removed, n_words_removed, text), one row per row of ``docs``.

    ``text`` is the whole text without the removed sentences. Null texts stay null, empty ones
    empty. Rows equal in id and text count as one document, so they do not remove each other;
    rows that only share the id are documents of their own. Documents without id come first in
    the order of occurrences. Words are compared in lower case, white space as one space. An
    empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "key", F.xxhash64("text", "doc_id")
    )
    texts = source.where("text is not null").select("doc_id", "key", "text")
    draw = F.shiftrightunsigned(F.xxhash64("key", F.lit("sample")), 33) / F.lit(2.0**31)
    often = (
        texts.where(draw < F.lit(SAMPLE_DOCS / max(1, docs.count())))
        .mapInArrow(_hash_runs(span_words), _SPANS)
        .groupBy("hi", "lo").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_IN_SAMPLE)
        .collect()  # at most a tenth of the sampled runs
    )
    hot = frozenset(np.array([r.hi, r.lo], dtype=np.int64).tobytes() for r in often)
    found = stored(texts.mapInArrow(_hash_runs(span_words, hot), _SPANS), "spans")
    place = F.struct("doc_id", "key", "first")
    # A hot run's origin is combined before the shuffle, so that its rows need not meet; the others
    # meet in a window. Which way a run takes does not change the result.
    origins = stored(
        found.where("hot").groupBy("hi", "lo").agg(F.min(place).alias("origin")), "hot_spans"
    )
    spread = F.when(F.col("hot"), F.pmod("key", F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    here = Window.partitionBy("hi", "lo", "spread")
    covered = (
        found.join(F.broadcast(origins), ["hi", "lo"], "left")
        .withColumn("spread", spread)
        .withColumn("origin", F.coalesce("origin", F.min(place).over(here)))
        .where(place != F.col("origin"))
        .groupBy("key", "doc_id")
        .agg(F.collect_set(F.struct("first", "length")).alias("spans"))
        .select(F.col("key").alias("in_key"), F.col("doc_id").alias("in_doc"), "spans")
    )
    joined = source.join(
        splittable(covered, ["in_key"]),
        (F.col("key") == F.col("in_key")) & F.col("doc_id").eqNullSafe(F.col("in_doc")),
        "left",
    ).select("doc_id", "text", "spans")
    return joined.mapInArrow(
        _without,
        "doc_id long, n_sentences long, n_removed long, n_words_removed long, text string",
    )
