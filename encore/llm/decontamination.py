"""Benchmark passages in documents, found by winnowing. DataFrame functions only.

Words are runs of digits, letters a-z and characters from U+0080 on, after A-Z are lower-cased.
A window is ``window`` consecutive words of an item; a shorter item is one window.

1. Fingerprints: hashes of all runs of ``k`` words; of every ``window - k + 1`` consecutive
   hashes the smallest is kept. A span of ``window`` words that document and item share has the
   same smallest hash in both, so it is never missed.
2. Fingerprints of documents meet those of the items. These are broadcast only while their
   counted number is at most ``broadcast_rows``; beyond it the join is a shuffle of
   (document digest, hash) rows.
3. Hits are extended: the documents that have one, once per distinct text, compare all their
   windows with the windows of the items.

Items shorter than a window have no guaranteed fingerprint. They are met by an anchor, the
longest of their words (ties: the greatest), and compared in full like the others.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import stored
from encore.operators.joins import splittable

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: At most this many hashes (8 bytes each) are broadcast.
BROADCAST_ROWS = 500_000


def item_words(text: Column) -> Column:
    lower = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("_hash", F.transform(item_words(F.col("text")), lambda w: F.xxhash64(w)))


def _run_hashes(hashes: str, n: int) -> Column:
    """Hashes of all runs of n words, in order; none if there are fewer words."""
    if n == 1:
        return F.transform(F.col(hashes), lambda x: F.xxhash64(x))
    starts = F.slice(
        F.col(hashes), F.lit(1), F.greatest(F.lit(0), F.size(hashes) - F.lit(n - 1))
    )
    rest = [lambda i, j=j: F.get(F.col(hashes), i + F.lit(j)) for j in range(1, n)]
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[f(i) for f in rest]))


def _fingerprints(df: DataFrame, window: int, k: int) -> DataFrame:
    """Adds the array ``_kept``: distinct smallest hashes of all windows. Needs ``_hash``.

    The minimum over ``w`` neighbours is built from minima over powers of two.
    """
    w = window - k + 1
    df = df.withColumn("_min", _run_hashes("_hash", k)).withColumn("_runs", F.size("_min"))
    span = 1
    while span < w:
        step = min(span, w - span)
        df = df.withColumn(
            "_min",
            F.zip_with(
                F.col("_min"),
                F.slice(F.col("_min"), F.lit(1 + step), F.greatest(F.size("_min"), F.lit(1))),
                lambda a, b: F.least(a, b),
            ),
        )
        span += step
    whole = F.slice(F.col("_min"), F.lit(1), F.greatest(F.col("_runs") - F.lit(w - 1), F.lit(1)))
    return df.withColumn("_kept", F.array_distinct(whole)).drop("_min", "_runs")


def _bounded(rows: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    small = rows.limit(limit + 1).count() <= limit
    return (F.broadcast(rows) if small else rows), small


# explode_outer throughout: for explode, Spark also filters by the size of the array and copies its
# whole expression into that filter, which multiplies at every step above.
def _meeting(docs: DataFrame, keys: DataFrame, column: str, limit: int) -> DataFrame:
    """(digest, text) of the distinct texts with a key in ``keys(key)``."""
    keys, small = _bounded(keys, limit)
    exploded = docs.select("digest", "text", F.explode_outer(column).alias("key"))
    if small:  # text stays where it was read
        found = exploded.join(keys, "key", "left_semi").select("digest", "text")
        return found.groupBy("digest").agg(F.max("text").alias("text"))
    found = exploded.select("digest", "key").join(keys, "key", "left_semi")
    found = splittable(found.select("digest").distinct(), ["digest"])
    return (
        docs.select("digest", "text").join(found, "digest", "left_semi")
        .groupBy("digest").agg(F.max("text").alias("text"))
    )


def _covered(hits: Column) -> Column:
    """Words in the union of (start, length) spans that are sorted by start."""
    start = F.struct(F.lit(0).alias("count"), F.lit(0).alias("end"))
    return F.aggregate(
        hits,
        start,
        lambda acc, x: F.struct(
            (
                acc["count"]
                + F.greatest(
                    F.lit(0), x["pos"] + x["len"] - F.greatest(acc["end"], x["pos"])
                )
            ).alias("count"),
            F.greatest(acc["end"], x["pos"] + x["len"]).alias("end"),
        ),
        lambda acc: acc["count"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    k: int = 6,
    share: int = 20,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of docs.

    n_hit counts words inside any occurrence of an item's window, n_items the items with one;
    a document is contaminated if n_hit > 0 and ``share`` * n_hit >= n_words. Null and empty
    texts have no words. Items without words are left out; those without id count for n_hit, but
    have no name to count in n_items. An id with several texts is one item. Equal texts are examined once and repeated rows give a row each. An empty
    benchmark hits nothing. Windows are compared by 64-bit hashes. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = stored(
        _with_hashes(items).select(
            "item_id", "text", "_hash", F.least(F.size("_hash"), F.lit(window)).alias("len")
        ).where("len > 0"),
        "items",
    )
    lengths = sorted(r[0] for r in items.select("len").distinct().collect())  # at most window

    texts = docs.where("text is not null").select(F.md5("text").alias("digest"), "text")
    candidates = []
    if window in lengths:
        kept = (
            _fingerprints(items.where(F.col("len") == window), window, k)
            .select(F.explode_outer("_kept").alias("key")).where("key is not null").distinct()
        )
        own = _fingerprints(_with_hashes(texts), window, k)
        candidates.append(_meeting(own, kept, "_kept", broadcast_rows))
    if lengths and lengths[0] < window:
        anchor = F.array_max(
            F.transform(
                item_words(F.col("text")),
                lambda w: F.struct(F.length(w).alias("size"), w.alias("word")),
            )
        )["word"]
        anchors = items.where(F.col("len") < window).select(
            F.xxhash64(anchor).alias("key")
        ).distinct()
        own = _with_hashes(texts).withColumn("_hash", F.array_distinct("_hash"))
        candidates.append(_meeting(own, anchors, "_hash", broadcast_rows))
    windows = None
    if candidates:
        found = candidates[0]
        for more in candidates[1:]:
            found = found.union(more)
        found = stored(
            _with_hashes(found.dropDuplicates(["digest"])).select("digest", "_hash"), "candidates"
        )
        for n in lengths:
            theirs = (
                items.where(F.col("len") == n)
                .select("item_id", F.explode_outer(_run_hashes("_hash", n)).alias("key")).distinct()
            )
            theirs, _ = _bounded(theirs, broadcast_rows)
            own = found.select("digest", F.posexplode_outer(_run_hashes("_hash", n)).alias("pos", "key"))
            one = own.join(theirs, "key").select("digest", "pos", F.lit(n).alias("len"), "item_id")
            windows = one if windows is None else windows.union(one)
    counted = docs.select(
        "doc_id",
        F.md5("text").alias("digest"),
        F.coalesce(
            F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)
        ).cast("long").alias("n_words"),
    )
    if windows is None:
        joined = counted.select("*", F.lit(None).cast("long").alias("n_hit"),
                                F.lit(None).cast("array<string>").alias("items"))
    else:
        hits = windows.groupBy("digest").agg(
            F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        ).select("digest", _covered(F.col("spans")).cast("long").alias("n_hit"), "items")
        joined = counted.join(splittable(hits, ["digest"]), "digest", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * F.lit(share) >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, decided row by row; columns are those of ``docs``.

    A row is known by a hash of its id and text: rows without an id are examined too, and of
    rows that share an id only those with a contaminated text go.
    """
    key = F.xxhash64("doc_id", "text")
    found = contamination(docs.select(key.alias("doc_id"), "text"), benchmark)
    drop = found.where("contaminated").select(F.col("doc_id").alias("row_key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("row_key"))
    return keyed.join(splittable(drop, ["row_key"]), "row_key", "left_anti").select("doc.*")
