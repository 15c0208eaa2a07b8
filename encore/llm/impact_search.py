"""Exact top-k inner products from an impact-ordered index, processed score at a time.

The index cuts rows into blocks of bounded size. In a block, every component has a posting list,
cut by value into segments of rows with nearly equal impact; a segment knows its least and
greatest value. For a query, a segment's impact is the most that its component can add above the
block's least possible score. Segments of all components are processed by descending impact; an
accumulator per row sums quantised impacts (rounded up) and counts the components seen. What a
row has not shown yet adds at most the impact of the next segment per component, so

    accumulated + unseen components * next impact

bounds its score. Rows whose bound is below a known score of rank k cannot be members. Processing
stops when that proof leaves few rows (or no impact is left), and these are scored exactly. All
of it is integer arithmetic, so no member is lost by rounding; equal scores stay in.

Known scores of rank k come from a bounded sample of rows that all queries are scored against;
they only decide how early the proof holds. Of rows with equal vectors only the k + 1 with the
smallest ids can be members, so a vector that a third of all rows share is indexed k + 1 times.
Queries are sent to all blocks in rounds of bounded size: a stated query set against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from encore.llm.centroids import finite, floored
from encore.llm.shared import stored

#: Components (rows times dimensions) of a block of the index.
BLOCK_CELLS = 1 << 19
#: Components of the queries that a block gets at once.
ROUND_CELLS = 1 << 16
#: Segments of a posting list.
SEGMENTS = 32
#: Rows that all queries are scored against for a first known score of rank k.
SAMPLE = 2048
#: Parts that copies of one vector are dealt to before their smallest ids are chosen.
PARTS = 64
_QUANTA = 1 << 12
_NO_ROWS = np.zeros(0, np.intp)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every sum stays below 2**53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def segments(vectors: np.ndarray, parts: int = SEGMENTS):
    """Posting lists of a block: rows by component and ascending segment, the segments' bounds in
    them, and each segment's least and greatest value (0 and -1 where it is empty)."""
    n, width = vectors.shape
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    step = (high - low) // parts + 1
    level = (vectors - low) // step
    order = np.ascontiguousarray(np.argsort(level, axis=0, kind="stable").T)
    bounds = np.zeros((width, parts + 1), dtype=np.int64)
    least, most = np.zeros((width, parts), np.int64), np.full((width, parts), -1, np.int64)
    for d in range(width):
        bounds[d, 1:] = np.cumsum(np.bincount(level[:, d], minlength=parts))
        sorted_ = vectors[order[d], d]
        used = np.flatnonzero(np.diff(bounds[d]))
        least[d, used] = np.minimum.reduceat(sorted_, bounds[d, used])
        most[d, used] = np.maximum.reduceat(sorted_, bounds[d, used])
    return order, bounds, least, most


def possible_members(query, known, n, order, bounds, least, most, few) -> np.ndarray:
    """Rows of a block that may score ``known`` or more; all others are proven not to.

    Stops as soon as at most ``few`` rows are left, or no unprocessed segment has an impact.
    """
    up = query > 0
    filled = most >= least
    low = np.where(filled, least, np.iinfo(np.int64).max).min(axis=1)
    high = np.where(filled, most, np.iinfo(np.int64).min).max(axis=1)
    base = int((query * np.where(up, low, high)).sum())
    weight = np.abs(query)[:, None]
    impact = weight * np.where(up[:, None], most - low[:, None], high[:, None] - least)
    impact = np.where(filled, impact, 0)
    ranked = np.argsort(-impact, axis=None, kind="stable")
    ranked = ranked[: np.count_nonzero(impact)]
    descending = impact.ravel()[ranked]
    if not len(ranked):
        return np.arange(n) if base >= known else np.zeros(0, np.int64)
    quantum = max(1, int(descending[0]) // _QUANTA)
    quantised = -(-descending // quantum)
    # One accumulator holds the sum and, in its low digits, the components seen. Sums are whole
    # numbers far below 2**53, so adding them as doubles is exact.
    digits = 1 << int(len(query)).bit_length()
    added = (quantised * digits + 1).astype(np.float64)
    parts = bounds.shape[1] - 1
    component, segment = ranked // parts, ranked % parts
    starts, ends = bounds[component, segment], bounds[component, segment + 1]
    cuts = list(zip(component.tolist(), starts.tolist(), ends.tolist()))
    lengths = ends - starts
    sizes = np.cumsum(lengths)
    total = np.zeros(n)
    active = int(np.count_nonzero(impact.any(axis=1)))
    # The proof is tried after a half, and then after every further eighth, of the postings.
    tries = np.searchsorted(sizes, sizes[-1] * np.arange(4, 9) / 8) + 1
    done = 0
    for until in np.minimum(tries, len(cuts)).tolist():
        rows = np.concatenate([order[d, a:b] for d, a, b in cuts[done:until]] or [_NO_ROWS])
        weights = np.repeat(added[done:until], lengths[done:until])
        total += np.bincount(rows, weights=weights, minlength=n)
        done = until
        ahead = int(descending[done]) if done < len(cuts) else 0
        seen = total.astype(np.int64)
        most_possible = base + (seen // digits) * quantum + (active - seen % digits) * ahead
        left = np.flatnonzero(most_possible >= known)
        if len(left) <= few:
            break
    return left


def _built(width: int):
    """One row per block: its rows, vectors and posting segments."""

    def run(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("cells"), width)
        postings, *parts = segments(vectors)
        data = {"block": group.column("block").slice(0, 1)}
        for name in ("row", "vec_id"):
            data[name] = pa.array([group.column(name).to_pylist()], pa.list_(pa.int64()))
        small = (vectors.astype(np.int32), postings.astype(np.int32))
        for name, x in zip(("vectors", *_PARTS), (*small, *parts)):
            data[name] = pa.array([x.tobytes()], pa.binary())
        return pa.table(data)

    return run


_PARTS = ("postings", "bounds", "least", "most")
_INDEX = "block long, row array<long>, vec_id array<long>, vectors binary" + "".join(
    f", {p} binary" for p in _PARTS
)


def _best(scores, ids, rows, k: int) -> np.ndarray:
    """Places of the k best: higher score, then smaller id (null last), then row."""
    return np.lexsort((rows, ids, -scores))[:k]


def _searched(width: int, k: int):
    """Per query of a round the best k rows of a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            block = {c: left.column(c)[0].as_py() for c in left.column_names}
            rows = np.array(block["row"], dtype=np.int64)
            ids = np.array(
                [np.iinfo(np.int64).max if i is None else i for i in block["vec_id"]], np.int64
            )
            n = len(rows)
            vectors = np.frombuffer(block["vectors"], np.int32).reshape(n, width).astype(np.int64)
            order = np.frombuffer(block["postings"], np.int32).reshape(width, n).astype(np.intp)
            bounds, least, most = (
                np.frombuffer(block[p], np.int64).reshape(width, -1) for p in _PARTS[1:]
            )
            queries = _matrix(right.column("cells"), width)
            known = right.column("known").to_pylist()
            for i, (q, own) in enumerate(
                zip(right.column("query_id").to_pylist(), right.column("row").to_pylist())
            ):
                bar = -(2**62) if known[i] is None else known[i]
                few = max(4 * k, n // 16)
                at = possible_members(queries[i], bar, n, order, bounds, least, most, few)
                at = at[rows[at] != own]
                scores = vectors[at] @ queries[i]
                best = _best(scores, ids[at], rows[at], k)
                for j in best:
                    found.append((own, q, block["vec_id"][at[j]], int(rows[at[j]]), int(scores[j])))
        columns = list(zip(*found)) or [[]] * 5
        return pa.table(
            {
                name: pa.array(column, pa.int64())
                for name, column in zip(("query", "query_id", "vec_id", "row", "score"), columns)
            }
        )

    return run


def _known(sample, width: int, k: int):
    """Queries with the k-th best score among the sampled rows (null if there are fewer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, vectors = sample.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                scores = _product(_matrix(part.column(2), width), vectors)
                own = part.column(1).to_numpy()
                scores[own[:, None] == rows] = -(2**62)
                known = np.full(len(own), -(2**62))
                if scores.shape[1] >= k:
                    known = np.partition(scores, -k, axis=1)[:, -k]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(known, mask=known == -(2**62))],
                    ["query_id", "row", "cells", "known"],
                )

    return run


def _distinct_enough(rows: DataFrame, k: int) -> DataFrame:
    """Rows that are among the k + 1 smallest (id, row) with their vector.

    A row with k + 1 smaller ones of equal score before it is in no top k, its own query's
    included. Copies are dealt to parts first, so no window holds a hot vector's rows.
    """
    rows = rows.withColumn("same", F.xxhash64("cells")).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.lit(PARTS))
    )
    by = [F.col("vec_id").asc_nulls_last(), F.col("row")]
    for keys in (["same", "cells", "part"], ["same", "cells"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        rows = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    return rows.select("row", "vec_id", "cells")


def _prepared(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    kept = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("cells")
    ).where(finite("cells"))
    return stored(
        kept.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", floored("cells").alias("cells")
        ),
        "vectors",
    )


def build_index(
    rows: DataFrame, width: int, block_cells: int = BLOCK_CELLS
) -> tuple[DataFrame, int]:
    """The stored index, a row per block with its rows, vectors and posting segments, and the
    number of blocks."""
    blocks = max(1, -(-rows.count() * max(1, width) // block_cells))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    index = dealt.groupBy("block").applyInArrow(_built(width), _INDEX)
    return stored(index, "index"), blocks


def top_k(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_cells: int = BLOCK_CELLS,
    round_cells: int = ROUND_CELLS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query row.

    Components become floor(256 * x). Candidates of a query are all other rows; ties go to the
    smaller vec_id. ``is_query`` is a condition on ``vec_id``. Vectors that are null or hold a
    null or non-finite component take no part. Fewer candidates than k: all of them.

    A null id is never a query and comes last among ties; repeated rows are rows of their own
    (a query's copy is a candidate). Vectors of unequal lengths are compared as if filled up
    with zeros; an empty vector scores 0 with all. An empty table gives no rows; other columns
    are ignored. Scores that could pass 2**50 are an error.
    """
    spark = embeddings.sparkSession
    rows = _prepared(embeddings, id_column, vector_column)
    largest = F.max(F.array_max(F.transform("cells", lambda x: F.abs(x))))
    width, most = rows.agg(F.max(F.size("cells")), largest).first()
    width, most = width or 0, most or 0
    if width * most * most >= 2**50:
        raise ValueError(f"components of 256 * x up to {most} give scores beyond 2**50")
    schema = "query_id long, rank int, vec_id long, score long"
    if not width and rows.isEmpty():
        return spark.createDataFrame([], schema)
    width = max(1, width)
    rows = rows.withColumn("cells", F.transform("cells", lambda x: x.cast("int")))
    candidates = stored(_distinct_enough(rows, k), "candidates")
    sampled = (
        candidates.orderBy(F.xxhash64("row", F.lit("sample")), "row").limit(SAMPLE).toArrow()
    )
    sample = spark.sparkContext.broadcast(
        (sampled.column("row").to_numpy(), _matrix(sampled.column("cells"), width))
    )
    queries = stored(
        rows.where(is_query)
        .select(F.col("vec_id").alias("query_id"), "row", "cells")
        .mapInArrow(
            _known(sample, width, k), "query_id long, row long, cells array<int>, known long"
        ),
        "queries",
    )
    index, blocks = build_index(candidates, width, block_cells)
    rounds = max(1, -(-queries.count() * width // round_cells))
    left = index.withColumn("round", F.explode(F.expr(f"sequence(0, {rounds - 1})")))
    right = queries.select(
        "*",
        F.pmod(F.xxhash64("row"), F.lit(rounds)).cast("int").alias("round"),
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
    )
    found = (
        left.groupBy("block", "round")
        .cogroup(right.groupBy("block", "round"))
        .applyInArrow(
            _searched(width, k), "query long, query_id long, vec_id long, row long, score long"
        )
    )
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
