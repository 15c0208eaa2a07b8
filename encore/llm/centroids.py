"""k-means over integer vectors whose nearest centroids come from a vantage-point tree.

Each round the driver builds the tree over the k centroids (k and the number of components are
parameters, so tree and centroids have a fixed size) and broadcasts it. Tasks search it for every
vector, best first: the frontier node with the smallest lower bound is opened, its vantage point
is compared exactly in integers, and its two children enter with bounds from the triangle
inequality. A vector is done when its smallest bound lies strictly above its radius: nodes on the
radius are still opened, as they may hold an equally near centroid with a smaller number. The
searches of a batch run in lockstep; each vector keeps its own frontier and radius.

A task returns per cluster and component its partial sum, so what is shuffled depends on k and
tasks alone; means are exact integer divisions. Vectors are turned into integers once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import stored

#: Vectors that search the tree in lockstep.
LOCKSTEP = 2048
#: Components stay below this, so that squared distances of 64 components fit 64 bits.
LARGEST = 1 << 27


@dataclass(frozen=True)
class VantageTree:
    """Node i stands for a centroid ``point[i]``; its children hold the nearer and farther rest.

    ``low`` and ``high`` are the least and greatest distance of a child's points to the vantage
    point of its parent; a missing child is -1.
    """

    centroids: np.ndarray
    point: np.ndarray
    children: np.ndarray
    low: np.ndarray
    high: np.ndarray


def vantage_tree(centroids: np.ndarray) -> VantageTree:
    """The vantage point of a node is the smallest number left; the median distance splits the
    rest. Distances are kept as real numbers only for bounds."""
    k = len(centroids)
    point, children = np.zeros(k, np.int64), np.full((k, 2), -1, np.int64)
    low, high = np.zeros((k, 2)), np.zeros((k, 2))
    made = 0
    todo = [(np.arange(k), -1, 0)] if k else []
    while todo:
        members, parent, side = todo.pop()
        node, made = made, made + 1
        point[node] = members[0]
        if parent >= 0:
            children[parent, side] = node
        rest = members[1:]
        if not len(rest):
            continue
        away = np.sqrt(((centroids[rest] - centroids[members[0]]) ** 2).sum(axis=1))
        near = away <= np.median(away)
        for i, part in enumerate((near, ~near)):
            if part.any():
                low[node, i], high[node, i] = away[part].min(), away[part].max()
                todo.append((rest[part], node, i))
    return VantageTree(centroids, point, children, low, high)


def nearest(tree: VantageTree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smallest) and its squared distance, per vector."""
    n, k = len(vectors), len(tree.point)
    frontier = np.full((n, k), np.inf)
    frontier[:, 0] = 0.0
    best = np.full(n, np.iinfo(np.int64).max)
    who = np.full(n, k, dtype=np.int64)
    open_ = np.arange(n)
    while len(open_):
        node = frontier[open_].argmin(axis=1)
        bound = frontier[open_, node]
        # Rounding of the square roots is far below this margin, so no tie is cut off.
        going = np.maximum(bound * (1 - 1e-9) - 1e-6, 0) ** 2 <= best[open_]
        going &= np.isfinite(bound)
        open_, node, bound = open_[going], node[going], bound[going]
        if not len(open_):
            break
        frontier[open_, node] = np.inf
        number = tree.point[node]
        away = ((vectors[open_] - tree.centroids[number]) ** 2).sum(axis=1)
        better = (away < best[open_]) | ((away == best[open_]) & (number < who[open_]))
        at = open_[better]
        best[at], who[at] = away[better], number[better]
        real = np.sqrt(away)
        for side in (0, 1):
            child = tree.children[node, side]
            there = child >= 0
            least = np.maximum(real - tree.high[node, side], tree.low[node, side] - real)
            least = np.maximum(least, bound)
            frontier[open_[there], child[there]] = least[there]
    return who, best


def floored(vector: str) -> Column:
    """floor(256 * x) of every component, as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def finite(vector: str) -> Column:
    """Neither the vector nor a component is null or not finite."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.col(vector).isNotNull() & ~bad


def checked(vectors: DataFrame, largest: int = LARGEST) -> Column:
    """``cells`` as integers; an error names the bound instead of a wrong result."""
    fits = F.forall("cells", lambda x: (x > -largest) & (x < largest))
    return F.when(fits, F.transform("cells", lambda x: x.cast("int"))).otherwise(
        F.raise_error(F.lit(f"components of 256 * x must lie below {largest}"))
    )


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimensions).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], tree, dimensions: int):
    for batch in batches:
        for a in range(0, batch.num_rows, LOCKSTEP):
            part = batch.slice(a, LOCKSTEP)
            vectors = _matrix(part.column(1), dimensions)
            yield part, vectors, *nearest(tree.value, vectors)


def _sums(tree, dimensions: int):
    """Rows (cluster, component, n, total) of what a task has assigned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.value.point)
        n, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, vectors, who, _ in _pieces(batches, tree, dimensions):
            n += np.bincount(who, minlength=k)
            np.add.at(total, who, vectors)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dimensions).astype(np.int32)),
                pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(used))),
                pa.array(np.repeat(n[used], dimensions)),
                pa.array(total[used].reshape(-1)),
            ],
            ["cluster", "component", "n", "total"],
        )

    return run


def _assigned(tree, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, who, away in _pieces(batches, tree, dimensions):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(who.astype(np.int32)), pa.array(away)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``<salt>:<vec_id>``, in ascending order.

    Vectors with one id are ordered by their components; a null id comes last.
    """
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = (
        vectors.select(order.alias("digest"), "cells")
        .orderBy(F.col("digest").asc_nulls_last(), "cells")
        .limit(k)
        .collect()
    )
    return np.array([r.cells for r in rows], dtype=np.int64)


def clustered(
    embeddings: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dimensions: int = 64,
    salt: str = "2",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids.

    Kept are vectors with exactly ``dimensions`` components, none null or not finite; components
    become floor(256 * x). Each round every centroid with vectors moves to floor(sum / count) of
    them; after the last one vectors are assigned once more. ``distance`` is squared.

    A vector with a null id is clustered and first chosen as a start when no other is left;
    repeated rows each count. With fewer than k vectors each is a start; an empty table gives no
    rows. Other columns are ignored. A component of 2**27 or more is an error.
    """
    spark = embeddings.sparkSession
    kept = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("cells")
    ).where((F.size("cells") == dimensions) & finite("cells"))
    kept = kept.withColumn("cells", floored("cells"))
    vectors = stored(kept.withColumn("cells", checked(kept)), "vectors")
    centroids = first_centroids(vectors, k, salt).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        tree = spark.sparkContext.broadcast(vantage_tree(centroids))
        sums = (
            vectors.mapInArrow(
                _sums(tree, dimensions), "cluster int, component int, n long, total long"
            )
            .groupBy("cluster", "component")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            .collect()  # k * dimensions rows
        )
        centroids = centroids.copy()
        for row in sums:
            centroids[row.cluster, row.component] = row.total // row.n
        tree.unpersist()
    tree = spark.sparkContext.broadcast(vantage_tree(centroids))
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    found = stored(vectors.mapInArrow(_assigned(tree, dimensions), schema), "assigned")
    return found, centroids


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster_report(embeddings: DataFrame, k: int = 40, rounds: int = 5) -> DataFrame:
    """``clustered`` with the sum of distances per cluster and in all, and a digest of each
    vector's final centroid. At most k rows are joined to the vectors."""
    found, centroids = clustered(embeddings, k, rounds)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(exact.alias("s")).collect()}
    rows = [
        (c, s, sum(inertia.values()), centroid_digest(centroids[c])) for c, s in inertia.items()
    ]
    table = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
