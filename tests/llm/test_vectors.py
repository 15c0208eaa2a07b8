import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm.centroids import (
    centroid_digest, cluster_report, clustered, nearest, vantage_tree,
)
from encore.llm.impact_search import possible_members, segments, top_k

CLASHING = ("cells", "row", "block", "cluster", "distance", "score", "rank", "known", "n", "part")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df


def integers(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def random_rows(n, seed, dimensions=64, spread=0.2):
    rng = random.Random(seed)
    return [
        (i, [float(np.float32(rng.gauss(0, spread))) for _ in range(dimensions)])
        for i in range(n)
    ]


# ---------------------------------------------------------------- clusters


def plain_clusters(rows, k, rounds):
    kept = [(i, integers(v)) for i, v in rows
            if v is not None and len(v) == 64
            and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (
        r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest_of(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest_of(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(col) // len(members) for col in zip(*members)]
    found = [(i, *reversed(nearest_of(v))) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(
        (str(i), c, d, inertia[c], sum(inertia.values()), centroid_digest(centroids[c]))
        for i, c, d in found
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_plain_rounds(spark, seed):
    rows = random_rows(150, seed)
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one very common vector
    rows += [(7, rows[9][1]), (7, rows[8][1]), (None, rows[5][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [None] + [0.0] * 63),
             (304, [float("nan")] * 64), (305, [float("inf")] + [0.0] * 63)]
    got = [(str(r.vec_id), *r[1:]) for r in cluster_report(frame(spark, rows), 12, 3).collect()]
    assert sorted(got) == plain_clusters(rows, 12, 3)


def test_fewer_vectors_than_centroids_and_empty(spark):
    rows = random_rows(5, 3)
    got = [(str(r.vec_id), *r[1:]) for r in cluster_report(frame(spark, rows)).collect()]
    assert sorted(got) == plain_clusters(rows, 40, 5)
    assert cluster_report(frame(spark, rows).where("vec_id < 0")).collect() == []
    with pytest.raises(Exception, match="must lie below"):
        clustered(frame(spark, [(1, [1e9] + [0.0] * 63)]))


@pytest.mark.parametrize("seed", range(6))
def test_tree_search_is_exact_with_ties(seed):
    rng = np.random.default_rng(seed)
    spread = [1, 2, 5, 1000, 10**6, 3][seed]
    dimensions = [1, 2, 3, 64, 64, 64][seed]
    centroids = rng.integers(-spread, spread + 1, (40, dimensions))
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (500, dimensions)), centroids])
    away = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    who, distance = nearest(vantage_tree(centroids), vectors)
    assert (who == away.argmin(axis=1)).all()
    assert (distance == away.min(axis=1)).all()


def test_tree_skips_far_centroids():
    """Clusters far apart: most nodes are cut off, so the bound does work."""
    rng = np.random.default_rng(0)
    centroids = np.repeat(rng.integers(-10**6, 10**6, (4, 64)), 10, axis=0)
    centroids += rng.integers(-5, 6, (40, 64))
    tree, compared = vantage_tree(centroids), []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if self.shape == (40, 64):
                compared.append(len(at))
            return super().__getitem__(at)

    counted = tree.__class__(centroids.view(Counting), tree.point, tree.children, tree.low, tree.high)
    vectors = centroids[rng.integers(0, 40, 300)] + rng.integers(-5, 6, (300, 64))
    nearest(counted, np.asarray(vectors))
    assert sum(compared) < 0.7 * 300 * 40


# ---------------------------------------------------------------- top k


def plain_top(rows, every, k):
    kept = [(n, i, integers(v)) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, v in kept:
        if q is None or q % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for m, i, w in kept if m != n
        )[:k]
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scored)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,dimensions", [(1, 64), (2, 64), (3, 7)])
def test_top_k_equals_all_products(spark, seed, dimensions):
    rows = random_rows(300, seed, dimensions)
    rows += [(400 + i, rows[3][1]) for i in range(150)]  # one very common vector, ties
    rows += [(0, rows[20][1]), (5, rows[5][1]), (None, rows[3][1]), (None, rows[0][1])]
    rows += [(500, None), (505, [None] + rows[0][1][1:]), (510, [float("nan")] * dimensions)]
    for cells in (1 << 19, 40 * dimensions):  # one block, many small ones
        got = top_k(
            frame(spark, rows), F.col("vec_id") % 5 == 0, block_cells=cells, round_cells=cells
        )
        assert found(got) == plain_top(rows, 5, 5)


def test_top_k_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, []), (1, [0.5]), (2, [-1.0, 3.0, 100.0]), (50, [0.0, 0.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert found(got) == plain_top(rows, 50, 5)
    assert top_k(frame(spark, rows).where("vec_id < 0"), F.col("vec_id") % 50 == 0).collect() == []
    assert top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    assert top_k(frame(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    assert top_k(frame(spark, [(0, []), (1, [])]), F.col("vec_id") % 50 == 0).count() == 1
    with pytest.raises(ValueError, match="scores beyond"):
        top_k(frame(spark, [(0, [1e9])]), F.col("vec_id") % 50 == 0)


@pytest.mark.parametrize("seed", range(4))
def test_proof_keeps_every_member_and_stops_early(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-80, 81, (3000, 64))
    if seed == 1:
        vectors[:1000] = vectors[0]
    if seed == 2:
        vectors[:, 5] = 7  # no impact
    if seed == 3:
        vectors = np.concatenate([vectors, 4 * vectors[:20]])
    index = segments(vectors)
    for q in vectors[::500]:
        scores = vectors @ q
        for known in (np.sort(scores)[-5], np.sort(scores)[-200], scores.min(), scores.max() + 1):
            left = possible_members(q, int(known), len(vectors), *index, few=180)
            assert set(np.flatnonzero(scores >= known)) <= set(left)
        if seed == 0:
            bar = int(np.sort(scores)[-5])
            assert len(possible_members(q, bar, len(vectors), *index, 180)) < 1000
