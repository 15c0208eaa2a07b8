"""Connected components of a large graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import stored
from encore.operators.joins import splittable


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _to_minimum(edges: DataFrame) -> DataFrame:
    """(u, v, m): every neighbour v of u with the smallest of u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    return edges.join(splittable(smallest, ["u"]), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u long, v long)``; the smallest member names it.

    Each round moves larger neighbours to the smallest one and then smaller ones to theirs, so
    the edges end as stars. The minimum is combined before the shuffle, and the join that hands
    it to the neighbours lets Spark split a hot node. The rounds grow with the logarithm of the
    node count; each is written to the shared folder. Loops, repeated edges and nulls are
    allowed; a node that only has a loop is its own component.
    """
    edges = edges.select("u", "v").where("u is not null and v is not null")
    loops = edges.where("u = v").select(F.col("u").alias("node")).distinct()
    current = stored(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _checksum(current)
    while before[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _to_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        small = _to_minimum(large)
        small = (
            small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        current = stored(small, "edges")
        after = _checksum(current)
        if after == before:
            break
        before = after
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.select("node", F.col("node").alias("component"))
    return found.union(roots).union(alone).groupBy("node").agg(
        F.min("component").alias("component")
    )
