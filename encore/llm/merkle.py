"""Merkle manifest of a table: a hash tree per group of rows and one tree over the groups.

Rows get their place by one range shuffle of their hashes; texts are read once. A level is built
by a slot pivot: conditional aggregates spread the children of a parent over ``fanout`` columns.
The columns concatenated give the parent's hash; without the own slot's column they are a child's
siblings, so proofs need no search. Levels shrink by the fanout, so all of them together cost
half as much as the first. Proofs are handed down from the root, level by level, and reach the
rows with the pivot row of their parent: no row is joined with more than one other.

Groups may hold any share of the rows: places, parents and proofs are keyed by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from encore.llm.shared import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_BYTES = "X''"
_NO_STEPS = "cast(array() as array<struct<l: binary, r: binary>>)"


def _digest(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def _of_digests(data: Column) -> Column:
    """The hash of digests that are joined as hex text."""
    return _digest(F.lower(F.hex(data)))


def row_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its length in UTF-8 bytes, ``:``, itself."""
    parts = []
    for field in fields:
        text = field.cast("string")
        length = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return _digest(F.concat(*parts))


@dataclass(frozen=True)
class Manifest:
    """rows(doc_id, leaf, altered, tree, pos, n); levels[k](tree, pos, n, c0.., hash): parents of
    the nodes at level k; groups(tree, grp, n, depth, subroot); the levels over them; the root."""

    rows: DataFrame
    levels: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]
    root: str | None
    fanout: int


def _placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with ``pos`` in their group (from 0, in the order given) and the group's size ``n``.

    One range shuffle sorts all rows; only counts per group and range are summed after that.
    """
    keys = [*group, *order]
    placed = stored(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy(*group, "part").agg(
        F.count("*").alias("rows"), F.min("at").alias("first")
    )
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(g).alias(f"{g}_") for g in group],
        F.col("part").alias("part_"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    same = F.col("part") == F.col("part_")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    return placed.join(runs, same).select(
        *df.columns, (F.col("at") + F.col("shift")).alias("pos"), "n"
    )


def _slots(fanout: int) -> list[Column]:
    return [F.coalesce(F.col(f"c{i}"), F.expr(_NO_BYTES)) for i in range(fanout)]


def _levels(nodes: DataFrame, largest: int, fanout: int) -> list[DataFrame]:
    """Parents level by level, over nodes(tree, pos, n, hash); trees with one node are done."""
    found = []
    while largest > 1:
        slot = F.col("pos") % fanout
        parents = (
            nodes.where("n > 1")
            .groupBy("tree", F.expr(f"pos div {fanout}").alias("parent"))
            .agg(
                F.max(F.expr(f"(n + {fanout - 1}) div {fanout}")).alias("n"),
                *[F.max(F.when(slot == i, F.col("hash"))).alias(f"c{i}") for i in range(fanout)],
            )
            .withColumnRenamed("parent", "pos")
            .withColumn("hash", _of_digests(F.concat(*_slots(fanout))))
        )
        found.append(stored(parents, "level"))
        nodes = found[-1].select("tree", "pos", "n", "hash")
        largest = -(-largest // fanout)
    return found


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, depth, subroot) of every tree."""
    out = leaves.where("n = 1").select("tree", F.lit(0).alias("depth"), "hash")
    for k, level in enumerate(levels, 1):
        out = out.union(level.where("n = 1").select("tree", F.lit(k).alias("depth"), "hash"))
    return out.withColumnRenamed("hash", "subroot")


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    key: str = "doc_id",
    altered: Mapping[str, Column] | None = None,
    fanout: int = 3,
) -> Manifest:
    """The manifest of a table.

    A leaf is the hash of a row's ``fields``. In each group leaves ascend by ``key``; while a
    tree has several nodes, every ``fanout`` consecutive ones become their hash. The subroots,
    ordered by group, give the root in the same way. ``altered`` replaces fields by expressions:
    the second hash of a row, of a copy whose integrity is to be checked.

    Null groups are a group and come first, null keys too; rows with one key are ordered by
    their hash, and equal rows are interchangeable. An empty table has no nodes and no root.
    Other columns are ignored.
    """
    altered = altered or {}
    given = {f: F.col(f) for f in fields}
    leaves = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(group).alias("grp"),
            row_hash(list(given.values())).alias("leaf"),
            row_hash([altered.get(f, c) for f, c in given.items()]).alias("altered"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    sizes = leaves.groupBy("grp").agg(F.count("*").alias("size"))
    trees = stored(
        _placed(sizes, [], ["grp"]).select("grp", "size", F.col("pos").alias("tree")), "trees"
    )
    largest, n_trees = trees.agg(F.max("size"), F.count("*")).first()
    named = trees.select(F.col("grp").alias("grp_"), "tree")
    rows = stored(
        _placed(leaves, ["grp"], ["doc_id", "leaf", "row"])
        .join(named, F.col("grp").eqNullSafe(F.col("grp_")))
        .select("doc_id", "leaf", "altered", "tree", "pos", "n"),
        "placed",
    )
    nodes = rows.select("tree", "pos", "n", F.col("leaf").alias("hash"))
    levels = _levels(nodes, largest or 0, fanout)
    groups = stored(
        _roots(nodes, levels).join(trees, "tree").select("tree", "grp", "size", "depth", "subroot"),
        "groups",
    )
    tops = groups.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.lit(n_trees).cast("long").alias("n"),
        F.col("subroot").alias("hash"),
    )
    top = _levels(tops, n_trees, fanout)
    last = _roots(tops, top).select(F.lower(F.hex("subroot")).alias("root")).first()
    return Manifest(rows, levels, groups, top, last.root if last else None, fanout)


def _step(fanout: int, slot: Column | int) -> Column:
    """The siblings left and right of a slot."""
    slot = F.lit(slot) if isinstance(slot, int) else slot
    parts = _slots(fanout)
    none = F.expr(_NO_BYTES)
    left = [F.when(F.lit(i) < slot, p).otherwise(none) for i, p in enumerate(parts)]
    right = [F.when(F.lit(i) > slot, p).otherwise(none) for i, p in enumerate(parts)]
    return F.struct(F.concat(*left).alias("l"), F.concat(*right).alias("r"))


def _pivots_with_steps(levels: list[DataFrame], roots: DataFrame, fanout: int) -> DataFrame | None:
    """The lowest parents, with the subroot and the steps from them to the root.

    ``roots(tree, depth, subroot, steps)`` has what stands above each tree.
    """
    above = None
    for k in range(len(levels), 0, -1):
        known = roots.where(F.col("depth") == k).select(
            "tree", F.lit(0).cast("long").alias("pos"), "subroot", "steps"
        )
        if above is not None:
            children = [
                F.when(
                    F.col(f"c{i}").isNotNull(),
                    F.struct(F.lit(i).alias("i"), _step(fanout, i).alias("own")),
                )
                for i in range(fanout)
            ]
            known = known.union(
                above.select("*", F.explode(F.filter(F.array(*children), F.isnotnull)).alias("x"))
                .select(
                    "tree",
                    F.col("pos") * fanout + F.col("x.i"),
                    "subroot",
                    F.concat(F.array("x.own"), "steps"),
                )
            )
        slots = [f"c{i}" for i in range(fanout)]
        above = stored(
            levels[k - 1]
            .select("tree", "pos", *slots)
            .join(known, ["tree", "pos"])
            .select("tree", "pos", *slots, "subroot", "steps"),
            "steps",
        )
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, altered, subroot, steps): per row the siblings left (l) and right (r) of its
    path, level by level from the leaf to the root."""
    fanout = manifest.fanout
    slots = [f"c{i}" for i in range(fanout)]
    whole = manifest.groups.agg(F.count("*").alias("n")).first().n
    depth, size = 0, whole
    while size > 1:
        depth, size = depth + 1, -(-size // fanout)
    only = manifest.groups.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(depth).alias("depth"),
        F.lit(None).cast("binary").alias("subroot"),
        F.expr(_NO_STEPS).alias("steps"),
    )
    top = _pivots_with_steps(manifest.top, only, fanout)
    groups = manifest.groups.select("tree", "depth", "subroot")
    if top is None:
        groups = groups.withColumn("steps", F.expr(_NO_STEPS))
    else:
        groups = (
            groups.withColumn("parent", F.expr(f"tree div {fanout}"))
            .join(top.select(F.col("pos").alias("parent"), *slots, "steps"), "parent")
            .select(
                "tree",
                "depth",
                "subroot",
                F.concat(F.array(_step(fanout, F.col("tree") % fanout)), "steps").alias("steps"),
            )
        )
    groups = stored(groups, "tops")
    alone = groups.where("depth = 0").select(
        "tree",
        F.lit(0).cast("long").alias("parent"),
        *[F.lit(None).cast("binary").alias(c) for c in slots],
        "subroot",
        "steps",
    )
    pivots = _pivots_with_steps(manifest.levels, groups, fanout)
    parents = alone
    if pivots is not None:
        parents = alone.unionByName(pivots.withColumnRenamed("pos", "parent"))
    own = F.concat(F.array(_step(fanout, F.col("pos") % fanout)), F.col("steps"))
    return (
        manifest.rows.withColumn("parent", F.expr(f"pos div {fanout}"))
        .join(parents, ["tree", "parent"])
        .select(
            "doc_id",
            "leaf",
            "altered",
            "subroot",
            F.when(F.col("n") > 1, own).otherwise(F.col("steps")).alias("steps"),
        )
    )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(steps, leaf, lambda now, s: _of_digests(F.concat(s["l"], now, s["r"])))


def audit(
    docs: DataFrame, altered: Mapping[str, Column] | None = None, fanout: int = 3
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): a row per document.

    Every row is proven against the root with the siblings of the untouched table; a row whose
    fields are ``altered`` gives another root and is not verified. proof_sha256 is the hash of
    the siblings from leaf to root, left to right. Edge cases are those of ``build``.
    """
    manifest = build(docs, altered=altered, fanout=fanout)
    siblings = F.transform("steps", lambda s: F.lower(F.hex(F.concat(s["l"], s["r"]))))
    root = F.lit(manifest.root).cast("string")
    return (
        proofs(manifest)
        .select(
            "doc_id",
            F.lower(F.hex("leaf")).alias("leaf"),
            F.lower(F.hex("subroot")).alias("subroot"),
            root.alias("root"),
            F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
            F.lower(F.hex(folded(F.col("altered"), F.col("steps")))).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def without_line_breaks(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The alteration of the audit query: where 2 divides the CRC-32 of the decimal id, the text
    loses its line feeds. Rows with a null id or text stay."""
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return {text: F.when(hit, F.translate(F.col(text), "\n", "")).otherwise(F.col(text))}
