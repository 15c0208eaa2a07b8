"""Mixing sources to target weights with fixed-length token blocks and keyed permutations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from encore.llm.shared import U, mix, n_words, stored, words
from encore.operators.joins import splittable

BLOCK_WORDS = 1024
SHARD_SLOTS = 1024
MAX_REPEATS = 3
#: Sources are planned on the driver; more than this many raise an error.
MAX_SOURCES = 100_000
BUCKET_ROWS = 20_000
_ROUNDS = 4


def targets(sizes: list[int], repeats: int = MAX_REPEATS) -> list[Fraction]:
    """Words per source: weights 1, 2, 3, 1, ... share the total; none above repeats * size."""
    found = [Fraction(0)] * len(sizes)
    free = set(range(len(sizes)))
    left = Fraction(sum(sizes))
    while free:
        weight = sum(i % 3 + 1 for i in free)
        share = {i: left * (i % 3 + 1) / weight for i in free}
        full = {i for i in free if share[i] > repeats * sizes[i]}
        if not full:
            for i in free:
                found[i] = share[i]
            break
        for i in full:
            found[i] = Fraction(repeats * sizes[i])
            left -= found[i]
        free -= full
    return found


def _round(half: np.ndarray, key: np.ndarray, i: int, mask: np.ndarray) -> np.ndarray:
    return mix(half ^ mix(key, i + 1)) & mask


def permute(at: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 to n - 1 for every element: Feistel rounds with cycle walking."""
    n = n.astype(U)
    bits = np.array([max(1, (int(x) - 1).bit_length() + 1) // 2 for x in n], dtype=U)
    mask = (U(1) << bits) - U(1)
    out = at.astype(U).copy()
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        x, b, m, k = out[todo], bits[todo], mask[todo], key[todo]
        left, right = x >> b, x & m
        for i in reversed(range(_ROUNDS)) if inverse else range(_ROUNDS):
            if inverse:
                left, right = right ^ _round(left, k, i, m), left
            else:
                left, right = right, left ^ _round(right, k, i, m)
        out[todo] = (left << b) | right
        todo = out >= n
    return out.astype(np.int64)


def _keys(source: np.ndarray, epoch: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(source.astype(U), seed) + epoch.astype(U), seed + 1)


class Plan:
    """What the driver knows: one entry per source."""

    def __init__(self, names, sizes, block, repeats, seed):
        self.names, self.sizes, self.block, self.seed = names, sizes, block, seed
        self.targets = targets(sizes, repeats)
        self.blocks = [max(1, math.ceil(s / block)) for s in sizes]
        self.slots, self.cut = [], []  # slots per source; words of the last one, 0: all
        for i, (size, target) in enumerate(zip(sizes, self.targets)):
            whole, rest = divmod(math.floor(target), size) if size else (0, 0)
            n, tail = self.blocks[i], size - (self.blocks[i] - 1) * block
            one = np.array([n - 1]), np.array([n]), _keys(np.array([i]), np.array([whole]), seed)
            short = int(permute(*one, inverse=True)[0])  # where the short block is in that epoch
            if rest <= short * block:
                used, cut = divmod(rest, block)
                used += cut > 0
            elif rest <= short * block + tail:
                used, cut = short + 1, (rest - short * block) % tail
            else:
                used, cut = divmod(rest - tail, block)
                used += 1 + (cut > 0)
            self.slots.append(whole * n + used)
            self.cut.append(cut)


def _drawn(plan_slots: list[int], per_shard: int, seed: int):
    """Multinomial counts of the sources for every output shard."""
    total = sum(plan_slots)
    share = np.array(plan_slots, dtype=float) / total

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                n = min(per_shard, total - int(shard) * per_shard)
                counts = np.random.default_rng([seed, int(shard)]).multinomial(n, share)
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"shard": shard, "src": used, "n": counts[used]})

    return run


def _mapped(plan: Plan, drawn: list[int]):
    """Slots (src, index, shard) to blocks (src, block, epoch, words; 0: all of it).

    Multinomial counts differ from the plan by chance. Slots that a source has too many go, in
    order, to sources that have too few.
    """
    slots, blocks = np.array(plan.slots), np.array(plan.blocks)
    cut, drawn = np.array(plan.cut), np.array(drawn)
    over, under = np.maximum(0, drawn - slots), np.maximum(0, slots - drawn)
    over_from = np.cumsum(over) - over
    under_to = np.cumsum(under)
    seed = plan.seed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            src, index = batch["src"].to_numpy().copy(), batch["index"].to_numpy().copy()
            extra = index >= slots[src]
            rank = over_from[src[extra]] + index[extra] - slots[src[extra]]
            to = np.searchsorted(under_to, rank, side="right")
            src[extra] = to
            index[extra] = drawn[to] + rank - (under_to[to] - under[to])
            epoch, at = np.divmod(index, blocks[src])
            block = permute(at, blocks[src], _keys(src, epoch, seed))
            part = np.where(index == slots[src] - 1, cut[src], 0)
            yield pd.DataFrame(
                {"src": src, "block": block, "epoch": epoch, "part": part,
                 "shard": batch["shard"].to_numpy(), "index": index}
            )

    return run


class Mix:
    """The mix of a table of documents. ``docs`` needs a column that numbers its rows (``_row``).

    sized: (_row, doc_id, src, size, start): where each document lies in its source's stream.
    slots: (shard, src, index, block, epoch, part): which block fills each slot of the output.
    pieces: (_row, epoch, from, to): the words of each document that the slots take.
    """

    def __init__(
        self, docs: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
        repeats: int = MAX_REPEATS, seed: int = 20_11, bucket_rows: int = BUCKET_ROWS,
    ):
        spark = docs.sparkSession
        rows = docs.select("_row", "doc_id", "source", n_words("text").alias("size"),
                           F.xxhash64("doc_id", "text").alias("tie"))
        rows = stored(rows, "sizes")
        found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        found = found.limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        self.plan = plan = Plan(
            [r.source for r in found], [r["size"] for r in found], block, repeats, seed
        )
        self.sources = spark.createDataFrame(
            [
                (i, name, size, float(target))
                for i, (name, size, target) in enumerate(zip(plan.names, plan.sizes, plan.targets))
            ],
            "src int, source string, source_size long, target double",
        )
        numbered = rows.join(
            F.broadcast(self.sources.select("src", F.col("source").alias("name"))),
            F.col("source").eqNullSafe(F.col("name")),
        )
        buckets = 1 + sum(r.n for r in found) // bucket_rows
        numbered = numbered.withColumn("bucket", F.pmod("tie", F.lit(buckets)))
        totals = numbered.groupBy("src", "bucket").agg(F.sum("size").alias("total"))
        ahead = (
            Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = totals.select(
            "src", "bucket", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base")
        )
        inside = (
            Window.partitionBy("src", "bucket").orderBy("tie", "doc_id", "size", "_row")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        self.sized = stored(
            numbered.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(totals, ["src", "bucket"])
            .select("_row", "doc_id", "src", "size", (F.col("base") + F.col("own")).alias("start")),
            "sized",
        )
        if not sum(plan.slots):
            self.slots = spark.createDataFrame(
                [], "src int, block long, epoch long, part long, shard long, index long"
            )
        else:
            shards = math.ceil(sum(plan.slots) / shard_slots)
            counts = stored(
                spark.range(shards).mapInPandas(
                    _drawn(plan.slots, shard_slots, seed), "shard long, src int, n long"
                ),
                "counts",
            )
            drawn = dict(counts.groupBy("src").agg(F.sum("n")).collect())
            drawn = [drawn.get(i, 0) for i in range(len(found))]
            ahead = (
                Window.partitionBy("src").orderBy("shard")
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            index = (
                counts.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
                .select(
                    "src", "shard",
                    F.explode(
                        F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)
                    ).alias("index"),
                )
            )
            self.slots = stored(
                index.mapInPandas(
                    _mapped(plan, drawn),
                    "src int, block long, epoch long, part long, shard long, index long",
                ),
                "slots",
            )
        self.block = block

    def overlaps(self) -> DataFrame:
        """(_row, src, block, head, from, to): the words from to to of a document lie in a block,
        after ``head`` words of the block."""
        b = F.lit(self.block)
        start, end = F.col("start"), F.col("start") + F.col("size")
        first = F.col("block") * b
        return (
            self.sized.where("size > 0")
            .withColumn(
                "block", F.explode(F.sequence(F.floor(start / b), F.floor((end - 1) / b)))
            )
            .select(
                "_row", "src", "block",
                F.greatest(F.lit(0), start - first).alias("head"),
                F.greatest(F.lit(0), first - start).alias("from"),
                F.least(F.col("size"), first + b - start).alias("to"),
            )
        )

    def pieces(self) -> DataFrame:
        taken = self.overlaps().join(self.slots.select("src", "block", "epoch", "part"),
                                     ["src", "block"])
        to = F.when(
            F.col("part") > 0,
            F.least(F.col("to"), F.col("from") + F.col("part") - F.col("head")),
        ).otherwise(F.col("to"))
        return taken.withColumn("to", to).where("`to` > `from`").select(
            "_row", "epoch", "from", "to"
        )


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a row number, written once so that it stays."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``.

    Tokens of a source are packed into blocks of 1024 words in hash order. Output shards draw
    multinomial counts of their slots' sources; the slots of a source run through keyed
    permutations of its blocks, one per epoch, so a block comes at most once per epoch. The last
    slot of a source is cut, so that the words taken are the target rounded down.

    Sources are in code point order, null last, and weigh 1, 2, 3 in turn; targets above three
    times the source's size are cut to it and the excess is shared again. Null and empty texts
    have size 0 and take nothing, as do sources without words. Repeated rows are documents of
    their own. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", "source", "text").withColumn(
        "_row", F.monotonically_increasing_id()
    )
    made = Mix(rows, **options)
    taken = made.pieces().groupBy("_row").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    return (
        made.sized.join(splittable(taken, ["_row"]), "_row", "left")
        .join(F.broadcast(made.sources), "src")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per document and epoch with the words taken, columns as ``docs``.

    A document that is taken whole keeps its text; of others the taken words are joined by
    single spaces. n_chars, if there is such a column, is the length of the new text.
    """
    base = numbered(docs)
    made = Mix(base, **options)
    pieces = made.pieces().groupBy("_row", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("from", "to"))).alias("pieces"),
        F.sum(F.col("to") - F.col("from")).alias("taken"),
    )
    pieces = pieces.join(made.sized.select("_row", "size"), "_row")
    pieces = pieces.select(
        F.col("_row").alias("_of"), F.struct("pieces", "taken", "size").alias("_mix")
    )
    out = base.join(pieces, F.col("_row") == F.col("_of")).withColumn("_words", words("text"))
    own, taken = F.col("_words"), F.col("_mix.taken")
    text = F.when(taken == F.col("_mix.size"), F.col("text")).otherwise(
        F.array_join(
            F.flatten(
                F.transform(
                    "_mix.pieces",
                    lambda p: F.slice(
                        own,
                        p["from"].cast("int") + 1,
                        F.least(F.size(own), (p["to"] - p["from"]).cast("int")),
                    ),
                )
            ),
            " ",
        )
    )
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
