"""Recurring lines, found with a fixed-depth tree of line templates. DataFrame functions only.

The tree's levels are the number of tokens of a line and its leading tokens, with variable fields
(tokens that hold a digit) as <*>. A leaf's template has at every place the token that at least
``constant`` of the leaf's distinct texts share there, or <*>. A line belongs to the template if
it has the constant tokens at ``similar`` of its places. The other lines of the leaf are split by
the most frequent of their tokens that are not constant there; each part is a group with a template
of its own, and is split again until its lines are in fewer than ``least_docs`` texts. A part has
less than ``constant`` of its group's texts, so that there are few rounds. A template that recurs in
``least_docs`` different texts is dropped from all documents, and so is a masked line that does so
alone; copies of a text count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import SPACE, WORD, stored
from encore.operators.joins import splittable

DEPTH = 3
LEAST_DOCS = 10
LEAST_TOKENS = 3
CONSTANT, SIMILAR = 0.5, 0.7
#: At most so many leaves (8 bytes each) are broadcast.
BROADCAST_ROWS = 500_000

_FIELD = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"


def _lines(docs: DataFrame, depth: int, least_tokens: int) -> DataFrame:
    """(doc_id, text_key, line_no, masked, leaf, line) of all lines; leaf 0 has too few tokens.

    Only the leading tokens are cut off here. The leaf is never null, so that no filter for it
    is added below, where it would be computed a second time.
    """
    exploded = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"),
    )
    line = F.coalesce("line", F.lit(""))
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _FIELD, "<*>")).otherwise(line)
    masked = exploded.select(
        "doc_id", "text_key", "line_no", F.btrim(masked, F.lit(" \t\n\x0b\x0c\r")).alias("masked")
    )
    tokens = F.regexp_count("masked", F.lit(WORD))
    leading = F.slice(F.split("masked", SPACE, depth + 1), 1, depth)
    leaf = F.when(tokens >= least_tokens, F.xxhash64(tokens, leading))
    return masked.select(
        "doc_id", "text_key", "line_no", "masked",
        F.coalesce(leaf, F.lit(0).cast("long")).alias("leaf"),
        F.xxhash64("masked").alias("line"),
    )


def recurring_lines(
    docs: DataFrame, depth: int = DEPTH, least_docs: int = LEAST_DOCS,
    least_tokens: int = LEAST_TOKENS, constant: float = CONSTANT, similar: float = SIMILAR,
) -> tuple[DataFrame, DataFrame]:
    """The narrow table of all parsed lines, and the (leaf, line) hashes that are dropped."""
    parsed = _lines(docs, depth, least_tokens)
    narrow = stored(parsed.drop("masked"), "lines").where("leaf <> 0")
    once = narrow.select("leaf", "text_key").distinct()
    leaves = once.groupBy("leaf").agg(F.count("*").alias("texts")).where(
        F.col("texts") >= least_docs
    )
    leaves = stored(leaves, "leaves")
    few = leaves.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    chosen = F.broadcast(leaves.select("leaf")) if few else splittable(
        leaves.select("leaf"), ["leaf"]
    )
    texts = parsed.select("leaf", "line", "masked").join(chosen, "leaf", "left_semi")
    distinct = stored(_once(texts), "distinct").select(
        "leaf", "line", F.split("masked", SPACE).alias("tokens")
    )
    weights = narrow.join(splittable(leaves.select("leaf"), ["leaf"]), "leaf", "left_semi")
    weights = weights.select("leaf", "line", "text_key").distinct().groupBy("leaf", "line").agg(
        F.count("*").alias("weight")
    )
    keys = ["leaf", "line"]
    distinct = stored(
        distinct.join(splittable(weights, keys), keys).select(*keys, "weight", "tokens"), "weighted"
    )
    alone = distinct.where(F.col("weight") >= least_docs).select(*keys)
    tokens = distinct.select(
        F.col("leaf").alias("part"), *keys, "weight",
        F.posexplode_outer("tokens").alias("at", "token"),
    )
    sizes = leaves.select(F.col("leaf").alias("part"), "texts")
    fitting = None
    while True:
        placed = _placed(stored(tokens, "tokens"), sizes, constant)
        fits = F.col("same") >= F.lit(similar) * F.col("n")
        own = placed.where(fits).select("part", *keys, "weight")
        fitting = own if fitting is None else fitting.union(own)
        rest = placed.where(~fits & F.col("next").isNotNull()).select(
            F.col("next").alias("part"), *keys, "weight"
        )
        sizes = stored(
            rest.groupBy("part").agg(F.sum("weight").alias("texts"))
            .where(F.col("texts") >= least_docs),
            "parts",
        )
        if sizes.isEmpty():
            break
        rest = rest.join(splittable(sizes.select("part"), ["part"]), "part", "left_semi")
        tokens = rest.join(distinct.drop("weight"), keys).select(
            "part", *keys, "weight", F.posexplode_outer("tokens").alias("at", "token")
        )
    # A template that holds a line of enough texts recurs; texts are counted for the others.
    totals = fitting.groupBy("part").agg(
        F.sum("weight").alias("texts"), F.max("weight").alias("most")
    ).where(F.col("texts") >= least_docs)
    totals = stored(totals, "templates")
    sure = totals.where(F.col("most") >= least_docs).select("part")
    open_lines = fitting.join(
        splittable(totals.where(F.col("most") < least_docs).select("part"), ["part"]),
        "part", "left_semi",
    )
    counted = (
        narrow.join(splittable(open_lines.select("part", *keys), keys), keys)
        .select("part", "text_key").distinct().groupBy("part")
        .agg(F.count("*").alias("texts")).where(F.col("texts") >= least_docs).select("part")
    )
    often = sure.union(counted)
    recurring = fitting.join(splittable(often, ["part"]), "part", "left_semi").select(*keys)
    return narrow, recurring.union(alone).distinct()


def _once(texts: DataFrame) -> DataFrame:
    """A row per (leaf, line) with its text, the greatest one where hashes collide.

    The maximum of a text sorts its rows, so equal ones are first made one by hashing. They are
    counted, as the optimizer takes a plain ``distinct`` below a maximum away.
    """
    once = texts.groupBy("leaf", "line", "masked").agg(F.count("*").alias("_n")).where("_n > 0")
    return once.groupBy("leaf", "line").agg(F.max("masked").alias("masked"))


def _placed(tokens: DataFrame, sizes: DataFrame, constant: float) -> DataFrame:
    """(part, leaf, line, weight, n, same, next) of all lines of ``tokens``.

    ``n`` counts the line's tokens and ``same`` the constant ones; ``next`` is the part that its
    most frequent other token makes (the first of several), null if no text shares one.
    """
    keys = ["part", "at", "token"]
    have = (
        tokens.groupBy(*keys).agg(F.sum("weight").alias("have")).where("have > 1")
        .join(splittable(sizes, ["part"]), "part")
        .select(*keys, "have", (F.col("have") >= F.lit(constant) * F.col("texts")).alias("fixed"))
    )
    order = F.shiftleft("have", 20) - F.col("at")
    free = ~F.col("fixed")
    return stored(
        tokens.join(splittable(have, keys), keys, "left")
        .groupBy("part", "leaf", "line")
        .agg(
            F.max("weight").alias("weight"),
            F.count("*").alias("n"),
            F.count(F.when(F.col("fixed"), 1)).alias("same"),
            F.max_by(F.when(free, F.xxhash64(*keys)), F.when(free, order)).alias("next"),
        ),
        "placed",
    )


def dropped_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped), one row per row of ``docs``.

    ``dropped`` has the numbers of the dropped lines, from 0 and in order. Lines end at \\n; those
    with fewer than ``least_tokens`` tokens are no templates and stay. Null texts have no lines,
    an empty text one. Rows that repeat id and text get the same result. An empty table gives no
    rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    narrow, gone = recurring_lines(docs, **options)
    keys = ["leaf", "line"]
    numbers = (
        narrow.join(splittable(stored(gone, "dropped"), keys), keys, "left_semi")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))
    )
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    return (
        docs.select(
            "doc_id",
            F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"),
            F.xxhash64("text").alias("text_key"),
        )
        .join(splittable(numbers, ["text_key"]), "text_key", "left")
        .select(
            "doc_id",
            "n_lines",
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
        )
    )


def without_dropped(docs: DataFrame, **options) -> DataFrame:
    """The documents without the dropped lines; columns are those of ``docs``."""
    narrow, gone = recurring_lines(docs.select("doc_id", "text"), **options)
    keys = ["leaf", "line"]
    numbers = (
        narrow.join(splittable(stored(gone, "dropped"), keys), keys, "left_semi")
        .groupBy(F.col("text_key").alias("_key"))
        .agg(F.collect_set("line_no").alias("_dropped"))
    )
    kept = F.array_join(
        F.filter(
            F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("_dropped"), i)
        ),
        "\n",
    )
    return (
        docs.join(splittable(numbers, ["_key"]), F.xxhash64("text") == F.col("_key"), "left")
        .withColumn("text", F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(kept))
        .select(*docs.columns)
    )
