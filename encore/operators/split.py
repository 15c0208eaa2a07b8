"""Exact, repeatable train/test and fold assignment."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators.ranking import (
    Cut,
    content_hash,
    draw_keys,
    find_cuts,
    inside_cut,
    tied_with_cut,
)
from encore.session import stored

#: Labels are classes: a column with more values than this is not one.
MAX_LABELS = 100


def content_key(df: DataFrame) -> Column:
    """Text of a whole row, as key for tables without an id.

    Fractions count in millionths, so that the key does not depend on how an engine prints or
    sums them in the last digits. Null, NaN and infinite values have texts of their own.
    """
    parts = []
    for field in df.schema.fields:
        c = F.col(field.name)
        text = c.cast("string")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            whole = F.round(c.cast("double") * 1_000_000).cast("decimal(38,0)").cast("string")
            text = F.when(F.abs(c) < 1e30, whole).otherwise(text)
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.concat_ws("\x1f", *parts)


def _placed(
    df: DataFrame, label: str | None, key: Column | str, seed: int,
    ranks: Mapping[str, Callable[[int], int]], name: str,
    number: Callable[[dict[str, Column]], Column], draw: str | None = None,
) -> DataFrame:
    """Add ``name``, made of flags that tell whether a row in hash order is beyond each cut.

    Rows equal in every column that a cut falls between are counted and dealt out by number.
    ``draw``: a column that holds the first of the ``draw_keys`` already; it is not kept. It
    nearly always decides alone, so that scans of the result only compare it with numbers; where
    further keys are needed, the result is written, so that they are made once.
    """
    kept = [c for c in df.columns if c != draw]
    keys = [
        *draw_keys(F.col(key) if isinstance(key, str) else key, seed),
        content_hash(df.select(*kept)),
    ]
    if draw:
        keys[0] = F.col(draw)
    columns = [f"_key_{i}" for i in range(len(keys))]
    groups = find_cuts(df, keys, ranks, [label] if label else [])
    if len(groups) > MAX_LABELS:
        raise ValueError(f"{label!r} has more than {MAX_LABELS} values")

    def of_group(group) -> Column:
        return F.col(label) == F.lit(group[0]) if label else F.lit(True)

    def beyond(x: str) -> Column:
        flag = F.lit(None).cast("boolean")
        for group, cuts in groups.items():
            outside = ~inside_cut([F.col(c) for c in columns], cuts[x]) if x in cuts else F.lit(True)
            flag = F.when(of_group(group), outside).otherwise(flag)
        return F.coalesce(flag, F.lit(True))

    split_ties: list[tuple[Column, tuple, Cut]] = []
    for group, cuts in groups.items():
        seen = set()
        for cut in cuts.values():
            if not cut.whole and cut.keys not in seen:
                seen.add(cut.keys)
                split_ties.append((of_group(group) & tied_with_cut(keys, cut), group, cut))
    out = df
    for tied, _, _ in split_ties:
        out = out.where(~F.coalesce(tied, F.lit(False)))
    # Columns of their own: a row's keys are made once, however many cuts look at them.
    flags = {x: beyond(x) for x in ranks}
    out = out.withColumns({c: key for c, key in zip(columns, keys)}).select(
        *kept, number(flags).alias(name)
    )
    for tied, group, cut in split_ties:
        one = df.where(tied).groupBy(*kept).agg(F.count("*").alias("_copies"))
        first = F.lit(cut.before + 1).cast("long")
        one = one.withColumn(
            "_place", F.explode(F.sequence(first, first + F.col("_copies") - 1))
        )
        flags = {
            x: F.col("_place") > F.lit(groups[group][x].rank if x in groups[group] else 0)
            for x in ranks
        }
        out = out.union(one.withColumn(name, number(flags)).select(*kept, name))
    further = [c for cuts in groups.values() for c in cuts.values() if len(c.keys) > 1 or not c.whole]
    return stored(out, "placed") if draw and further else out


def stratified_split(
    df: DataFrame,
    label: str,
    key: Column | str,
    test_share: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
    draw: str | None = None,
) -> DataFrame:
    """Add ``split`` ('train' or 'test'): per label, the ``round(n * share)`` rows with the
    lowest hash of their key go to test.

    Jobs find one hash value per label to cut at; rows are then placed by comparing with
    it, so no label group is sorted in one task and the wide rows are never shuffled. Equal
    keys are told apart by the whole row, and equal rows are dealt out by number. ``draw`` names
    a column with the first of the ``draw_keys`` of key and seed, if the table has it already.
    """
    if label not in df.columns:
        raise ValueError(f"the table has no target column {label!r}")
    if df.isEmpty():
        raise ValueError("cannot split an empty table")
    ranks = {"test": lambda n: int(n * float(test_share) + 0.5)}
    return _placed(
        df, label if stratify else None, key, seed, ranks, "split",
        lambda beyond: F.when(beyond["test"], F.lit("train")).otherwise(F.lit("test")), draw,
    )


def assign_folds(
    df: DataFrame, label: str, key: Column | str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` (0..folds-1): per label, equal slices of the rows in hash order."""
    ranks = {str(i): lambda n, i=i: n * i // folds for i in range(1, folds)}
    return _placed(
        df, label, key, seed, ranks, "fold",
        lambda beyond: sum((f.cast("int") for f in beyond.values()), F.lit(0)).cast("int"),
    )
