"""Frequent values, first rows, exact top shares and repeatable samples."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.order_stats import order_statistics


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value; null is not a value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    )


def value_shares(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """Value counts as fractions of the non-null rows."""
    counts = value_counts(df, column, "_n")
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select(column, (F.col("_n") / total).alias(name))


def top_values(df: DataFrame, column: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return value_counts(df, column, name).orderBy(F.desc(name), F.asc(column)).limit(k)


def in_top_values(df: DataFrame, column: str, k: int, flag: str) -> DataFrame:
    """Flag rows whose value is among the k most frequent (null: false).

    The broadcast side has at most k rows.
    """
    top = top_values(df, column, k).select(column, F.lit(True).alias(flag))
    return df.join(F.broadcast(top), column, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def first_per_key(
    df: DataFrame, key: str, order: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """One row per key: the columns ``carry`` of its first row in the given order.

    A minimum over a struct combines before the shuffle, so a key with very many rows
    arrives at its task as one row per input partition. Columns of ``carry`` that are not in
    ``order`` break remaining ties, so the result does not depend on row order.
    """
    fields = [*order, *[c for c in carry if c not in order]]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*fields)).alias("_first"))
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in carry])
    )


@dataclass(frozen=True)
class Cut:
    """Where the first ``rank`` rows of an order end: the keys of the last one, the rows before
    those with equal keys, and how many have them."""

    keys: tuple
    rank: int
    before: int
    tied: int

    @property
    def whole(self) -> bool:
        """Whether all rows with these keys are inside."""
        return self.rank == self.before + self.tied


def draw_keys(key: Column, seed: int) -> list[Column]:
    """A repeatable random order of keys: the MD5 of key and seed, in three whole numbers."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    parts = [(1, 15), (16, 15), (31, 2)]
    return [F.conv(F.substring(digest, a, n), 16, 10).cast("bigint") for a, n in parts]


def content_hash(df: DataFrame) -> Column:
    """A hash of the whole row: the last key of an order, equal only for equal rows."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def find_cuts(
    df: DataFrame,
    keys: Sequence[Column],
    ranks: Mapping[str, Callable[[int], int]],
    by: Sequence[str] = (),
) -> dict[tuple, dict[str, Cut]]:
    """The last of the first ``rank(n)`` rows in the order of the keys, per group and name.

    The keys are numbers without nulls. The first one nearly always decides; a further one is
    looked at only for names whose rank lies inside a run of equal keys.
    """
    found = {
        group: {
            name: Cut((f.value,), int(ranks[name](f.n)), f.below, f.equal)
            for name, f in names.items() if f.value is not None
        }
        for group, names in order_statistics(df, keys[0], ranks, by).items()
    }
    for group, names in found.items():
        for name, cut in names.items():
            for level in range(1, len(keys)):
                if cut.whole:
                    break
                rest = df.where(tied_with_cut(keys, cut))
                for column, value in zip(by, group):
                    rest = rest.where(F.col(column) == F.lit(value))
                wanted = cut.rank - cut.before
                inner = order_statistics(rest, keys[level], {"k": lambda n, w=wanted: w})
                f = inner[()]["k"]
                cut = Cut((*cut.keys, f.value), cut.rank, cut.before + f.below, f.equal)
            names[name] = cut
    return found


def tied_with_cut(keys: Sequence[Column], cut: Cut) -> Column:
    equal = F.lit(True)
    for key, value in zip(keys, cut.keys):
        equal &= key == F.lit(value)
    return equal


def inside_cut(keys: Sequence[Column], cut: Cut) -> Column:
    """Rows up to the cut; those equal to it only if all of them are inside."""
    inside, equal = F.lit(False), F.lit(True)
    for key, value in zip(keys, cut.keys):
        inside |= equal & (key < F.lit(value))
        equal &= key == F.lit(value)
    return inside | equal if cut.whole else inside


def first_rows(
    df: DataFrame, keys: Sequence[Column], rank: Callable[[int], int]
) -> DataFrame:
    """Exactly the first ``rank(n)`` rows in the order of the keys; n counts rows with a key.

    The last key should be ``content_hash``: what is then still tied is one row several times,
    and as many copies as fit are returned.
    """
    cut = find_cuts(df, keys, {"k": rank}).get((), {}).get("k")
    if cut is None:
        return df.limit(0)
    inside = df.where(inside_cut(keys, cut))
    if cut.whole:
        return inside
    copies = df.where(tied_with_cut(keys, cut)).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    take = F.lit(cut.rank - cut.before)
    copies = copies.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), take)))
    return inside.union(copies.select(*df.columns))


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows (or all, if fewer), the same ones for the same seed."""
    if n <= 0:
        return df.limit(0)
    keys = [*draw_keys(F.col(key), seed), content_hash(df)]
    return first_rows(df, keys, lambda rows: min(int(n), rows))


def top_share(df: DataFrame, score: str, key: str, share: float = 0.1) -> DataFrame:
    """The ``int(rows * share)`` rows with the highest score; ties go to the smaller key.

    The cut is found as an order statistic instead of sorting, because the number of rows
    kept grows with the table. ``key`` is a number and need not be unique.
    """
    ranked = df.where(F.col(score).isNotNull())
    keys = [-F.col(score), F.col(key), content_hash(df)]
    return first_rows(ranked, keys, lambda n: int(n * float(share)))
