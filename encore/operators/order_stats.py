"""Exact order statistics and running totals that never sort a whole column in one task.

A rank is bracketed, then counted. The first scan takes the number of rows, both ends and a grid
of approximate quantiles, which gives a bracket of a few thousandths of the rows around every
wanted rank. The second scan counts the rows below each bracket and those inside by value; both
are combined before the shuffle. What is inside is ordered: on the driver while it is small, else
by cutting stored counts into bins, level by level, between the smallest and largest value left.
The counts prove which bracket holds a rank; one that misses its rank (approximations may) is
replaced by the gap that holds it. So results are exact, and no value is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from encore.session import stored

BINS = 1024
#: Brackets, over all groups, up to which a row's zone is an expression of literals.
MAX_LITERALS = 64
#: Approximate quantiles that the first scan takes, at even steps; rows counted per value that
#: the driver orders itself.
GRID, SMALL = 1000, 50_000
#: Groups (labels, column names) whose statistics are found together.
MAX_GROUPS = 10_000


@dataclass(frozen=True)
class Found:
    """A value at a rank: rows below it, rows equal to it, rows in all."""

    value: float | int | Decimal | None
    below: int
    equal: int
    n: int


def _typed(df: DataFrame, value: str | Column, by: Sequence[str]) -> tuple[DataFrame, T.DataType]:
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, v.alias("_v"))
    kind = rows.schema["_v"].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        rows = rows.withColumn("_v", F.col("_v").cast("double"))
        return rows.where("_v is not null and not isnan(_v)"), T.DoubleType()
    # No filter on nulls: the optimizer would evaluate ``value`` once more for it. Counts skip them.
    if isinstance(kind, T.IntegralType):
        return rows.withColumn("_v", F.col("_v").cast("long")), T.LongType()
    if isinstance(kind, T.DecimalType):
        return rows, kind
    raise TypeError(f"order statistics need numbers, not {kind.simpleString()}")


def _bin(kind: T.DataType) -> Column:
    """A bin between 0 and BINS - 1 that never decreases as the value grows."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    if isinstance(kind, T.DoubleType):  # halves, so that the width is finite
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    else:  # exact differences; bigints may be further apart than a bigint
        wide = "decimal(38,0)" if isinstance(kind, T.LongType) else kind
        lo, hi, v = lo.cast(wide), hi.cast(wide), v.cast(wide)
        share = (v - lo).cast("double") / (hi - lo).cast("double")
    inside = F.least(F.lit(BINS - 2), F.greatest(F.lit(1), F.floor(share * BINS))).cast("int")
    infinite = F.lit(False)
    if isinstance(kind, T.DoubleType):
        infinite = (F.abs("_lo") == float("inf")) | (F.abs("_hi") == float("inf"))
    return (
        F.when(F.col("_v") == F.col("_lo"), 0)
        .when(F.col("_v") == F.col("_hi"), BINS - 1)
        .when(infinite, 1)
        .otherwise(inside)
    )


@dataclass(frozen=True)
class _Open:
    """Ranks {rank: names} of a group whose values lie between lo and hi, after ``before`` rows."""

    group: tuple
    lo: float | int | Decimal
    hi: float | int | Decimal
    before: int
    wanted: dict[int, list[str]]


def _widened(lo, hi, kind: T.DataType):
    """A bracket whose ends went through doubles, with room for their rounding."""
    if isinstance(kind, T.DoubleType):
        return lo, hi
    if isinstance(kind, T.LongType):
        return lo - abs(lo) // 2**50 - 1, hi + abs(hi) // 2**50 + 1
    with localcontext() as context:
        context.prec = 60
        unit = Decimal(1).scaleb(-kind.scale)
        return (
            (lo - abs(lo) / 2**50 - unit).quantize(unit),
            (hi + abs(hi) / 2**50 + unit).quantize(unit),
        )


def _brackets(row, wanted: dict[int, list[str]], kind: T.DataType) -> list[tuple]:
    """Disjoint intervals, in order, that should hold the wanted ranks of a group."""
    found: list[tuple] = []
    for k in sorted(wanted):
        step = (k - 1) / max(1, row.n - 1) * GRID
        lo, hi = row.grid[max(0, int(step) - 1)], row.grid[min(GRID, -int(-step // 1) + 1)]
        if lo is None or hi is None:
            lo, hi = row.lo, row.hi
        lo, hi = _widened(lo, hi, kind)
        lo = row.lo if step <= 1 else max(lo, row.lo)
        hi = row.hi if step >= GRID - 1 else min(hi, row.hi)
        if found and lo <= found[-1][1]:
            lo, hi = found[-1][0], max(hi, found.pop()[1])
        found.append((lo, hi))
    return found


def _zoned(
    rows: DataFrame, brackets: Mapping[tuple, list[tuple]], by: Sequence[str], kind: T.DataType
) -> DataFrame:
    """Rows (by, _zone, _v, _n): zone 2 i + 1 is the i-th bracket of a group, with a row per
    value; zone 2 i is the gap before it, one row without value."""
    v = F.col("_v")

    def passed(ends: list[tuple]) -> Column:
        zone = F.lit(0)
        for lo, hi in ends:
            zone = zone + (v >= F.lit(lo).cast(kind)).cast("int")
            zone = zone + (v > F.lit(hi).cast(kind)).cast("int")
        return zone

    if by and sum(map(len, brackets.values())) > MAX_LITERALS:
        arrays = T.ArrayType(kind)
        fields = [T.StructField(c, rows.schema[c].dataType) for c in by]
        fields += [T.StructField("_lows", arrays), T.StructField("_highs", arrays)]
        ends = [
            (*group, [lo for lo, _ in found], [hi for _, hi in found])
            for group, found in brackets.items()
        ]
        bounds = rows.sparkSession.createDataFrame(ends, T.StructType(fields))
        rows = rows.join(F.broadcast(bounds), list(by))  # a row per group
        zone = F.size(F.filter("_lows", lambda x: x <= v))
        zone = F.when(v.isNotNull(), zone + F.size(F.filter("_highs", lambda x: x < v)))
    elif by:
        zone = F.lit(None).cast("int")
        for group, found in brackets.items():
            here = F.lit(True)
            for c, own in zip(by, group):
                here = here & (F.col(c) == F.lit(own).cast(rows.schema[c].dataType))
            zone = F.when(here, passed(found)).otherwise(zone)
    else:
        zone = passed(brackets[()])
    placed = rows.withColumn("_zone", zone)
    inside = F.when(F.col("_zone") % 2 == 1, v).cast(kind)
    counted = placed.groupBy(*by, "_zone", inside.alias("_inside")).agg(F.count("*").alias("_n"))
    # Rows without value or bracket have no zone; a condition on the count stays behind it.
    return counted.where("case when _zone is null then 0 else _n end > 0").select(
        *by, "_zone", F.col("_inside").alias("_v"), "_n"
    )


def order_statistics(
    df: DataFrame,
    value: str | Column,
    ranks: Mapping[str, Callable[[int], int]],
    by: Sequence[str] = (),
) -> dict[tuple, dict[str, Found]]:
    """Values at given ranks (1 = smallest), exactly: {group: {name: Found}}.

    ``ranks`` maps a name to a function of the group's row count; a rank outside 1 to n has
    value None. Null and NaN are left out; a group without values has no entry. Values keep
    their type: bigint and decimal are compared exactly, other numbers as doubles. ``by`` must be
    non-null columns with few distinct values (a label, a column name); more than MAX_GROUPS
    raise. Two scans of the columns used, whatever the distribution.
    """
    rows, kind = _typed(df, value, by)
    grid = F.percentile_approx("_v", [i / GRID for i in range(GRID + 1)], 10 * GRID)
    whole = (
        rows.groupBy(*by)
        .agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
             grid.alias("grid"))
        .where("n > 0").limit(MAX_GROUPS + 1).collect()
    )
    if len(whole) > MAX_GROUPS:
        raise ValueError(f"order statistics in more than {MAX_GROUPS} groups")
    result: dict[tuple, dict[str, Found]] = {}
    sizes: dict[tuple, int] = {}
    wanted_of: dict[tuple, dict[int, list[str]]] = {}
    brackets: dict[tuple, list[tuple]] = {}
    for row in whole:
        group = tuple(row[c] for c in by)
        sizes[group] = row.n
        wanted: dict[int, list[str]] = {}
        result[group] = {}
        for name, rank in ranks.items():
            k = int(rank(row.n))
            if not 1 <= k <= row.n:
                result[group][name] = Found(None, 0, 0, row.n)
            elif row.lo == row.hi:
                result[group][name] = Found(row.lo, 0, row.n, row.n)
            else:
                wanted.setdefault(k, []).append(name)
        if wanted:
            wanted_of[group] = wanted
            brackets[group] = _brackets(row, wanted, kind)
    if not brackets:
        return result

    def settle(group, names, found) -> None:
        for name in names:
            result[group][name] = found

    few = sum(sizes[g] * 3 * len(b) // GRID for g, b in brackets.items()) <= SMALL
    zoned = _zoned(rows, brackets, by, kind)
    counted = zoned.limit(2 * SMALL + 1).collect() if few else []
    if few and len(counted) <= 2 * SMALL:
        totals: dict[tuple, dict[int, int]] = {}
        values: dict[tuple, list[tuple]] = {}
        for r in counted:
            key = tuple(r[c] for c in by)
            totals.setdefault(key, {}).setdefault(r["_zone"], 0)
            totals[key][r["_zone"]] += r["_n"]
            if r["_zone"] % 2:
                values.setdefault((*key, r["_zone"]), []).append((r["_v"], r["_n"]))
        inside = None
    else:
        inside = stored(zoned, "inside")
        values, totals = {}, {}
        for r in inside.groupBy(*by, "_zone").agg(F.sum("_n").alias("n")).collect():
            totals.setdefault(tuple(r[c] for c in by), {})[r["_zone"]] = r["n"]
    ends = {tuple(row[c] for c in by): (row.lo, row.hi) for row in whole}
    held, missed = [], []
    for group, wanted in wanted_of.items():
        before = 0
        for zone in range(2 * len(brackets[group]) + 1):
            size = totals[group].get(zone, 0)
            here = {k: names for k, names in wanted.items() if before < k <= before + size}
            if here and zone % 2 and inside is None:
                below = before
                for v, n in sorted(values[(*group, zone)]):
                    for k, names in here.items():
                        if below < k <= below + n:
                            settle(group, names, Found(v, below, n, sizes[group]))
                    below += n
            elif here and zone % 2:
                held.append(_Open(group, *brackets[group][zone // 2], before, here))
            elif here:  # the bracket missed: what lies between its neighbours
                left = brackets[group][zone // 2 - 1][1] if zone else ends[group][0]
                after = brackets[group][zone // 2:]
                right = after[0][0] if after else ends[group][1]
                # rows on the ends belong to the brackets
                less = _rows_at(rows, group, by, left) if zone else 0
                missed.append(_Open(group, left, right, before - less, here))
            before += size
    once = rows.withColumn("_n", F.lit(1).cast("long"))
    for table, open_ in ((inside, held), (once, missed)):
        if open_:
            for group, names, found in _by_levels(table, kind, by, open_, sizes):
                settle(group, names, found)
    return result


def _rows_at(rows: DataFrame, group: tuple, by: Sequence[str], value) -> int:
    """Rows of a group that equal a value."""
    here = F.col("_v") == F.lit(value)
    for c, own in zip(by, group):
        here = here & (F.col(c) == F.lit(own))
    return rows.where(here).count()


def _by_levels(
    rows: DataFrame, kind: T.DataType, by: Sequence[str], todo: list[_Open],
    sizes: Mapping[tuple, int],
):
    """Cut the rows (by, _v, _n) between lo and hi into bins, again and again, until the bin of a
    wanted rank holds one value. Yields (group, names, Found)."""
    spark = rows.sparkSession
    fields = [T.StructField(c, rows.schema[c].dataType) for c in by]
    fields += [T.StructField("_id", T.IntegerType()), T.StructField("_lo", kind),
               T.StructField("_hi", kind), T.StructField("_ranks", T.ArrayType(T.LongType()))]
    rows = rows.where("_v is not null")
    while todo:
        bounds = spark.createDataFrame(
            [(*x.group, i, x.lo, x.hi, [k - x.before for k in x.wanted])
             for i, x in enumerate(todo)],
            T.StructType(fields),
        )  # at most one row per group and rank
        if by:
            placed = rows.join(F.broadcast(bounds), list(by)).where("_v between _lo and _hi")
            counted = placed.groupBy("_id", "_ranks", _bin(kind).alias("_bin"))
        else:
            cases = F.lit(None).cast("int")
            low, high = F.lit(None).cast(kind), F.lit(None).cast(kind)
            for i, x in enumerate(todo):  # disjoint, at most one per rank
                here = F.col("_v").between(F.lit(x.lo).cast(kind), F.lit(x.hi).cast(kind))
                cases = F.when(here, i).otherwise(cases)
                low = F.when(here, F.lit(x.lo).cast(kind)).otherwise(low)
                high = F.when(here, F.lit(x.hi).cast(kind)).otherwise(high)
            placed = rows.select("_v", "_n", cases.alias("_id"), low.alias("_lo"),
                                 high.alias("_hi"))
            placed = placed.where("_id is not null")
            counted = placed.groupBy("_id", _bin(kind).alias("_bin"))
        counted = counted.agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
        )
        if not by:
            counted = counted.join(F.broadcast(bounds.select("_id", "_ranks")), "_id")
        running = Window.partitionBy("_id").orderBy("_bin")  # at most BINS rows each
        hit = counted.withColumn("_upto", F.sum("_n").over(running)).where(
            F.exists(
                "_ranks", lambda k: (k <= F.col("_upto")) & (k > F.col("_upto") - F.col("_n"))
            )
        )
        following = []
        for row in hit.collect():
            x = todo[row["_id"]]
            start = x.before + row["_upto"] - row["_n"]
            here = {k: v for k, v in x.wanted.items() if start < k <= x.before + row["_upto"]}
            if row["_from"] == row["_to"]:
                for names in here.values():
                    yield x.group, names, Found(row["_from"], start, row["_n"], sizes[x.group])
            else:
                following.append(_Open(x.group, row["_from"], row["_to"], start, here))
        todo = following


def _interpolated(found: dict[str, Found], name: str, p: float) -> float | None:
    lo, hi = found[f"{name}_lo"], found[f"{name}_hi"]
    if lo.value is None:
        return None
    position = p * (lo.n - 1)
    a, b = float(lo.value), float(hi.value)
    return a + (b - a) * (position - int(position))


def quantile_table(
    df: DataFrame,
    value: str | Column,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
) -> dict[tuple, dict[str, float | None]]:
    """Exact quantiles with linear interpolation: {group: {name: number}}."""
    ranks: dict[str, Callable[[int], int]] = {}
    for name, p in probabilities.items():
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"a quantile lies between 0 and 1, not {p}")
        ranks[f"{name}_lo"] = lambda n, p=p: int(p * (n - 1)) + 1
        ranks[f"{name}_hi"] = lambda n, p=p: -int(-(p * (n - 1)) // 1) + 1
    return {
        group: {name: _interpolated(found, name, p) for name, p in probabilities.items()}
        for group, found in order_statistics(df, value, ranks, by).items()
    }


def quantiles(
    df: DataFrame,
    value: str | Column,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles as a table: one row (per group), one column per name.

    Without values there is one row of nulls, or none if there are groups.
    """
    found = quantile_table(df, value, probabilities, by)
    if not by and not found:
        found = {(): dict.fromkeys(probabilities)}
    kinds = [T.StructField(c, df.schema[c].dataType) for c in by]
    kinds += [T.StructField(name, T.DoubleType()) for name in probabilities]
    rows = [(*group, *numbers.values()) for group, numbers in found.items()]
    return df.sparkSession.createDataFrame(rows, T.StructType(kinds))


def quantile(df: DataFrame, value: str | Column, p: float) -> float | None:
    """One exact quantile as a number (runs jobs, like ``approxQuantile``); None if empty.

    Jobs use such bounds as literals: the statistic is computed once, and plans that use it
    in several places stay small.
    """
    return quantile_table(df, value, {"q": p}).get((), {}).get("q")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]
) -> dict[str, dict[str, float]]:
    """Exact quantiles of several columns together: {column: {name: number}}."""
    found = quantile_table(long_format(df, columns), "value", probabilities, by=["column"])
    return {group[0]: numbers for group, numbers in found.items()}


def long_format(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows, so that all columns share one scan and one aggregation."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value")


def value_frequencies(df: DataFrame, value: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value (``_v``, ``_n``); null and NaN are left out."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    counts = df.select(*by, v.alias("_v")).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # Null and NaN are one group each. Filtering them after counting, by a condition that
    # needs the count, keeps the optimizer from evaluating ``value`` twice per row.
    return counts.where("case when _v is null or isnan(_v) then 0 else _n end > 0")


def running_totals(
    df: DataFrame, value: str, measures: Sequence[str], descending: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``<measure>_to``: the total over all rows up to this one, in order of ``value``.

    ``df`` must hold each value once (per group ``by``; group first), so that no range of values
    is hot. It is sorted into ranges by a shuffle and written to the shared folder with the
    number of its range. A row's total is that of the earlier ranges of its group, of which there
    are as many as shuffle partitions, plus the running total inside its range. Groups are few
    and not null; any of them may hold most rows.
    """
    by = list(by)
    key = F.col(value).cast("double")
    placed = stored(
        df.withColumn("_key", -key if descending else key)
        .repartitionByRange(*by, "_key")
        .withColumn("_range", F.spark_partition_id()),
        "totals",
    )
    totals = placed.groupBy(*by, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    ahead = Window.partitionBy(*by).orderBy("_range") if by else Window.orderBy("_range")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # a row per shuffle partition, and one more per group
        *by, "_range",
        *[F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"{m}_o") for m in measures],
    )
    inside = Window.partitionBy("_range", *by).orderBy("_key")
    sums = {f"{m}_i": F.sum(m).over(inside) for m in measures}
    return placed.withColumns(sums).join(F.broadcast(offsets), [*by, "_range"]).select(
        *df.columns, *[(F.col(f"{m}_i") + F.col(f"{m}_o")).alias(f"{m}_to") for m in measures]
    )
