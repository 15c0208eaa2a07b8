"""Operators against hand-made rows and brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from encore.operators import (
    aggregates, caps, filters, fitted, joins, order_stats, profile, ranking, scaling, split,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_survives_negative_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert {r.s for r in filters.keep_unless_in(df, "s", ["a"]).collect()} == {"b", None}
    assert {r.s for r in filters.keep_unless_equal(df, "s", "b").collect()} == {"a", None}


def test_box_edges_are_inside(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.1, 1.0), (None, 1.0)], "lat double, lng double")
    assert filters.inside_box(df, "lat", "lng", (-5.0, 5.0), (1.0, 1.0)).count() == 1


def test_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "v double")
    got = [r[0] for r in df.select(filters.true_only(F.col("v") == 0)).collect()]
    assert got == [True, False, False]


@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e9])
def test_quantiles_equal_numpy(spark, scale):
    rng = random.Random(7)
    data = [rng.choice([-1, 1]) * rng.random() ** 3 * scale for _ in range(997)] + [0.0] * 50
    df = spark.createDataFrame([(v,) for v in data] + [(None,), (float("nan"),)], "v double")
    wanted = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.77, "e": 0.999, "f": 1.0}
    got = order_stats.quantiles(df, "v", wanted).first()
    for name, p in wanted.items():
        assert got[name] == pytest.approx(np.quantile(data, p), rel=1e-12, abs=1e-18)


def test_quantiles_with_one_hot_value(spark):
    data = [3.25] * 400 + [1.0, 7.0] * 100
    df = spark.createDataFrame([(v,) for v in data], "v double")
    got = order_stats.quantiles(df, "v", {"q": 0.5, "r": 0.9}).first()
    assert (got.q, got.r) == (np.quantile(data, 0.5), np.quantile(data, 0.9))


def test_quantiles_per_group_and_empty(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 5.0)], "g string, v double")
    got = {r.g: r.m for r in order_stats.quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {"x": 1.5, "y": 5.0}
    assert order_stats.quantile(df.limit(0), "v", 0.5) is None
    with pytest.raises(ValueError):
        order_stats.quantile(df, "v", 99.9)


def test_order_statistics_keep_types_and_split_narrow_ranges(spark):
    near = [i * 1e-12 for i in range(20_000)]  # all close to zero
    big = [2**60 + i for i in range(500)] + [-(2**63), 2**63 - 1]
    ranks = {"a": lambda n: 1, "b": lambda n: n // 2, "c": lambda n: n, "d": lambda n: n + 1}
    for data, kind in ((near, "double"), (big, "long")):
        df = spark.createDataFrame([(v,) for v in data + data[:3]], f"v {kind}")
        found = order_stats.order_statistics(df, "v", ranks)[()]
        ordered = sorted(data + data[:3])
        for name, rank in ranks.items():
            k = rank(len(ordered))
            if k > len(ordered):
                assert found[name].value is None
                continue
            value = ordered[k - 1]
            assert found[name].value == value
            assert found[name].below == sum(v < value for v in ordered)
            assert found[name].equal == ordered.count(value)
    odd = spark.createDataFrame(
        [(v,) for v in [float("inf"), float("-inf"), -0.0, 0.0, 1e308, -1e308, None]], "v double"
    )
    assert order_stats.order_statistics(odd, "v", {"m": lambda n: 3})[()]["m"].value == 0.0
    with pytest.raises(TypeError):
        order_stats.quantile(spark.createDataFrame([("x",)], "v string"), "v", 0.5)


def test_no_bin_is_hot_on_narrow_ranges(spark, monkeypatch):
    df = spark.createDataFrame([(1.7e15 + i * 5000.0,) for i in range(20_000)], "v double")
    kind = order_stats._typed(df, "v", [])[1]
    ends = df.selectExpr("min(v) as _lo", "max(v) as _hi")
    binned = df.withColumnRenamed("v", "_v").crossJoin(ends)
    largest = binned.groupBy(order_stats._bin(kind)).count().agg(F.max("count")).first()[0]
    assert largest < 100


def test_exact_sizes_with_repeated_and_large_keys(spark):
    repeated = spark.createDataFrame([(i // 10, 0.5) for i in range(40)], "id long, s double")
    assert ranking.top_share(repeated, "s", "id", 0.1).count() == 4
    assert ranking.sample_rows(repeated, "id", 1, 1).count() == 1
    large = spark.createDataFrame([(2**60 + i, 0.5) for i in range(40)], "id long, s double")
    got = sorted(r.id for r in ranking.top_share(large, "s", "id", 0.1).collect())
    assert got == [2**60 + i for i in range(4)]
    same = spark.createDataFrame([("k", "x")] * 50 + [("k", "y")] * 10, "k string, label string")
    sizes = dict(
        tuple(r) for r in split.stratified_split(same, "label", "k").where("split = 'test'")
        .groupBy("label").count().collect()
    )
    assert sizes == {"x": 10, "y": 2}
    folds = split.assign_folds(same, "label", "k").groupBy("label", "fold").count().collect()
    assert sorted(r["count"] for r in folds) == [2] * 5 + [10] * 5
    with pytest.raises(ValueError):
        many = spark.range(200).selectExpr("cast(id as string) as k", "cast(id as string) as label")
        split.stratified_split(many, "label", "k")


def test_running_totals_equal_cumulative_sums(spark):
    rng = random.Random(3)
    data = sorted({round(rng.gauss(0, 5), 3) for _ in range(500)} | {1e-9, 2e-9, -1e12, 1e12})
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(data)], "v double, n int")
    for descending in (False, True):
        got = order_stats.running_totals(df, "v", ["n"], descending).toPandas()
        got = got.sort_values("v", ascending=not descending)
        assert (got.n.cumsum() == got.n_to).all() and len(got) == len(data)


def test_caps(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)] + [(None,)], "v double")
    capped = [r.v for r in caps.cap_at_percentile(df, ["v"], 99.0).collect()]
    assert max(v for v in capped if v is not None) == 99.0 and capped.count(None) == 1
    both = [r.v for r in caps.cap_outliers(df, "v", True, True).collect() if r.v is not None]
    assert (min(both), max(both)) == (1.0, 99.0)
    fixed = [r.v for r in caps.cap_outliers(df, "v", False, 0.999).collect() if r.v is not None]
    assert max(fixed) == 0.999  # a number is an absolute cap, not a quantile
    assert rows(caps.cap_outliers(df.na.drop(), "v")) == rows(df.na.drop())
    with pytest.raises(ValueError):
        caps.cap_at_percentile(df, ["v"], 999.0)


def test_median_offset_fill(spark):
    df = spark.sql("""select * from values
        (timestamp'2017-01-10', timestamp'2017-01-20'), (timestamp'2017-01-10', timestamp'2017-01-14'),
        (null, timestamp'2017-02-08'), (null, null) t(got, due)""")
    filled = caps.fill_by_median_offset(df, "got", "due").select(F.date_format("got", "yyyy-MM-dd"))
    assert [r[0] for r in filled.collect()] == ["2017-01-10", "2017-01-10", "2017-02-01", None]
    nothing = df.where("got is null")
    assert caps.fill_by_median_offset(nothing, "got", "due").where("got is null").count() == 2


def test_equal_prices_are_no_discount(spark):
    items = spark.createDataFrame(
        [("p", 0.1)] * 3 + [("q", 1.0), ("q", 2.0), ("r", None)], "product_id string, price double")
    flagged = items.join(aggregates.price_totals(items), "product_id").select(
        "product_id", "price", aggregates.below_mean().alias("d"))
    got = {(r.product_id, r.price): r.d for r in flagged.collect()}
    assert got == {("p", 0.1): False, ("q", 1.0): True, ("q", 2.0): False, ("r", None): False}


def test_payments_per_order(spark):
    pay = spark.createDataFrame(
        [(1, "voucher", 30.0, 1), (1, "boleto", 70.0, 2), (2, "voucher", 0.0, 3),
         (3, None, 5.0, 4), (4, "voucher", None, None)],
        "order_id int, payment_type string, payment_value double, payment_installments int")
    got = {r.order_id: r for r in aggregates.payments_per_order(pay, ["voucher", "boleto"]).collect()}
    assert (got[1].voucher, got[1].boleto, got[1].total_spent, got[1].installment) == (0.3, 0.7, 100.0, 3)
    assert (got[2].voucher, got[2].total_spent) == (0.0, 0.0)
    assert (got[3].voucher, got[3].total_spent, got[3].installment) == (None, None, 4)
    assert (got[4].total_spent, got[4].installment) == (0.0, 0)


def test_zip_centroids_range_edge(spark):
    pts = spark.createDataFrame(
        [("a", 1.0, 1.0), ("a", 1.5, 1.0), ("b", 1.0, 1.0), ("b", 1.51, 1.0), (None, 1.0, 1.0)],
        "z string, lat double, lng double")
    assert rows(aggregates.zip_centroids(pts, "z", "lat", "lng", 0.5)) == [("a", 1.25, 1.0)]
    assert aggregates.zip_centroids(pts, "z", "lat", "lng").count() == 2


def test_lookup_replace(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz")], "id int, c string")
    table = spark.createDataFrame([("a", "A"), ("b", "B1"), ("b", "B2")], "k string, v string")
    assert {r.id: r.c for r in joins.lookup_replace(df, "c", table, "k", "v").collect()} == {
        1: "A", 2: "B2", 3: None, 4: None}


def test_first_per_key_ignores_row_order(spark):
    items = [(1, 2, "p2"), (1, 1, "p9"), (1, 1, "p1"), (2, 5, "x")]
    for data in (items, items[::-1]):
        df = spark.createDataFrame(data, "order_id int, n int, product_id string")
        assert rows(ranking.first_per_key(df, "order_id", ["n"], ["product_id"])) == [(1, "p1"), (2, "x")]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "b", "a", "c", None, None, None]], "c string")
    assert [tuple(r) for r in ranking.top_values(df, "c", 2).collect()] == [("b", 2), ("a", 1)]
    flags = ranking.in_top_values(df, "c", 1, "top").collect()
    assert sum(r.top for r in flags) == 2 and len(flags) == 7


@pytest.mark.parametrize("share", [0.0, 0.1, 0.35, 1.0])
def test_top_share_with_many_ties(spark, share):
    rng = random.Random(5)
    data = [(i, rng.choice([0.9, 0.5, 0.5, 0.5, 0.1])) for i in range(203)]
    df = spark.createDataFrame(data, "id long, s double")
    want = sorted(data, key=lambda r: (-r[1], r[0]))[: int(len(data) * share)]
    assert rows(ranking.top_share(df, "s", "id", share)) == sorted(want)


def test_top_share_of_nine_rows_is_empty(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(9)], "id long, s double")
    assert ranking.top_share(df, "s", "id", 0.1).count() == 0


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    first = rows(ranking.sample_rows(df, "id", 37, 1))
    assert len(first) == 37 and first == rows(ranking.sample_rows(df.repartition(7), "id", 37, 1))
    assert first != rows(ranking.sample_rows(df, "id", 37, 2))
    assert ranking.sample_rows(df, "id", 900, 1).count() == 500


def test_split_sizes_per_label(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5, "f": 100}
    data = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "id string, y string")
    placed = split.stratified_split(df, "y", "id")
    got = {r.y: r.n for r in placed.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {"c": 1, "d": 1, "e": 1, "f": 20}
    assert rows(placed) == rows(split.stratified_split(df.repartition(5), "y", "id"))
    with pytest.raises(ValueError):
        split.stratified_split(df, "missing", "id")
    with pytest.raises(ValueError):
        split.stratified_split(df.limit(0), "y", "id")
    flat = split.stratified_split(df, "y", "id", stratify=False)
    assert flat.where("split = 'test'").count() == 23


def test_folds_are_even_per_label(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(150)], "id long, y boolean")
    counts = split.assign_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    assert {(r.y, r["count"]) for r in counts} == {(True, 10), (False, 20)} and len(counts) == 10


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4), (3.0, 4)], "a double, b int")
    assert rows(scaling.standard_scale(df, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_of_unseen_value(spark):
    seen = spark.createDataFrame([("b",), ("a",)], "c string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "id int, c string")
    assert {r.id: r.slot for r in scaling.one_hot_long(new, "id", "c", seen).collect()} == {
        1: 0, 2: 1, 3: None}


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    found = profile.duplicate_profile(df).first()
    assert (found.n_rows, found.duplicate_rows, found.duplicate_pct) == (6, 3, 50.0)
    assert profile.duplicated_rows(df).count() == 5
    assert profile.duplicate_profile(df, ["b"]).first().duplicate_rows == 4
    assert profile.duplicate_profile(df.limit(0)).first().duplicate_pct == 0.0


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, "x")], "a int, b string")
    got = profile.null_profile(df).first()
    assert (got.n_rows, got.rows_with_null, got.nulls_a, got.nulls_b) == (3, 2, 1, 2)


def test_describe_equals_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 4.0, None], "b": [1, 2, 3, 10]})
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (4.0, 3), (None, 10)], "a double, b int")
    want = pdf.describe()
    for r in profile.describe_numeric(df).collect():
        got = [r[c] for c in ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]]
        assert got == pytest.approx(want[r["column"]].tolist())


def test_histogram_equals_numpy(spark):
    data = [0.0, 0.1, 1.0, 2.5, 9.99, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    want, _ = np.histogram(data, bins=4)
    assert profile.histogram(df, "v", 40).count() == 40
    got = {r.bin: r.n for r in profile.histogram(df, "v", 4).collect()}
    assert [got.get(i, 0) for i in range(4)] == want.tolist()
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    want, _ = np.histogram([3.0, 3.0], bins=5)
    got = {r.bin: r.n for r in profile.histogram(same, "v", 5).collect()}
    assert [got.get(i, 0) for i in range(5)] == want.tolist()


@pytest.mark.parametrize("shift,small", [(0, 50_000), (0, 0), (5, 50_000), (-7, 0)])
def test_brackets_that_miss_their_rank(spark, monkeypatch, shift, small):
    """Exact ranks when approximate quantiles are off, and when the inside is ordered by levels."""
    rng = random.Random(shift)
    values = [float(rng.choice([rng.gauss(0, 1), 0.25, -1e9, rng.randrange(50)])) for _ in range(3000)]
    rows = [(rng.choice("aab"), v) for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    honest = order_stats._brackets

    def moved(row, wanted, kind):
        found = honest(row, wanted, kind)
        return [(lo + shift, hi + shift) for lo, hi in found]

    monkeypatch.setattr(order_stats, "_brackets", moved)
    monkeypatch.setattr(order_stats, "SMALL", small)
    ranks = {"one": lambda n: 1, "low": lambda n: n // 100 + 1, "mid": lambda n: n // 2,
             "next": lambda n: n // 2 + 1, "high": lambda n: n - 20, "last": lambda n: n,
             "none": lambda n: n + 1}
    for by in ([], ["g"]):
        got = order_stats.order_statistics(df, "v", ranks, by)
        for group in {tuple(r[:1]) if by else () for r in rows}:
            own = sorted(v for g, v in rows if not by or (g,) == group)
            for name, rank in ranks.items():
                k, found = rank(len(own)), got[group][name]
                if name == "none":
                    assert found.value is None
                    continue
                assert found.value == own[k - 1] and found.n == len(own)
                assert found.below == sum(v < own[k - 1] for v in own)
                assert found.equal == own.count(own[k - 1])


def test_ranks_take_two_scans(spark, monkeypatch):
    """Whatever the distribution: bounds and grid, then counts."""
    df = spark.range(200_000).selectExpr("case when id % 3 = 0 then 7 else exp(id / 9000) end as v")
    levels = []
    monkeypatch.setattr(order_stats, "_by_levels", lambda *a: levels.append(1) or iter(()))
    got = order_stats.order_statistics(df, "v", {"a": lambda n: n // 2, "b": lambda n: n - 3})[()]
    assert not levels
    own = sorted(r.v for r in df.collect())
    assert (got["a"].value, got["b"].value) == (own[99_999], own[199_996])


def test_fitted_stages_are_stored_and_applied_to_new_rows(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    rng = random.Random(9)
    values = [(float(rng.gauss(10, 5)), None, rng.randrange(100)) for _ in range(500)]
    schema = "price double, none double, n int"
    train = spark.createDataFrame(values + [(None, None, None)], schema)
    cap = fitted.PercentileCap(inputCols=["price", "none", "n"], lower=5.0, upper=99.9)
    model = Pipeline(stages=[cap]).fit(train)
    model.write().overwrite().save(str(tmp_path / "caps"))
    back = PipelineModel.load(str(tmp_path / "caps"))
    new = spark.createDataFrame(
        [(1e6, 1e6, 1000), (-1e6, -1e6, -1000), (10.0, None, 50), (None, None, None)], schema)
    price = np.array([v[0] for v in values])
    n = np.array([v[2] for v in values])
    low, high = np.quantile(price, [0.05, 0.999])
    got = back.transform(new).collect()
    assert got == model.transform(new).collect()
    assert [r.price for r in got] == [pytest.approx(high), pytest.approx(low), 10.0, None]
    assert [r.none for r in got] == [1e6, -1e6, None, None]
    assert [r.n for r in got] == [
        pytest.approx(np.quantile(n, 0.999)), pytest.approx(np.quantile(n, 0.05)), 50, None]
    only_upper = fitted.PercentileCap(inputCols=["n"], upper=50.0).fit(train).transform(new)
    assert [r.n for r in only_upper.collect()] == [np.quantile(n, 0.5), -1000, min(50, np.quantile(n, 0.5)), None]
    with pytest.raises(ValueError):
        fitted.PercentileCap(inputCols=["n"], upper=101.0)


def test_fitted_median_offset(spark, tmp_path):
    days = "timestamp'2020-01-01' + make_interval(0, 0, 0, {})"
    train = spark.range(7).selectExpr(
        f"case when id < 5 then {days.format('cast(id as int)')} end as done",
        f"{days.format('10')} as due")  # due - done: 10, 9, 8, 7, 6 days
    new = spark.sql("select cast(null as timestamp) as done, timestamp'2021-05-20' as due "
                    "union all select timestamp'2021-01-01', timestamp'2021-05-20'")
    model = fitted.MedianOffsetFill(target="done", anchor="due").fit(train)
    model.write().save(str(tmp_path / "offset"))
    back = fitted.MedianOffsetFillModel.load(str(tmp_path / "offset"))
    assert [str(r.done.date()) for r in back.transform(new).collect()] == ["2021-05-12", "2021-01-01"]
    empty = fitted.MedianOffsetFill(target="done", anchor="due").fit(train.where("done is null"))
    assert [r.done is None for r in empty.transform(new).collect()] == [True, False]


def test_rank_groups_by_literals_and_by_join_agree(spark, monkeypatch):
    df = spark.range(6000).selectExpr(
        "concat('c', id % 3) as g", "if(id % 11 = 0, null, id * 7919 % 5003) as whole",
        "if(id % 13 = 0, double('nan'), if(id % 7 = 0, null, id % 911 / 3)) as part",
        "cast(if(id % 7 = 0, null, id % 911) as decimal(12,2)) as money")
    ranks = {"low": lambda n: n // 10, "mid": lambda n: n // 2, "none": lambda n: n + 1}
    for column in ("whole", "part", "money"):
        values = df.select("g", column).dropna().collect()
        found = order_stats.order_statistics(df, column, ranks, ["g"])
        for group in ("c0", "c1", "c2"):
            own = sorted(r[1] for r in values if r.g == group)
            got = found[group,]
            assert got["none"].value is None and got["mid"].n == len(own)
            assert got["mid"].value == own[len(own) // 2 - 1] and got["low"].value == own[len(own) // 10 - 1]
        monkeypatch.setattr(order_stats, "MAX_LITERALS", 0)
        assert order_stats.order_statistics(df, column, ranks, ["g"]) == found
        monkeypatch.undo()


def test_folds_make_the_keys_of_a_row_once(spark):
    df = spark.range(3000).selectExpr("id", "id % 4 = 0 as y")
    folded = split.assign_folds(df, "y", "id")
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") <= 3  # one per key, not one per fold and label
    assert folded.columns == ["id", "y", "fold"]
    sizes = {(r.y, r.fold): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    assert sizes == {(y, i): n for y, n in ((True, 150), (False, 450)) for i in range(5)}
