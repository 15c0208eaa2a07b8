"""Metrics against brute force."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from encore.operators import metrics
from encore.operators.evaluator import RankingEvaluator


def frame(spark, pairs):
    return spark.createDataFrame(
        [(i, y, float(s)) for i, (y, s) in enumerate(pairs)], "id long, y int, s double")


def brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    points = [(0.0, 1.0)]
    average = 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        hit = sum(1 for y, s in pairs if s >= t and y == 1)
        all_ = sum(1 for _, s in pairs if s >= t)
        point = (hit / len(pos), hit / all_)
        average += (point[0] - points[-1][0]) * point[1]
        points.append(point)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    return auc, area, average, points


@pytest.mark.parametrize("levels", [1, 3, 1000])
def test_areas_equal_brute_force(spark, levels):
    rng = random.Random(levels)
    pairs = [(int(rng.random() < 0.3), rng.randint(0, levels) / levels) for _ in range(300)]
    table = metrics.threshold_table(frame(spark, pairs), "y", "s")
    got = metrics.curve_areas(table).first()
    auc, area, average, points = brute(pairs)
    assert got.roc_auc == pytest.approx(auc, rel=1e-12)
    assert got.prc_auc == pytest.approx(area, rel=1e-12)
    assert got.average_precision == pytest.approx(average, rel=1e-12)
    curve = sorted((r.recall, r.precision) for r in metrics.pr_curve(table).collect())
    assert np.allclose(curve, sorted(points), rtol=1e-12)


def test_first_segment_of_a_mixed_top_group(spark):
    # Both top rows tie: the curve runs from (0, 1) to (1, 0.5).
    table = metrics.threshold_table(frame(spark, [(1, 0.9), (0, 0.9), (0, 0.1)]), "y", "s")
    got = metrics.curve_areas(table).first()
    assert got.prc_auc == pytest.approx(0.75) and got.average_precision == pytest.approx(0.5)


def test_one_class_has_no_roc_area(spark):
    got = metrics.curve_areas(metrics.threshold_table(frame(spark, [(1, 0.2), (1, 0.4)]), "y", "s")).first()
    assert got.roc_auc is None and got.prc_auc == pytest.approx(1.0)


def test_f1_threshold_takes_the_lowest_on_ties(spark):
    # 0.8 -> p=1, r=1/2; 0.3 -> p=1/2, r=1: both have F1 = 2/3 and 0.5 -> p=1/2, r=1/2.
    pairs = [(1, 0.8), (0, 0.5), (1, 0.3), (0, 0.3)]
    best = metrics.best_f1_threshold(metrics.threshold_table(frame(spark, pairs), "y", "s")).first()
    assert best.best_threshold == 0.3 and best.best_f1 == pytest.approx(2 / 3)


def test_report(spark):
    cells = [(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)] * 4
    df = spark.createDataFrame(cells, "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert got["1"].precision == pytest.approx(0.6) and got["1"].recall == pytest.approx(0.75)
    assert got["0"].precision == pytest.approx(0.8) and got["0"].support == 6
    assert got["1"].accuracy == pytest.approx(0.7)
    assert got["macro avg"].precision == pytest.approx(0.7)
    assert got["weighted avg"].recall == pytest.approx(0.7)
    long = metrics.report_long(metrics.classification_report(df, "y", "p"))
    assert long.count() == 12
    never = metrics.classification_report(df.selectExpr("y", "0 as p"), "y", "p")
    assert {r["class"]: r.precision for r in never.collect()}["1"] == 0.0


def test_top_share_precision(spark):
    pairs = [(int(i >= 15), i / 20) for i in range(20)]
    df = frame(spark, pairs)
    assert metrics.top_share_precision(df, "y", "s", "id").first()[0] == 1.0
    assert metrics.top_share_precision(df.limit(9), "y", "s", "id").first()[0] is None


@pytest.mark.parametrize("levels", [2, 1000])
def test_evaluator_equals_curve_areas(spark, levels, tmp_path):
    rng = random.Random(levels + 1)
    pairs = [(int(rng.random() < 0.3), rng.randint(0, levels) / levels) for _ in range(200)]
    df = frame(spark, pairs)
    vectors = df.withColumn("probability", array_to_vector(F.array(1 - F.col("s"), F.col("s"))))
    for name, value in zip(("roc_auc", "prc_auc", "average_precision"), brute(pairs)):
        plain = RankingEvaluator(labelCol="y", scoreCol="s", metricName=name)
        assert plain.evaluate(df) == pytest.approx(value, rel=1e-12)
        vector = RankingEvaluator(labelCol="y", metricName=name)
        assert vector.evaluate(vectors) == pytest.approx(value, rel=1e-12)
    plain.write().overwrite().save(str(tmp_path / "e"))
    again = RankingEvaluator.load(str(tmp_path / "e"))
    assert again.evaluate(df) == plain.evaluate(df) and again.isLargerBetter()
    assert plain.evaluate(df.where("y = 0")) == 0.0 and plain.evaluate(df.limit(0)) == 0.0
    with pytest.raises(ValueError):
        RankingEvaluator(metricName="f1")


def test_evaluator_selects_over_given_folds(spark):
    """A grid search over a fold column; means equal those of single fits."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 2))
    y = (x[:, 0] + rng.normal(size=240) > 0.4).astype(float)
    df = spark.createDataFrame(
        [(float(y[i]), i % 3, [float(v) for v in x[i]]) for i in range(240)],
        "label double, fold int, a array<double>").withColumn("features", array_to_vector("a"))
    model = LogisticRegression(standardization=False)
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 5.0]).addGrid(
        model.maxIter, [1, 30]).build()
    search = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=RankingEvaluator(),
                            numFolds=3, foldCol="fold", parallelism=2)
    got = search.fit(df).avgMetrics
    for params, mean in zip(grid, got):
        scores = []
        for fold in range(3):
            fitted = model.copy(params).fit(df.where(F.col("fold") != fold))
            scored = fitted.transform(df.where(F.col("fold") == fold))
            pairs = [(int(r.label), float(r.probability[1])) for r in scored.collect()]
            scores.append(brute(pairs)[2])
        assert mean == pytest.approx(sum(scores) / 3, abs=1e-9)
