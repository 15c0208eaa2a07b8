"""Model jobs: invariants instead of equal numbers, as solvers differ."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.fixture import SETTINGS, Fixture
from encore import session
from encore.operators import newton, ridge, split
from encore.operators.metrics import curve_areas, threshold_table
from encore.plans import preprocessing, stages, training, tuning, weak_labels
from encore.sources.catalog import Catalog

SMALL = replace(
    SETTINGS, trees=5, tree_depth=4, boosted_a_rounds=3, boosted_a_depth=3, boosted_b_rounds=3, boosted_b_depth=3, logistic_iterations=200,
    grid_c=[0.1, 1.0], grid_iterations=[2, 200], grid_weights=["balanced"], folds=3,
)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def everything(spark, tmp_path_factory):
    f = Fixture(spark, SF)
    raw = {n: getattr(f, n) for n in ["orders", "items", "payments", "customers", "sellers",
                                      "geolocation", "reviews", "products", "translation"]}
    catalog = Catalog(spark, str(tmp_path_factory.mktemp("base")))
    tables, models = stages.run_all(raw, SMALL, catalog)
    return catalog, tables, models


def test_whole_run_invariants(everything):
    _, tables, models = everything
    labels = tables["mega_id_labels"]
    assert labels.count() == labels.select("order_id").distinct().count()
    inputs = tables["model_inputs"]
    assert inputs.count() == inputs.na.drop().distinct().count() > 300
    odd = inputs.where(
        "abs(credit_card + voucher + debit_card + boleto - 1) > 1e-9 and total_spent > 0")
    assert odd.count() == 0
    for name, trained in models.items():
        m = trained.metrics
        assert 0.4 <= m["roc_auc"] <= 1.0, name
        assert trained.top.count() == int(trained.predictions.count() * 0.1)


def test_stored_outputs(everything):
    catalog, tables, models = everything
    assert catalog.load("logistic_metrics").first().roc_auc == models["logistic"].metrics["roc_auc"]
    assert catalog.load("ssl_bias_report").count() == 1
    assert catalog.load("boosted_b_predictions_test").count() == models["boosted_b"].predictions.count()
    loaded = catalog.load_model("random_forest")
    again = loaded.transform(models["random_forest"].predictions.select("features"))
    assert again.count() == models["random_forest"].predictions.count()
    assert catalog.load("tuned_logistic_metrics").first().best_params["C"] in ("0.1", "1.0")


def test_pseudo_labels_cover_the_weak_signs(everything):
    _, tables, models = everything
    weak = tables["weak_positive_mask"].where("weak_positive").count()
    positives = tables["pseudo_labeled_data"].where("is_repeat_buyer = 1").count()
    report = tables["ssl_bias_report"].first()
    assert positives >= weak > 0
    scored = models["tuned_logistic"].predictions
    assert scored.select("y_proba").distinct().count() > scored.count() / 2
    assert int(report["total_pseudo_positives"]) == positives


def small_frame(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=200) > 0.5).astype(float)
    rows = [(i, float(y[i]), [float(v) for v in x[i]]) for i in range(200)]
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame(rows, "row_key long, label double, a array<double>")
    return df.withColumn("features", array_to_vector("a")).drop("a"), x, y


def test_logistic_equals_newton_solution(spark):
    df, x, y = small_frame(spark)
    trained = training.train_logistic(df, df, ["a", "b", "c"], SMALL)
    w = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (200 - y.sum())))
    xb = np.hstack([x, np.ones((200, 1))])
    beta = np.zeros(4)
    penalty = np.diag([1.0, 1.0, 1.0, 0.0])  # C = 1; the intercept is free
    for _ in range(50):
        p = 1 / (1 + np.exp(-xb @ beta))
        grad = xb.T @ (w * (p - y)) + penalty @ beta
        hess = (xb * (w * p * (1 - p))[:, None]).T @ xb + penalty
        beta -= np.linalg.solve(hess, grad)
    model = trained.model.stages[0]
    assert model.coefficients.toArray() == pytest.approx(beta[:3], abs=2e-3)
    assert trained.metrics["roc_auc"] > 0.9
    assert list(trained.importance) == ["b", "a", "c"]


def test_penalized_intercept_equals_newton_solution(spark, tmp_path):
    """Stored, scored and searched like the free one."""
    df, x, y = small_frame(spark)
    settings = replace(SMALL, penalize_intercept=True, logistic_c=0.05)
    trained = training.train_logistic(df, df, ["a", "b", "c"], settings)
    w = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (200 - y.sum())))
    xb = np.hstack([x, np.ones((200, 1))])
    beta = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-xb @ beta))
        grad = xb.T @ (w * (p - y)) + beta / 0.05
        beta -= np.linalg.solve((xb * (w * p * (1 - p))[:, None]).T @ xb + np.eye(4) / 0.05, grad)
    fitted = trained.model.stages[0]
    assert fitted.coefficients.toArray() == pytest.approx(beta[:3], abs=1e-6)
    assert fitted.getOrDefault("intercept") == pytest.approx(beta[3], abs=1e-6)
    assert list(trained.importance) == ["b", "a", "c"]
    catalog = Catalog(spark, str(tmp_path))
    catalog.save_model(trained.model, "logistic")
    loaded = catalog.load_model("logistic").transform(df)
    got = {r.row_key: r.probability[1] for r in loaded.select("row_key", "probability").collect()}
    assert [got[i] for i in range(200)] == pytest.approx(list(1 / (1 + np.exp(-xb @ beta))), abs=1e-6)
    assert trained.predictions.columns == ["row_key", "features", "y_true", "y_pred", "y_proba"]
    settings = replace(settings, grid_c=[0.05], grid_iterations=[200])
    tuned = tuning.tune_logistic(df, df, ["a", "b", "c"], settings)
    again = tuned.model.stages[0].coefficients.toArray()
    assert again == pytest.approx(beta[:3], abs=1e-6)


def test_ridge_edges(spark):
    df, _, _ = small_frame(spark)
    one = ridge.RidgeLogistic().fit(df.where("label = 1"))
    assert {r.prediction for r in one.transform(df).collect()} == {1.0}
    none = ridge.RidgeLogistic().fit(df.limit(0)).transform(df.limit(0))
    assert none.count() == 0 and "probability" in none.columns
    plain = ridge.RidgeLogistic(penalty=0.5).fit(df)
    with_null = df.unionByName(df.limit(1).withColumn("label", F.lit(None).cast("double")))
    assert ridge.RidgeLogistic(penalty=0.5).fit(with_null).coefficients == plain.coefficients
    with pytest.raises(ValueError):
        ridge.RidgeLogistic(weightCol="w").fit(df.withColumn("w", F.col("row_key") * 1.0))
    with pytest.raises(ValueError):
        ridge.RidgeLogistic().fit(df.withColumn("label", F.col("label") + 1))


def test_same_seed_same_result_and_skip(spark):
    df, _, _ = small_frame(spark)
    a, b = (training.train_random_forest(df, df, ["a", "b", "c"], SMALL).metrics for _ in range(2))
    assert a == b
    skipped = training.train_random_forest(
        df, df, [], replace(SMALL, skip=frozenset({"random_forest"})))
    assert skipped.metrics == {"skipped": True} and skipped.predictions.count() == 0
    assert {"y_true", "y_pred", "y_proba"} <= set(skipped.top.columns)


def test_trees_do_not_depend_on_input_partitions(spark):
    df, _, _ = small_frame(spark)
    for train in (training.train_random_forest, training.train_boosted_a):
        a, b = (train(df.repartition(n), df, ["a", "b", "c"], SMALL).importance for n in (2, 8))
        assert a == b


def test_iteration_limits_that_do_not_bind_share_a_score(spark):
    df, _, _ = small_frame(spark)
    settings = replace(SMALL, grid_iterations=[1, 200, 300])
    found = dict(tuning.grid_search(df, settings))
    for c in settings.grid_c:
        scores = [found[tuning.Candidate(c, n, "balanced")] for n in (1, 200, 300)]
        assert scores[1] == scores[2]


def plain_average_precision(label, score):
    order = np.argsort(-score, kind="stable")
    label, score = label[order], score[order]
    last = np.concatenate((score[1:] != score[:-1], [True]))
    tp, n = np.cumsum(label)[last], np.flatnonzero(last) + 1
    return float((np.diff(np.concatenate(([0], tp))) / label.sum() * tp / n).sum())


def test_grid_search_equals_single_fits(spark):
    df, _, _ = small_frame(spark)
    settings = replace(SMALL, grid_c=[0.01, 1.0, 10.0], grid_weights=["balanced", None], folds=3)
    found = dict(tuning.grid_search(df, settings))
    folded = tuning.assign_folds(df, "label", "row_key", 3, settings.seed).cache()
    for c in settings.grid_c:
        for weighting in settings.grid_weights:
            scores = []
            for fold in range(3):
                part, rest = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
                weighted = training.with_weights(part, training.class_weights(part, weighting))
                total = weighted.agg(F.sum("weight")).first()[0]
                single = training.logistic(c, 500, total).setTol(1e-12).fit(weighted)
                rows = training.score(single, rest).select("y_true", "y_proba").toPandas()
                scores.append(plain_average_precision(*rows.to_numpy().T))
            got = found[tuning.Candidate(c, settings.grid_iterations[-1], weighting)]
            assert got == pytest.approx(sum(scores) / 3, abs=1e-6)


def newton_rows(spark, x, y, folds):
    rows = [([float(v) for v in a], float(b), int(f)) for a, b, f in zip(x, y, folds)]
    return spark.createDataFrame(rows, "features array<double>, label double, fold int")


def test_problems_fitted_together(spark, monkeypatch):
    """Against Newton steps in plain numpy; with badly scaled rows, one class and no rows."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3)) * [1, 30, 0.01]
    y = (x[:, 0] + rng.normal(size=300) > 0.7).astype(float)
    folds = rng.integers(0, 3, 300)
    y[folds != 2] = np.where(rng.random((folds != 2).sum()) < 0.5, 0.0, y[folds != 2])
    rows = newton_rows(spark, x, y, folds).repartition(5)
    problems = [newton.Problem(0.1, (1.0, 4.0), 0), newton.Problem(10.0, left_out=1),
                newton.Problem(1e-4), newton.Problem(1.0, penalize_intercept=True)]
    counts = {
        f: {c: int(((y == c) & ((folds != f) if f is not None else True)).sum()) for c in (0.0, 1.0)}
        for f in (0, 1, 2, None)
    }
    passes = []
    one_pass = newton._pass
    monkeypatch.setattr(newton, "_pass", lambda *a: passes.append(1) or one_pass(*a))
    fits = newton.fit_together(rows, problems, 3, counts)
    assert len(passes) <= 15
    for problem, fit in zip(problems, fits):
        used = folds != problem.left_out if problem.left_out is not None else folds >= 0
        w = np.where(y[used] == 1, problem.weights[1], problem.weights[0])
        xb = np.hstack([x[used], np.ones((used.sum(), 1))])
        ridge = np.diag([problem.penalty] * 3 + [problem.penalty * problem.penalize_intercept])
        beta = np.zeros(4)
        for _ in range(60):
            p = 1 / (1 + np.exp(-xb @ beta))
            grad = xb.T @ (w * (p - y[used])) + ridge @ beta
            beta -= np.linalg.solve((xb * (w * p * (1 - p))[:, None]).T @ xb + ridge, grad)
        assert fit.converged and fit.path[-1] == pytest.approx(beta, rel=1e-6, abs=1e-6)
    one, none = newton.fit_together(
        rows, [newton.Problem(1.0), newton.Problem(1.0, left_out=0)], 3,
        {None: {1.0: 300}, 0: {}})
    assert list(one.path[-1]) == [0, 0, 0, np.inf] and list(none.path[-1]) == [0, 0, 0, 0]


def test_step_that_raises_the_loss_is_halved(spark):
    """From a far start plain Newton steps diverge on separable rows with a small penalty."""
    x = np.array([[v] for v in (-3.0, -2.0, -1.0, 1.0, 2.0, 50.0)])
    y = np.array([0.0, 0, 0, 1, 1, 1])
    rows = newton_rows(spark, x, y, [0] * 6)
    fit, = newton.fit_together(rows, [newton.Problem(1e-3)], 1, {None: {0.0: 3, 1.0: 3}})
    beta = fit.path[-1]
    p = 1 / (1 + np.exp(-(x[:, 0] * beta[0] + beta[1])))
    assert fit.converged
    assert abs(x[:, 0] @ (p - y) + 1e-3 * beta[0]) < 1e-5 and abs((p - y).sum()) < 1e-5


def test_thresholds_and_areas_by_group(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), float(rng.random() < 0.3), float(rng.integers(0, 15)) / 15)
            for g in rng.choice([0, 1, 2], 400, p=[0.8, 0.15, 0.05])]
    df = spark.createDataFrame(rows, "problem int, label double, score double")
    got = {r.problem: r for r in curve_areas(
        threshold_table(df, "label", "score", ["problem"]), ["problem"]).collect()}
    for g in (0, 1, 2):
        alone = curve_areas(threshold_table(df.where(F.col("problem") == g), "label", "score")).first()
        for name in ("roc_auc", "prc_auc", "average_precision"):
            assert got[g][name] == pytest.approx(alone[name], abs=1e-12)


def test_preprocessor_scales_and_names(spark):
    base = {c: "cast(id * id % 17 as double)" for c in SETTINGS.numeric + SETTINGS.payment_numeric}
    df = spark.range(40).selectExpr(
        *[f"{e} as {c}" for c, e in base.items()],
        "case id % 3 when 0 then 'b' when 1 then 'a' else 'c' end as product_category_name",
        "id % 2 = 0 as free_delivery", "id % 4 = 0 as is_repeat_buyer")
    train, test = preprocessing.split_train_test(df, SETTINGS)
    train = train.where("product_category_name <> 'c'")
    model = preprocessing.fit_preprocessor(train, SETTINGS)
    names = preprocessing.feature_names(model)
    assert names[0] == "num__deli_duration_exp" and names[-3:] == [
        "cat__product_category_name_a", "cat__product_category_name_b", "remainder__free_delivery"]
    out = preprocessing.apply_preprocessor(model, train).select(vector_to_array("features").alias("v"))
    v = np.array([r.v for r in out.collect()])
    assert v.shape[1] == len(names) and v[:, 0].std() == pytest.approx(1.0)
    unseen = preprocessing.apply_preprocessor(model, df.withColumn("product_category_name", F.lit("c")).limit(1)
                                              .withColumn("row_key", F.lit(1)).withColumn("label", F.lit(1.0)))
    assert list(unseen.select(vector_to_array("features").alias("v")).first().v[-3:-1]) == [0.0, 0.0]


def test_bias_report_rounds_half_even_and_handles_none(spark):
    rows = [("a", 1)] * 1 + [("b", 1)] * 7 + [("a", 0)] * 20
    df = spark.createDataFrame(rows, "product_category_name string, is_repeat_buyer int")
    got = weak_labels.bias_report(df, replace(SETTINGS, weak_categories=1)).first()
    assert tuple(got) == (8, 1, 12.5)
    none = weak_labels.bias_report(df.where("is_repeat_buyer = 0"), SETTINGS).first()
    assert tuple(none) == (0, 0, 0.0)


def test_parts_are_read_from_files_and_make_the_key_once(spark):
    n = 400
    df = spark.range(n).selectExpr(
        "cast(id % 7 as double) / 3 as item_price", "id % 5 = 0 as is_repeat_buyer",
        "if(id % 9 = 0, null, 'c' || id % 3) as product_category_name")
    df = df.union(df.limit(50))  # equal rows share a key and are dealt out by number
    train, test = preprocessing.split_train_test(df, SETTINGS)
    for part in (train, test):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "md5" not in plan and "conv(" not in plan
    assert train.unionByName(test).select(df.columns).exceptAll(df).count() == 0
    assert train.count() + test.count() == df.count()
    expected = {r.label: int(r["count"] * 0.2 + 0.5) for r in train.union(test).groupBy("label").count().collect()}
    assert {r.label: r["count"] for r in test.groupBy("label").count().collect()} == expected


def model_rows(spark, n):
    """Rows of a model table, none equal to another."""
    base = {c: f"cast((id * {i + 3}) % {i + 11} as double)" for i, c in enumerate(
        SETTINGS.numeric + SETTINGS.payment_numeric)}
    return spark.range(n).selectExpr(
        *[f"{e} as {c}" for c, e in base.items()], "id as item_number",
        "'c' || id % 3 as product_category_name", "(id * id) % 7 < 3 as is_repeat_buyer")


def test_parts_are_written_once(spark, monkeypatch):
    """With their key; where a cut falls between equal rows, again with their part."""
    written = []
    for module in (preprocessing, split):
        monkeypatch.setattr(
            module, "stored", lambda df, name: written.append(name) or session.stored(df, name))
    df = model_rows(spark, 301)
    copies = df.crossJoin(spark.range(7).select()).select(df.columns)
    for rows, names in ((df, ["keyed"]), (copies, ["keyed", "placed"])):
        written.clear()
        train, test = preprocessing.split_train_test(rows.repartition(3), SETTINGS)
        assert written == names and "md5" not in test._jdf.queryExecution().optimizedPlan().toString()
        keyed = session.stored(preprocessing.keyed(rows, SETTINGS), "whole")
        whole = split.stratified_split(keyed, "label", "row_key").orderBy("row_key", "split")
        got = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        assert got.columns == whole.columns
        assert got.orderBy("row_key", "split").collect() == whole.collect()


def test_rows_are_spread_for_models_that_draw_them(spark, monkeypatch):
    """Linear models only add up over rows, so these are not shuffled for them."""
    def seen(*_):
        raise AssertionError("spread")

    monkeypatch.setattr(training, "spread", seen)
    monkeypatch.setattr(weak_labels, "spread", seen, raising=False)
    df, _, _ = small_frame(spark)
    for penalized in (False, True):
        settings = replace(SMALL, penalize_intercept=penalized)
        found = [training.train_logistic(df.repartition(n), df, ["a", "b", "c"], settings).model.stages[0]
                 for n in (1, 7)]
        assert found[0].coefficients.toArray() == pytest.approx(found[1].coefficients.toArray(), abs=1e-9)
    with pytest.raises(AssertionError, match="spread"):
        training.train_random_forest(df, df, ["a", "b", "c"], SMALL)
    labelled = model_rows(spark, 200).withColumn("is_repeat_buyer", F.col("is_repeat_buyer").cast("int"))
    assert 0 <= weak_labels.retrain(labelled, SMALL).metrics["roc_auc"] <= 1
