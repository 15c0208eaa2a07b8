"""Grid search for the logistic model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.metrics import best_f1_threshold, curve_areas, threshold_table
from encore.operators.newton import Problem, fit_together, held_out_scores
from encore.operators.ranking import top_share
from encore.operators.split import assign_folds
from encore.plans.preprocessing import FEATURES, KEY, LABEL
from encore.plans.settings import DEFAULTS, Settings
from encore.plans.training import (
    Trained,
    balanced,
    class_sizes,
    evaluate,
    importances,
    logistic,
    score,
    spread,
    with_weights,
)


@dataclass(frozen=True)
class Candidate:
    c: float
    iterations: int
    weighting: str | None


def _fit(
    part: DataFrame, candidate: Candidate, sizes: dict[float, int], settings: Settings
) -> Model:
    """Fit on rows of known class sizes, so that weights cost no job."""
    weights = dict.fromkeys(sizes, 1.0)
    if candidate.weighting == "balanced":
        weights = balanced(sizes)
    total = sum(weights[c] * size for c, size in sizes.items())
    return logistic(
        candidate.c, candidate.iterations, total, settings.penalize_intercept,
        settings.logistic_tolerance,
    ).fit(with_weights(part, weights))


def grid_search(
    train: DataFrame, settings: Settings = DEFAULTS
) -> list[tuple[Candidate, float]]:
    """Mean average precision over the folds per setting, best first (ties: grid order).

    All settings and folds are fitted together by Newton steps (``fit_together``) and scored in
    one scan. A limit that is not reached does not bind, so limits share their steps.
    """
    folded = assign_folds(train, LABEL, KEY, settings.folds, settings.seed)
    folded = spread(folded, settings.train_partitions)
    folded = folded.select(
        vector_to_array(FEATURES).alias(FEATURES), LABEL, F.col("fold").cast("int").alias("fold")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _grid_scores(folded, settings)
    finally:
        folded.unpersist()


def _grid_scores(folded: DataFrame, settings: Settings) -> list[tuple[Candidate, float]]:
    counted = folded.groupBy("fold", LABEL).agg(
        F.count("*").alias("n"), F.max(F.size(FEATURES)).alias("width")
    ).collect()  # labels were counted by the folds
    sizes: dict[int, dict[float, int]] = {fold: {} for fold in range(settings.folds)}
    for row in counted:
        for fold in sizes:
            if fold != row["fold"]:
                sizes[fold][row[LABEL]] = sizes[fold].get(row[LABEL], 0) + row["n"]
    width = max((row["width"] for row in counted), default=0)
    problems = {}
    for c in settings.grid_c:
        for weighting in settings.grid_weights:
            for fold, own in sizes.items():
                weights = balanced(own) if weighting == "balanced" else {}
                problems[c, weighting, fold] = Problem(
                    1.0 / c, (weights.get(0.0, 1.0), weights.get(1.0, 1.0)), fold,
                    settings.penalize_intercept,
                )
    fits = dict(
        zip(problems, fit_together(
            folded, list(problems.values()), width, sizes, max(settings.grid_iterations)
        ))
    )
    # Limits that end at the same point are one model.
    numbers: dict[tuple, int] = {}
    models: dict[int, list] = {fold: [] for fold in sizes}
    used: dict[Candidate, list[int]] = {}
    for c in settings.grid_c:
        for weighting in settings.grid_weights:
            for limit in settings.grid_iterations:
                for fold in sizes:
                    fit = fits[c, weighting, fold]
                    steps = min(limit, len(fit.path) - 1)
                    key = (c, weighting, fold, steps)
                    if key not in numbers:
                        numbers[key] = len(numbers)
                        models[fold].append((numbers[key], fit.after(steps)))
                    used.setdefault(Candidate(c, limit, weighting), []).append(numbers[key])
    scored = held_out_scores(folded, models, width)
    areas = curve_areas(threshold_table(scored, LABEL, "score", ["problem"]), ["problem"])
    score_of = {r["problem"]: r["average_precision"] for r in areas.collect()}
    means = {
        g: sum(score_of.get(i) or 0.0 for i in found) / settings.folds
        for g, found in used.items()
    }
    grid = list(used)
    return sorted(means.items(), key=lambda item: (-item[1], grid.index(item[0])))


def at_best_threshold(
    model, test: DataFrame, names: list[str], settings: Settings = DEFAULTS
) -> Trained:
    """Score a test part and decide by the threshold with the best F1."""
    scored = score(model, test).persist(StorageLevel.MEMORY_AND_DISK)
    thresholds = threshold_table(scored, "y_true", "y_proba")
    threshold = best_f1_threshold(thresholds).first()["best_threshold"]
    predictions = scored.withColumn(
        "y_pred", (F.col("y_proba") >= F.lit(threshold)).cast("int")
    )
    top = top_share(predictions, "y_proba", KEY, settings.top_share)
    metrics = evaluate(predictions, thresholds, top)
    metrics["best_threshold"] = threshold
    return Trained(
        PipelineModel(stages=[model]), metrics, predictions, top, thresholds,
        importances(model, names), scored,
    )


def tune_logistic(
    train: DataFrame, test: DataFrame, names: list[str], settings: Settings = DEFAULTS
) -> Trained:
    """Search the grid, fit the best setting on the whole train part, decide by best F1."""
    ranking = grid_search(train, settings)
    best, best_score = ranking[0]
    rows = spread(train, settings.train_partitions).select(FEATURES, LABEL)
    model = _fit(rows, best, class_sizes(rows), settings)
    tuned = at_best_threshold(model, test, names, settings)
    tuned.metrics["best_params"] = {
        "C": best.c, "max_iter": best.iterations, "class_weight": best.weighting,
        "average_precision": best_score,
    }
    return tuned
