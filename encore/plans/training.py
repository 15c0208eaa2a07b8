"""Training, scoring and evaluating the classifiers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.metrics import (
    classification_report,
    curve_areas,
    threshold_table,
)
from encore.operators.ranking import top_share
from encore.operators.ridge import RidgeLogistic
from encore.operators.split import MAX_LABELS
from encore.plans.preprocessing import FEATURES, KEY, LABEL
from encore.plans.settings import DEFAULTS, Settings
from encore.session import ensure_checkpoint_folder

WEIGHT = "weight"
REPORT_COLUMNS = "class string, precision double, recall double, f1_score double, support bigint"


@dataclass
class Trained:
    """A fitted model with its evaluation. Frames are lazy; metrics are plain numbers."""

    model: PipelineModel | None
    metrics: dict
    predictions: DataFrame
    top: DataFrame
    thresholds: DataFrame | None = None
    importance: dict[str, float] = field(default_factory=dict)
    cached: DataFrame | None = None

    def release(self) -> None:
        """Free the scored rows; the frames can still be used and are computed again."""
        if self.cached is not None:
            self.cached.unpersist()


def class_weights(df: DataFrame, weighting: str | float | None) -> dict[float, float]:
    """Weight per class: balanced (n / (2 * class size)), a number for positives, or none."""
    if weighting is None:
        return {0.0: 1.0, 1.0: 1.0}
    if weighting == "balanced":
        return balanced(class_sizes(df))
    return {0.0: 1.0, 1.0: float(weighting)}


def class_sizes(df: DataFrame) -> dict[float, int]:
    found = df.groupBy(LABEL).count().limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"a label has at most {MAX_LABELS} values")
    return {r[LABEL]: r["count"] for r in found}


def balanced(sizes: dict[float, int]) -> dict[float, float]:
    total = sum(sizes.values())
    return {c: total / (len(sizes) * size) for c, size in sizes.items()}


def with_weights(df: DataFrame, weights: dict[float, float]) -> DataFrame:
    weight = F.coalesce(
        *[F.when(F.col(LABEL) == c, F.lit(w)) for c, w in weights.items()], F.lit(1.0)
    )
    return df.withColumn(WEIGHT, weight)


def logistic_penalty(c: float, weight_sum: float) -> float:
    """Spark's per-row penalty for an inverse strength ``c`` over the sum of losses."""
    return 1.0 / (c * weight_sum)


def logistic(
    c: float, iterations: int, weight_sum: float, penalize_intercept: bool = False,
    tolerance: float = DEFAULTS.logistic_tolerance,
) -> Estimator:
    """Minimizes the weighted log loss plus |coefficients|^2 / (2 c).

    Spark's solver never penalizes the intercept (and gives a constant feature no weight), so
    that option fits by the Newton steps of the grid search.
    """
    if penalize_intercept:
        return RidgeLogistic(
            featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=iterations,
            penalty=1.0 / c,
        )
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=iterations,
        regParam=logistic_penalty(c, weight_sum), elasticNetParam=0.0, standardization=False,
        tol=tolerance,
    )


def random_forest(settings: Settings = DEFAULTS) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=settings.trees,
        maxDepth=settings.tree_depth, seed=settings.seed,
    )


def boosted_trees(seed: int, rounds: int, rate: float, depth: int, **options) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=rounds, stepSize=rate,
        maxDepth=depth, seed=seed, **options,
    )


def score(model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Add y_true, y_proba and y_pred (by the model, or by a threshold on the probability)."""
    scored = model.transform(df).withColumn(
        "y_proba", vector_to_array(F.col("probability"))[1]
    )
    guess = (
        F.col("prediction") if threshold is None else F.col("y_proba") >= F.lit(threshold)
    )
    return scored.select(
        *[c for c in df.columns if c not in (LABEL, WEIGHT)],
        F.col(LABEL).cast("int").alias("y_true"),
        guess.cast("int").alias("y_pred"),
        "y_proba",
    )


def evaluate(
    predictions: DataFrame, thresholds: DataFrame, top: DataFrame
) -> dict:
    """All metrics of a table with y_true, y_pred and y_proba.

    Only single numbers reach the driver. The curves (``thresholds``) can be as long as the
    table, so they stay a DataFrame.
    """
    areas = curve_areas(thresholds).first()
    if areas["roc_auc"] is None and predictions.isEmpty():
        raise ValueError("there are no predictions to evaluate")
    report = classification_report(predictions, "y_true", "y_pred").collect()
    return {
        "roc_auc": areas["roc_auc"],
        "prc_auc": areas["prc_auc"],
        "average_precision": areas["average_precision"],
        "top_10_precision": top.agg(F.avg("y_true")).first()[0],
        "accuracy": report[0]["accuracy"],
        "classification_report": [
            {k: r[k] for k in ("class", "precision", "recall", "f1_score", "support")}
            for r in report
        ],
    }


def metrics_frame(like: DataFrame, trained: Trained) -> DataFrame:
    """Metrics as one row, for the JSON report."""
    spark = like.sparkSession
    m = trained.metrics
    if m.get("skipped"):
        return spark.createDataFrame([(True,)], "skipped boolean")
    plain = {k: v for k, v in m.items() if k not in ("classification_report", "best_params")}
    schema = ", ".join(f"{k} double" for k in plain)
    values = tuple(None if v is None else float(v) for v in plain.values())
    schema += f", classification_report array<struct<{_struct(REPORT_COLUMNS)}>>"
    rows = [tuple(r.values()) for r in m["classification_report"]]
    schema += ", feature_importance map<string,double>, best_params map<string,string>"
    best = {k: str(v) for k, v in m.get("best_params", {}).items()}
    return spark.createDataFrame([(*values, rows, trained.importance, best)], schema)


def _struct(columns: str) -> str:
    return ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in columns.split(", "))


def importances(model, names: list[str]) -> dict[str, float]:
    """Score per feature, highest first: tree importances or absolute coefficients."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients.toArray())
    ranked = sorted(zip(names, values), key=lambda pair: (-pair[1], pair[0]))
    return {name: float(value) for name, value in ranked}


def spread(train: DataFrame, partitions: int) -> DataFrame:
    """Training rows in a fixed number of partitions, placed and ordered by their key.

    Trees draw their samples per partition. With the same seed and number of partitions a model
    does not depend on the files or cores that the rows come from.
    """
    return train.repartition(partitions, KEY).sortWithinPartitions(KEY)


#: Estimators that only add up over the rows: how these lie does not matter to them.
SUMMING = (LogisticRegression, RidgeLogistic)


def train_classifier(
    train: DataFrame,
    test: DataFrame,
    build: Callable[[float], Estimator],
    names: list[str],
    weighting: str | float | None = "balanced",
    skip: bool = False,
    with_importance: bool = True,
    share: float = 0.1,
    partitions: int = DEFAULTS.train_partitions,
) -> Trained:
    """Fit on train, score and evaluate on test.

    ``build`` gets the sum of the row weights and returns an estimator. Rows are spread for it
    unless it only adds up over them. A skipped model has empty frames and says so in its
    metrics.
    """
    if skip:
        return skipped(test)
    ensure_checkpoint_folder(train.sparkSession)
    weights = class_weights(train, weighting)
    total = with_weights(train.select(LABEL), weights).agg(F.sum(WEIGHT)).first()[0]
    estimator = build(total)
    lying = train if isinstance(estimator, SUMMING) else spread(train, partitions)
    rows = lying.select(FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.fit(with_weights(rows, weights))
    finally:
        rows.unpersist()
    predictions = score(model, test).persist(StorageLevel.MEMORY_AND_DISK)
    thresholds = threshold_table(predictions, "y_true", "y_proba")
    top = top_share(predictions, "y_proba", KEY, share)
    return Trained(
        PipelineModel(stages=[model]), evaluate(predictions, thresholds, top), predictions,
        top, thresholds,
        importances(model, names) if with_importance else {},
        predictions,
    )


def skipped(test: DataFrame) -> Trained:
    """Empty tables with the columns of a trained model, and metrics that say so."""
    kept = [c for c in test.columns if c not in (LABEL, WEIGHT)]
    nothing = test.limit(0).select(
        *kept, F.lit(0).alias("y_true"), F.lit(0).alias("y_pred"), F.lit(0.0).alias("y_proba")
    )
    counts = ("pos", "neg", "tp", "fp", "p", "n")
    thresholds = nothing.select(
        F.col("y_proba").alias("threshold"), *[F.lit(0).cast("long").alias(c) for c in counts]
    )
    return Trained(None, {"skipped": True}, nothing, nothing, thresholds)


def train_random_forest(train, test, names, settings: Settings = DEFAULTS) -> Trained:
    return train_classifier(
        train, test, lambda _: random_forest(settings), names,
        partitions=settings.train_partitions, skip="random_forest" in settings.skip,
    )


def train_logistic(train, test, names, settings: Settings = DEFAULTS) -> Trained:
    return train_classifier(
        train, test,
        lambda total: logistic(
            settings.logistic_c, settings.logistic_iterations, total,
            settings.penalize_intercept, settings.logistic_tolerance,
        ),
        names, partitions=settings.train_partitions, skip="logistic" in settings.skip,
    )


def train_boosted_a(train, test, names, settings: Settings = DEFAULTS) -> Trained:
    """Boosted trees with at least 20 rows per leaf."""
    return train_classifier(
        train, test,
        lambda _: boosted_trees(
            settings.seed, settings.boosted_a_rounds, settings.boosted_a_rate,
            settings.boosted_a_depth, minInstancesPerNode=20,
        ),
        names, partitions=settings.train_partitions,
        weighting=settings.positive_weight, skip="boosted_a" in settings.skip,
    )


def train_boosted_b(train, test, names, settings: Settings = DEFAULTS) -> Trained:
    """Boosted trees with fine split candidates."""
    return train_classifier(
        train, test,
        lambda _: boosted_trees(
            settings.seed, settings.boosted_b_rounds, settings.boosted_b_rate,
            settings.boosted_b_depth, maxBins=256,
        ),
        names, partitions=settings.train_partitions,
        weighting=settings.positive_weight, skip="boosted_b" in settings.skip,
    )


TRAINERS = {
    "random_forest": train_random_forest,
    "logistic": train_logistic,
    "boosted_a": train_boosted_a,
    "boosted_b": train_boosted_b,
}
