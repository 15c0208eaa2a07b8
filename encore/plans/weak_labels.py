"""Weak labels: rules, pseudo labels from a model, retraining, and a bias report."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.caps import at_least_quantile
from encore.operators.filters import true_only
from encore.operators.ranking import in_top_values
from encore.plans.preprocessing import (
    FEATURES,
    LABEL,
    apply_preprocessor,
    feature_names,
    fit_preprocessor,
    split_train_test,
)
from encore.plans.settings import DEFAULTS, Settings
from encore.plans.training import Trained, class_weights, logistic, with_weights
from encore.plans.tuning import at_best_threshold


def weak_positive_mask(inputs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``weak_positive``: any of five signs that a buyer may come back."""
    signs = (
        true_only(F.col("review_score") > settings.weak_score_above)
        | true_only(F.col("deli_duration_exp") <= settings.weak_days_at_most)
        | true_only(F.col("voucher") >= settings.weak_voucher_share)
        | at_least_quantile(inputs, "total_spent", settings.weak_spent_quantile)
        | F.col("_popular")
    )
    tagged = in_top_values(inputs, "product_category_name", settings.weak_categories, "_popular")
    return tagged.withColumn("weak_positive", signs).select(*inputs.columns, "weak_positive")


def pseudo_labels(
    masked: DataFrame, preprocessor: PipelineModel, model: PipelineModel,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Replace the target by 1 where the model is confident or a weak sign holds, else 0.

    Rows are scored through the fitted preprocessor, so the model sees the features it was
    trained on.
    """
    scored = model.transform(apply_preprocessor(preprocessor, masked))
    confident = vector_to_array(F.col("probability"))[1] > settings.confident
    return scored.withColumn(
        settings.target, (confident | F.col("weak_positive")).cast("int")
    ).select(*[c for c in masked.columns if c != "weak_positive"])


def retrain(labelled: DataFrame, settings: Settings = DEFAULTS) -> Trained:
    """Split, preprocess and fit a balanced logistic model on pseudo labels."""
    train, test = split_train_test(labelled, settings)
    preprocessor = fit_preprocessor(train, settings)
    prepared = apply_preprocessor(preprocessor, train).select(FEATURES, LABEL)
    weighted = with_weights(prepared, class_weights(train, "balanced")).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        total = weighted.agg(F.sum("weight")).first()[0]
        model = logistic(
            1.0, settings.retrain_iterations, total, settings.penalize_intercept,
            settings.logistic_tolerance,
        ).fit(weighted)
    finally:
        weighted.unpersist()
    trained = at_best_threshold(
        model, apply_preprocessor(preprocessor, test), feature_names(preprocessor), settings
    )
    trained.model = PipelineModel(stages=[preprocessor, model])
    return trained


def bias_report(labelled: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: positives, those in the most frequent categories, and their percentage.

    The percentage is rounded half to even, and 0 without positives.
    """
    tagged = in_top_values(labelled, "product_category_name", settings.weak_categories, "_popular")
    positive = F.col(settings.target).cast("int") == 1
    counts = tagged.agg(
        F.count_if(positive).alias("total_pseudo_positives"),
        F.count_if(positive & F.col("_popular")).alias("positives_from_top_categories"),
    )
    share = F.try_divide(
        F.col("positives_from_top_categories").cast("double"), F.col("total_pseudo_positives")
    )
    return counts.withColumn(
        "percentage_top_category", F.coalesce(F.bround(share * 100, 2), F.lit(0.0))
    )
