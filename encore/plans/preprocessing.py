"""Split, scaling and encoding for the classifiers, as a fitted and storable pipeline."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.ranking import draw_keys
from encore.operators.split import content_key, stratified_split
from encore.plans.settings import DEFAULTS, Settings
from encore.session import stored

KEY = "row_key"
LABEL = "label"
FEATURES = "features"
DRAW = "_draw"
HELPERS = {KEY, LABEL, FEATURES, "split", "fold", "weight"}


def keyed(inputs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add a repeatable number per row (model tables have no id) and the label as a double.

    The number is a hash of the row. Equal rows share it; where that matters (splits, top
    shares), rows with equal numbers are told apart or dealt out by count.
    """
    digest = F.md5(content_key(inputs))
    return inputs.withColumns(
        {
            KEY: F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"),
            LABEL: F.col(settings.target).cast("double"),
        }
    )


def split_train_test(
    inputs: DataFrame, settings: Settings = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Stratified train and test parts of a model table.

    The text of a whole row is by far the dearest column, and filters on it would make it several
    times a row. So rows are written once with their key and its place in the draw; the scans of
    the split, of the preprocessor and of every model read files. A row's part is a comparison
    of the place with a number, so it is not written unless a cut falls between equal places.
    """
    if settings.target not in inputs.columns:
        raise ValueError(f"the table has no target column {settings.target!r}")
    drawn = keyed(inputs, settings).withColumn(DRAW, draw_keys(F.col(KEY), settings.seed)[0])
    placed = stratified_split(
        stored(drawn, "keyed"), LABEL, KEY, settings.test_share, settings.seed,
        settings.stratify, DRAW,
    )
    return (
        placed.where(F.col("split") == "train").drop("split"),
        placed.where(F.col("split") == "test").drop("split"),
    )


def remainder_columns(df: DataFrame, settings: Settings = DEFAULTS) -> list[str]:
    """Columns passed through unchanged, in table order."""
    used = {*settings.numeric, *settings.payment_numeric, *settings.categorical}
    return [c for c in df.columns if c not in used | HELPERS | {settings.target}]


def fit_preprocessor(train: DataFrame, settings: Settings = DEFAULTS) -> PipelineModel:
    """Fit scaling (population deviation) and one-hot encoding on the train part.

    ``StandardScaler`` divides by the sample deviation, so its output is stretched by
    sqrt(n / (n - 1)). Categories take slots in alphabetical order; one not seen in training
    has no slot.
    """
    n = train.count()
    numeric = [*settings.numeric, *settings.payment_numeric]
    stretch = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    indexed = [f"_index_{c}" for c in settings.categorical]
    encoded = [f"_onehot_{c}" for c in settings.categorical]
    stages = [
        VectorAssembler(inputCols=numeric, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_centred", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_centred", outputCol="_scaled",
            scalingVec=Vectors.dense([stretch] * len(numeric)),
        ),
        StringIndexer(
            inputCols=settings.categorical, outputCols=indexed,
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(
            inputCols=["_scaled", *encoded, *remainder_columns(train, settings)],
            outputCol=FEATURES,
        ),
    ]
    return Pipeline(stages=stages).fit(train)


def apply_preprocessor(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the feature vector; working columns are dropped."""
    return model.transform(df).select(*df.columns, FEATURES)


def feature_names(model: PipelineModel) -> list[str]:
    """Names in vector order: num__x, cat__column_value, remainder__x."""
    numeric = model.stages[0].getInputCols()
    indexer = model.stages[3]
    categories = [
        f"cat__{column}_{value}"
        for column, values in zip(indexer.getInputCols(), indexer.labelsArray)
        for value in values
    ]
    rest = model.stages[5].getInputCols()[1 + len(indexer.getInputCols()) :]
    return [f"num__{c}" for c in numeric] + categories + [f"remainder__{c}" for c in rest]


@dataclass
class Prepared:
    """Train and test parts with features, the fitted preprocessor and its feature names."""

    train: DataFrame
    test: DataFrame
    preprocessor: PipelineModel
    names: list[str]


def prepare(inputs: DataFrame, settings: Settings = DEFAULTS) -> Prepared:
    """Split a model table and apply the preprocessor fitted on its train part."""
    train, test = split_train_test(inputs, settings)
    preprocessor = fit_preprocessor(train, settings)
    return Prepared(
        apply_preprocessor(preprocessor, train),
        apply_preprocessor(preprocessor, test),
        preprocessor,
        feature_names(preprocessor),
    )
