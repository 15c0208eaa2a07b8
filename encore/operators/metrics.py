"""Exact ranking and classification metrics from (label, score, prediction) tables.

Every curve comes from one table of thresholds: rows are counted per distinct score, then
totals run down the scores (``running_totals``), so tied scores are one point and no task
sorts all scores. Areas are sums over that table: each point knows the point before it by
taking its own counts off the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.order_stats import running_totals
from encore.operators.ranking import top_share

# Fixed value: guards the F1 formula against 0/0.
F1_EPSILON = 1e-10


def threshold_table(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score: positives/negatives at it and at or above it, plus totals.

    With ``by`` (few non-null groups, as models), scores and totals are those of a group.
    """
    by = list(by)
    positive = F.col(label).cast("int") == 1
    counts = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    whole = [F.sum("pos").alias("p"), F.sum("neg").alias("n")]
    running = running_totals(counts, "threshold", ["pos", "neg"], descending=True, by=by)
    running = running.withColumnsRenamed({"pos_to": "tp", "neg_to": "fp"})
    if by:
        totals = running.groupBy(*by).agg(*whole)
        return running.join(totals, by).select(
            *by, "threshold", "pos", "neg", "tp", "fp", "p", "n"
        )
    totals = counts.agg(F.struct(*whole).alias("totals")).scalar()
    return running.withColumn("totals", totals).select(
        "threshold", "pos", "neg", "tp", "fp", F.col("totals.p").alias("p"),
        F.col("totals.n").alias("n"),
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def pr_curve(thresholds: DataFrame) -> DataFrame:
    """Precision and recall per threshold; the end point (recall 0, precision 1) has none."""
    points = thresholds.select(
        "threshold",
        _rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _rate(F.col("tp"), F.col("p")).alias("recall"),
    )
    end = thresholds.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def _corners(thresholds: DataFrame) -> DataFrame:
    """Thresholds where the direction of the ROC curve changes, and both ends.

    The next threshold's counts are found by a join: its totals without its own counts are the
    totals here.
    """
    following = thresholds.select(
        (F.col("tp") - F.col("pos")).alias("_tp"), (F.col("fp") - F.col("neg")).alias("_fp"),
        F.col("pos").alias("_pos"), F.col("neg").alias("_neg"),
    )
    joined = thresholds.join(
        following, (F.col("tp") == F.col("_tp")) & (F.col("fp") == F.col("_fp")), "left"
    )
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    bend = (F.col("_pos") != F.col("pos")) | (F.col("_neg") != F.col("neg"))
    return joined.where(first | F.col("_pos").isNull() | bend).select(*thresholds.columns)


def roc_curve(thresholds: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """False and true positive rates per threshold; the start (0, 0) has no threshold.

    Points in the middle of a run of equal steps are left out, unless all are asked for.
    """
    if drop_collinear:
        thresholds = _corners(thresholds)
    points = thresholds.select(
        "threshold",
        _rate(F.col("fp"), F.col("n")).alias("fpr"),
        _rate(F.col("tp"), F.col("p")).alias("tpr"),
    )
    start = thresholds.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def _roc_step() -> Column:
    width = F.col("neg") * 1.0 / F.col("n")
    return width * (2 * F.col("tp") - F.col("pos")) / (2.0 * F.col("p"))


def _recall_step() -> Column:
    return F.col("pos") * 1.0 / F.col("p")


def _precision() -> Column:
    return F.col("tp") * 1.0 / (F.col("tp") + F.col("fp"))


def _precision_before() -> Column:
    tp = F.col("tp") - F.col("pos")
    fp = F.col("fp") - F.col("neg")
    return F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(1.0))


def curve_areas(thresholds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (per group): ROC area (ties count half), trapezoid PR area, average precision.

    A metric that needs both classes is null when one is missing.
    """
    usable = (F.col("p") > 0) & (F.col("n") > 0)
    return thresholds.groupBy(*by).agg(
        F.sum(F.when(usable, _roc_step())).alias("roc_auc"),
        F.sum(
            F.when(F.col("p") > 0, _recall_step() * (_precision() + _precision_before()) / 2)
        ).alias("prc_auc"),
        F.sum(F.when(F.col("p") > 0, _recall_step() * _precision())).alias("average_precision"),
    )


def best_f1_threshold(thresholds: DataFrame) -> DataFrame:
    """One row: the threshold with the highest F1, the lowest one on ties."""
    precision = _precision()
    recall = F.col("tp") * 1.0 / F.col("p")
    f1 = 2 * precision * recall / (precision + recall + F.lit(F1_EPSILON))
    best = thresholds.where(F.col("p") > 0).agg(
        F.min(F.struct((-f1).alias("loss"), "threshold")).alias("best")
    )
    return best.select(
        F.col("best.threshold").alias("best_threshold"), (-F.col("best.loss")).alias("best_f1")
    )


def top_share_precision(
    df: DataFrame, label: str, score: str, key: str, share: float = 0.1
) -> DataFrame:
    """One row: mean label among the rows with the highest scores; null if there are none."""
    return top_share(df, score, key, share).agg(
        F.avg(F.col(label).cast("double")).alias("top_10_precision")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long table (class, precision, recall, f1_score, support, accuracy).

    One row per class and one for the plain and the weighted mean; ratios 0/0 are 0.
    """
    actual = F.col(label).cast("int")
    guess = F.col(prediction).cast("int")
    cells = df.agg(
        F.count_if((actual == 1) & (guess == 1)).alias("tp"),
        F.count_if((actual == 0) & (guess == 1)).alias("fp"),
        F.count_if((actual == 1) & (guess == 0)).alias("fn"),
        F.count_if((actual == 0) & (guess == 0)).alias("tn"),
    )

    def scores(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        precision = _rate(hit, hit + wrong)
        recall = _rate(hit, hit + missed)
        f1 = _rate(2 * hit, 2 * hit + wrong + missed)
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            (hit + missed).alias("support"),
        )

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    per_class = cells.select(
        scores("0", tn, fn, fp).alias("c0"),
        scores("1", tp, fp, fn).alias("c1"),
        total.alias("total"),
        _rate(tp + tn, total).alias("accuracy"),
    )

    def mean(name: str, w0: Column, w1: Column) -> Column:
        def mix(field: str) -> Column:
            weighted = F.col(f"c0.{field}") * w0 + F.col(f"c1.{field}") * w1
            return F.coalesce(F.try_divide(weighted, w0 + w1), F.lit(0.0)).alias(field)

        return F.struct(
            F.lit(name).alias("class"),
            mix("precision"),
            mix("recall"),
            mix("f1_score"),
            F.col("total").alias("support"),
        )

    rows = F.array(
        F.col("c0"),
        F.col("c1"),
        mean("macro avg", F.lit(1.0), F.lit(1.0)),
        mean(
            "weighted avg",
            F.col("c0.support").cast("double"),
            F.col("c1.support").cast("double"),
        ),
    )
    return per_class.select("accuracy", F.inline(rows))


def report_long(report: DataFrame) -> DataFrame:
    """(metric, class, score) rows of a classification report, without support and accuracy."""
    return (
        report.select(
            "class", "precision", "recall", F.col("f1_score").alias("f1-score")
        )
        .unpivot(["class"], ["precision", "recall", "f1-score"], "metric", "score")
        .select("metric", "class", "score")
    )


def compare_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """(model, metric, score): positive-class scores and accuracy of several models."""
    parts = []
    for model, report in reports.items():
        positive = report.where(F.col("class").isin("1", "True"))
        parts.append(
            positive.select(
                F.lit(model).alias("model"),
                F.inline(
                    F.array(
                        *[
                            F.struct(F.lit(name).alias("metric"), F.col(c).alias("score"))
                            for name, c in [
                                ("precision", "precision"),
                                ("recall", "recall"),
                                ("f1-score", "f1_score"),
                                ("accuracy", "accuracy"),
                            ]
                        ]
                    )
                ),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
