"""Queries over splits, scaling, metrics and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import SETTINGS, Fixture
from checks.tables import register
from encore.operators import metrics, ridge, scaling, split
from encore.plans import preprocessing, stages, training, tuning, weak_labels
from encore.session import scratch_folder
from encore.sources.catalog import Catalog

# ------------------------------------------------------------------------- splits and scaling

DRAW = "md5(concat(cast(order_id as varchar), '|42'))"
register(
    "stratified_split",
    lambda f: split.stratified_split(
        f.stored("labels").select("order_id", "is_repeat_buyer"), "is_repeat_buyer", "order_id"
    ),
    f"select order_id, is_repeat_buyer, case when row_number() over (partition by is_repeat_buyer "
    f"order by {DRAW}) <= round(count(*) over (partition by is_repeat_buyer) * 0.2) "
    "then 'test' else 'train' end as split from tw_labels",
)
register(
    "stratified_folds",
    lambda f: split.assign_folds(
        f.stored("labels").select("order_id", "is_repeat_buyer"), "is_repeat_buyer", "order_id"
    ),
    "select order_id, is_repeat_buyer, cast(case when rn <= n // 5 then 0 when rn <= 2 * n // 5 "
    "then 1 when rn <= 3 * n // 5 then 2 when rn <= 4 * n // 5 then 3 else 4 end as integer) "
    "as fold from (select *, "
    f"row_number() over (partition by is_repeat_buyer order by {DRAW}) as rn, "
    "count(*) over (partition by is_repeat_buyer) as n from tw_labels)",
)
register(
    "standard_scale",
    lambda f: scaling.standard_scale(
        f.products.select("product_id", "product_length_cm", "product_height_cm", "product_width_cm"),
        ["product_length_cm", "product_height_cm", "product_width_cm"],
    ),
    "select product_id, " + ", ".join(
        f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}"
        for c in ["product_length_cm", "product_height_cm", "product_width_cm"]
    ) + " from fx_products",
    "product_length_cm product_height_cm product_width_cm",
)
register(
    "one_hot",
    lambda f: scaling.one_hot_long(
        f.products, "product_id", "product_category_name",
        f.products.where(F.col("product_category_name") != "PROMO_0"),
    ).withColumn("slot", F.col("slot").cast("bigint")),
    "select product_id, slot from fx_products left join (select product_category_name, "
    "row_number() over (order by product_category_name) - 1 as slot from (select distinct "
    "product_category_name from fx_products where product_category_name <> 'PROMO_0')) "
    "using (product_category_name)",
)
register(
    "passthrough_rest",
    lambda f: f.stored("transactions").select(
        "order_id", "product_id",
        *[F.col(c).cast("double").alias(c)
          for c in ["free_delivery", "is_bulk", "discount", "high_price"]],
    ),
    "select order_id, product_id, " + ", ".join(
        f"cast({c} as double) as {c}" for c in ["free_delivery", "is_bulk", "discount", "high_price"]
    ) + " from tw_transactions",
    "free_delivery is_bulk discount high_price",
)
register(
    "align_columns",
    lambda f: scaling.align_columns(
        f.products, ["product_id", "cat_LARGE", "cat_SMALL", "unknown_column"],
        {"cat_LARGE": ("product_category_name", "LARGE"),
         "cat_SMALL": ("product_category_name", "SMALL")},
    ),
    "select product_id, coalesce(cast(product_category_name = 'LARGE' as integer), 0) as \"cat_LARGE\", "
    "coalesce(cast(product_category_name = 'SMALL' as integer), 0) as \"cat_SMALL\", "
    "0 as unknown_column from fx_products",
)

# ------------------------------------------------------------------------------------- metrics


def _thresholds(f: Fixture) -> DataFrame:
    return metrics.threshold_table(f.scores, "label", "score")


AREAS = (
    "sum((fpr_ - fpr_before) * (2 * tp - pos) / (2.0e0 * p)) as roc_auc, "
    "sum((recall_ - recall_before) * (precision_ + precision_before) / 2) as prc_auc, "
    "sum((recall_ - recall_before) * precision_) as average_precision"
)
register("eval_roc_auc", lambda f: metrics.curve_areas(_thresholds(f)).select("roc_auc"),
         f"select roc_auc from (select {AREAS} from tw_rates)", "roc_auc")
register("eval_prc_auc", lambda f: metrics.curve_areas(_thresholds(f)).select("prc_auc"),
         f"select prc_auc from (select {AREAS} from tw_rates)", "prc_auc")
register(
    "eval_average_precision",
    lambda f: metrics.curve_areas(_thresholds(f)).select("average_precision"),
    f"select average_precision from (select {AREAS} from tw_rates)", "average_precision",
)
register(
    "curve_pr", lambda f: metrics.pr_curve(_thresholds(f)),
    "select threshold, precision_ as precision, recall_ as recall from tw_rates "
    "union all select null, 1.0e0, 0.0e0", "threshold precision recall",
)
register(
    "curve_roc", lambda f: metrics.roc_curve(_thresholds(f)),
    "select threshold, fpr, tpr from (select threshold, fpr_ as fpr, tp * 1.0e0 / p as tpr, "
    "tp - lag(tp, 1, 0) over w as up, fp - lag(fp, 1, 0) over w as right_, "
    "lead(tp) over w - tp as next_up, lead(fp) over w - fp as next_right, row_number() over w as r "
    "from tw_rates window w as (order by threshold desc)) "
    "where r = 1 or next_up is null or up <> next_up or right_ <> next_right "
    "union all select null, 0.0e0, 0.0e0", "threshold fpr tpr",
)
register(
    "top_decile_precision",
    lambda f: metrics.top_share_precision(f.scores, "label", "score", "row_id"),
    "select avg(label) as top_10_precision from (select label from fx_scores "
    "order by score desc, row_id limit (select cast(floor(count(*) * 0.1) as bigint) from fx_scores))",
    "top_10_precision",
)
register(
    "f1_threshold", lambda f: metrics.best_f1_threshold(_thresholds(f)),
    "select threshold as best_threshold, 2 * precision_ * recall_ / (precision_ + recall_ + 1e-10) "
    "as best_f1 from tw_rates order by best_f1 desc, threshold limit 1", "best_threshold best_f1",
)
REPORT_DOUBLES = "accuracy precision recall f1_score"
register(
    "classification_report",
    lambda f: metrics.classification_report(f.scores, "label", "prediction"),
    "select * from tw_report", REPORT_DOUBLES,
)
LONG = (
    "select 'precision' as metric, class, precision as score from tw_report union all "
    "select 'recall', class, recall from tw_report union all "
    "select 'f1-score', class, f1_score from tw_report"
)
register(
    "report_long",
    lambda f: metrics.report_long(metrics.classification_report(f.scores, "label", "prediction")),
    LONG, "score",
)
register(
    "report_compare",
    lambda f: metrics.compare_reports(
        {
            "by_value": metrics.classification_report(f.scores, "label", "prediction"),
            "all_positive": metrics.classification_report(
                f.scores.withColumn("prediction", F.lit(1)), "label", "prediction"
            ),
        }
    ),
    "select 'by_value' as model, metric, score from "
    f"({LONG} union all select 'accuracy', class, accuracy from tw_report) where class = '1' "
    "union all select 'all_positive', unnest(['precision', 'recall', 'f1-score', 'accuracy']), "
    "unnest([p, 1.0e0, 2 * p / (p + 1), p]) from (select avg(label) as p from fx_scores)", "score",
)


def _metrics_json(f: Fixture) -> DataFrame:
    """Areas of all rows, and of the positives alone, which have no ROC area."""
    catalog = Catalog(f.spark, scratch_folder(f.spark, "metrics"))
    alone = metrics.threshold_table(f.scores.where("label = 1"), "label", "score")
    both = metrics.curve_areas(_thresholds(f)).withColumn("rows", F.lit("all")).unionByName(
        metrics.curve_areas(alone).withColumn("rows", F.lit("positives"))
    )
    return catalog.save(both, "logistic_metrics")


JSON_SQL = (
    f"select 'all' as rows, {AREAS} from tw_rates union all select 'positives', null, 1.0e0, 1.0e0"
)
register(
    "sink_json", _metrics_json, JSON_SQL, "roc_auc prc_auc average_precision",
)
register(
    "scan_json_metrics",
    lambda f: _metrics_json(f).unpivot(
        ["rows"], ["roc_auc", "prc_auc", "average_precision"], "metric", "value"
    ),
    f"with j as ({JSON_SQL}) select rows, 'roc_auc' as metric, roc_auc as value from j union all "
    "select rows, 'prc_auc', prc_auc from j union all "
    "select rows, 'average_precision', average_precision from j", "value",
)

# ----------------------------------------------------------------------------------- weak labels

register(
    "weak_positive_mask",
    lambda f: weak_labels.weak_positive_mask(f.model_table, SETTINGS).select(
        "item_price", "total_spent", "review_score", "product_category_name", "weak_positive"
    ),
    "select item_price, total_spent, review_score, product_category_name, weak_positive "
    "from tw_weak", "item_price total_spent",
)
BIAS = (
    "select count(*) as total_pseudo_positives, count(*) filter (product_category_name in "
    "(select product_category_name from tw_model_inputs group by 1 order by count(*) desc, "
    "product_category_name limit 10)) as positives_from_top_categories from tw_weak "
    "where weak_positive"
)


def _bias(f: Fixture) -> DataFrame:
    masked = weak_labels.weak_positive_mask(f.model_table, SETTINGS)
    labelled = masked.withColumn("is_repeat_buyer", F.col("weak_positive").cast("int"))
    return weak_labels.bias_report(labelled, SETTINGS)


BIAS_SQL = (
    "select *, round_even(positives_from_top_categories * 100.0e0 / total_pseudo_positives, 2) "
    f"as percentage_top_category from ({BIAS})"
)
register("agg_bias_report", _bias, BIAS_SQL, "percentage_top_category")


def _report_csv(f: Fixture) -> DataFrame:
    catalog = Catalog(f.spark, scratch_folder(f.spark, "reports"))
    catalog.save(_bias(f), "ssl_bias_report")
    return catalog.load("ssl_bias_report")


register(
    "sink_csv_report", _report_csv, BIAS_SQL, "percentage_top_category",
)

# --------------------------------------------------------------------------------------- models


def _prepared(f: Fixture) -> preprocessing.Prepared:
    return preprocessing.prepare(f.model_table, SETTINGS)


def _scored(trained: training.Trained) -> DataFrame:
    return trained.predictions.select("row_key", "y_true", "y_pred", "y_proba")


def _train(name: str):
    def query(f: Fixture) -> DataFrame:
        p = _prepared(f)
        trained = training.TRAINERS[name](p.train, p.test, p.names, SETTINGS)
        return training.metrics_frame(p.test, trained).drop("feature_importance", "best_params")

    return query


def _vectors(df: DataFrame) -> DataFrame:
    array = vector_to_array(F.col("features"))
    return df.select(
        "row_key", "label", F.size(array).alias("n_features"),
        F.aggregate(array, F.lit(0.0), lambda a, x: a + x).alias("feature_sum"),
    )


#: Columns of the model table, the fractions with a dot after them.
MODEL_TABLE = (
    "deli_duration_exp deli_duration_paid deli_cost. free_delivery is_bulk discount item_price. "
    "high_price credit_card. voucher. debit_card. boleto. total_spent. installment distance_km. "
    "high_density_customer_area seller_repeat_buyer_rate. review_score product_category_name "
    "product_name_length product_description_length product_photos_qty product_weight_g. "
    "product_length_cm. product_height_cm. product_width_cm. is_repeat_buyer"
).split()
NUMERIC = [*SETTINGS.numeric, *SETTINGS.payment_numeric]
REST = ["free_delivery", "is_bulk", "discount", "high_price"]


def _key_text(column: str) -> str:
    name = column.rstrip(".")
    text = f"cast(round({name} * 1000000) as decimal(38,0))" if name != column else name
    return f"coalesce(cast({text} as varchar), '\\N')"


#: Rows of the model table with key, part and, for numeric columns, the moments of the train part.
PREPARED = (
    "with keyed as (select *, cast('0x' || substr(md5(concat_ws(chr(31), "
    + ", ".join(map(_key_text, MODEL_TABLE))
    + ")), 1, 15) as bigint) as row_key from tw_model_inputs), "
    "parts as (select *, row_number() over (partition by is_repeat_buyer order by "
    "md5(concat(cast(row_key as varchar), '|42'))) <= "
    "round(count(*) over (partition by is_repeat_buyer) * 0.2) as test from keyed), "
    "moments as (select "
    + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in NUMERIC)
    + " from parts where not test), "
    "categories as (select distinct product_category_name as category from parts where not test)"
)
VECTOR_SUM = " + ".join(
    [f"coalesce(({c} - m_{c}) / nullif(s_{c}, 0), 0)" for c in NUMERIC]
    + ["cast(category is not null as integer)"]
    + [f"cast({c} as integer)" for c in REST]
)


def _vectors_sql(part: str) -> str:
    return (
        f"{PREPARED} select row_key, cast(is_repeat_buyer as double) as label, "
        f"cast({len(NUMERIC) + len(REST)} + (select count(*) from categories) as integer) "
        f"as n_features, {VECTOR_SUM} as feature_sum from moments, parts "
        f"left join categories on product_category_name = category where {part}"
    )


NAMES_SQL = (
    f"{PREPARED}, names as (select 0 as block, row_number() over () as place, name from (select "
    f"unnest([{', '.join(repr(f'num__{c}') for c in NUMERIC)}]) as name) "
    "union all select 1, row_number() over (order by category), "
    "'cat__product_category_name_' || category from categories "
    "union all select 2, row_number() over (), name from (select "
    f"unnest([{', '.join(repr(f'remainder__{c}') for c in REST)}]) as name)) "
    "select cast(row_number() over (order by block, place) - 1 as integer) as position, name "
    "from names"
)


def _importance(f: Fixture) -> DataFrame:
    p = _prepared(f)
    trained = training.train_logistic(p.train, p.test, p.names, SETTINGS)
    return f.spark.createDataFrame(list(trained.importance.items()), "feature string, importance double")


def _saved_model(f: Fixture) -> DataFrame:
    p = _prepared(f)
    catalog = Catalog(f.spark, scratch_folder(f.spark, "models"))
    catalog.save_model(p.preprocessor, "preprocessor")
    loaded: PipelineModel = catalog.load_model("preprocessor")
    _, test = preprocessing.split_train_test(f.model_table, SETTINGS)
    return _vectors(preprocessing.apply_preprocessor(loaded, test))


def _generic(f: Fixture) -> DataFrame:
    """The generic job with a caller's estimator: unweighted, strongly regularized."""
    p = _prepared(f)
    trained = training.train_classifier(
        p.train, p.test, lambda total: training.logistic(0.01, 50, total), p.names,
        weighting=None, with_importance=False,
    )
    return training.metrics_frame(p.test, trained).drop("feature_importance", "best_params")


def _grid(f: Fixture) -> DataFrame:
    p = _prepared(f)
    found = tuning.grid_search(p.train, SETTINGS)
    return f.spark.createDataFrame(
        [(c.c, c.iterations, c.weighting, s) for c, s in found],
        "c double, max_iter int, class_weight string, average_precision double",
    )


def _pseudo(f: Fixture) -> DataFrame:
    p = _prepared(f)
    trained = training.train_logistic(p.train, p.test, p.names, SETTINGS)
    masked = weak_labels.weak_positive_mask(f.model_table, SETTINGS)
    return weak_labels.pseudo_labels(masked, p.preprocessor, trained.model, SETTINGS)


def _retrained(f: Fixture) -> DataFrame:
    trained = weak_labels.retrain(f.stored("pseudo_labelled"), SETTINGS)
    return training.metrics_frame(f.model_table, trained).drop("feature_importance", "best_params")


Fixture.pseudo_labelled = property(_pseudo)

register("fit_transform_train", lambda f: _vectors(_prepared(f).train),
         _vectors_sql("not test"), "feature_sum")
register("transform_test", lambda f: _vectors(_prepared(f).test), _vectors_sql("test"),
         "feature_sum")
register(
    "feature_names",
    lambda f: f.spark.createDataFrame(list(enumerate(_prepared(f).names)), "position int, name string"),
    f"select * from ({NAMES_SQL})",
)
register("model_save_load", _saved_model, _vectors_sql("test"), "feature_sum")
register("train_generic", _generic)
for _name in training.TRAINERS:
    register(f"train_{_name}", _train(_name))
register(
    "predictions_table",
    lambda f: (lambda p: _scored(training.train_logistic(p.train, p.test, p.names, SETTINGS)))(_prepared(f)),
)
register("feature_importance", _importance)
register("sort_importances", lambda f: _importance(f).orderBy(F.desc("importance"), "feature"))
register("grid_search_cv", _grid)
register("pseudo_label", lambda f: _pseudo(f).select("item_price", "review_score", "is_repeat_buyer"))
register("retrain_on_pseudo", _retrained)


#: Features of the model that SQL fits, too: balanced classes, penalty 1, intercept penalized.
FEW = ["review_score", "distance_km"]
STEPS = 12


def _ridge(f: Fixture) -> DataFrame:
    """Test rows scored by a logistic model of two features with a penalized intercept."""
    p = _prepared(f)
    slicer = VectorSlicer(
        inputCol="features", outputCol="few", indices=[p.names.index(f"num__{c}") for c in FEW]
    )
    train = slicer.transform(p.train)
    train = training.with_weights(train, training.class_weights(train, "balanced"))
    model = ridge.RidgeLogistic(featuresCol="few", weightCol=training.WEIGHT).fit(train)
    return model.transform(slicer.transform(p.test)).select(
        "row_key", F.col("label").cast("int").alias("y_true"),
        vector_to_array("probability")[1].alias("y_proba"), "prediction",
    )


def _newton_step(i: int) -> str:
    """Coefficients after step i + 1 from those after step i, by Cramer's rule."""
    x = ["1.0e0", "x1", "x2"]
    sums = [f"sum(w * (p - y) * {x[j]}) + max(b{j}) as g{j}" for j in range(3)]
    sums += [
        f"sum(w * p * (1 - p) * {x[j]} * {x[k]}){' + 1' if j == k else ''} as h{j}{k}"
        for j in range(3) for k in range(j, 3)
    ]
    return (
        f"s{i} as materialized (select {', '.join(sums)}, max(b0) as b0, max(b1) as b1, "
        "max(b2) as b2 from (select *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as p "
        f"from fitted, c{i})), "
        f"d{i} as (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) "
        f"+ h02 * (h01 * h12 - h11 * h02) as det from s{i}), "
        f"c{i + 1} as materialized (select "
        "b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) "
        "+ h02 * (g1 * h12 - h11 * g2)) / det as b0, "
        "b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) "
        "+ h02 * (h01 * g2 - g1 * h02)) / det as b1, "
        "b2 - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - h02 * g1) "
        f"+ g0 * (h01 * h12 - h11 * h02)) / det as b2 from d{i})"
    )


RIDGE_SQL = (
    f"{PREPARED}, scaled as materialized (select row_key, test, "
    "cast(is_repeat_buyer as integer) as y, "
    + ", ".join(f"({c} - m_{c}) / s_{c} as x{i}" for i, c in enumerate(FEW, 1))
    + " from moments, parts), fitted as materialized (select *, "
    "count(*) over () / (2.0e0 * count(*) over (partition by y)) as w from scaled where not test), "
    "c0 as (select 0.0e0 as b0, 0.0e0 as b1, 0.0e0 as b2), "
    + ", ".join(map(_newton_step, range(STEPS)))
    + " select row_key, y as y_true, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as y_proba, "
    "case when b0 + b1 * x1 + b2 * x2 > 0 then 1.0e0 else 0.0e0 end as prediction "
    f"from scaled, c{STEPS} where test"
)
register("ridge_scores", _ridge, RIDGE_SQL, "y_proba")


def _scored_rows(name: str):
    """What of a scored test part does not depend on the solver."""

    def query(f: Fixture) -> DataFrame:
        p = _prepared(f)
        trained = training.TRAINERS[name](p.train, p.test, p.names, SETTINGS)
        support = trained.metrics["classification_report"]
        return trained.predictions.select(
            "row_key", "y_true", F.col("y_proba").between(0, 1).alias("is_share"),
            ((F.col("y_proba") > 0.5) == (F.col("y_pred") == 1)).alias("is_majority"),
            F.lit(support[0]["support"]).alias("negatives"),
            F.lit(support[1]["support"]).alias("positives"),
        )

    return query


for _name in ("logistic", "random_forest"):
    register(
        f"scored_rows_{_name}", _scored_rows(_name),
        f"select * from ({PREPARED} select row_key, cast(is_repeat_buyer as integer) as y_true, "
        "true as is_share, true as is_majority, "
        "cast(sum(cast(not is_repeat_buyer as integer)) over () as bigint) as negatives, "
        "cast(sum(cast(is_repeat_buyer as integer)) over () as bigint) as positives "
        "from parts where test)",
    )
register(
    "importance_names",
    lambda f: _importance(f).select("feature", (F.col("importance") >= 0).alias("is_weight")),
    f"select name as feature, true as is_weight from ({NAMES_SQL})",
)


def _stages(f: Fixture) -> DataFrame:
    """Raw tables to model table through the stage functions and a catalog."""
    raw = {
        name: getattr(f, name)
        for name in ["orders", "items", "payments", "customers", "sellers", "geolocation",
                     "reviews", "products", "translation"]
    }
    catalog = Catalog(f.spark, scratch_folder(f.spark, "stages"))
    clean = stages.run_data_engineering(raw, SETTINGS, catalog)
    return stages.run_feature_engineering(clean, SETTINGS, catalog)["model_inputs"]


register("stage_runs", _stages, "select * from tw_model_inputs",
         "deli_cost item_price credit_card voucher debit_card boleto total_spent distance_km "
         "seller_repeat_buyer_rate product_weight_g product_length_cm product_height_cm "
         "product_width_cm")
