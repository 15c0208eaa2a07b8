"""Named slices of the whole job: plain functions over a dict of tables.

With a catalog every result is written and read back, as later stages use it several times.
Bounds such as caps and medians are found by jobs of their own while a stage is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from encore.operators.metrics import pr_curve, roc_curve
from encore.plans import cleaning, features
from encore.plans.preprocessing import Prepared, prepare
from encore.plans.settings import DEFAULTS, Settings
from encore.plans.training import TRAINERS, Trained, metrics_frame
from encore.plans.tuning import tune_logistic
from encore.plans.weak_labels import bias_report, pseudo_labels, retrain, weak_positive_mask
from encore.sources.catalog import Catalog

Tables = dict[str, DataFrame]


def _store(tables: Tables, name: str, df: DataFrame, catalog: Catalog | None) -> None:
    tables[name] = catalog.save(df, name) if catalog else df


def run_data_engineering(
    raw: Tables, settings: Settings = DEFAULTS, catalog: Catalog | None = None
) -> Tables:
    """Raw tables to clean tables and labelled orders."""
    t: Tables = dict(raw)
    _store(t, "clean_orders", cleaning.clean_orders(t["orders"], settings), catalog)
    _store(t, "clean_items", cleaning.clean_items(t["items"], settings), catalog)
    _store(t, "clean_payments", cleaning.clean_payments(t["payments"], settings), catalog)
    _store(t, "clean_customers", cleaning.clean_customers(t["customers"]), catalog)
    _store(t, "clean_sellers", cleaning.clean_sellers(t["sellers"]), catalog)
    _store(t, "clean_geolocation", cleaning.clean_geolocation(t["geolocation"], settings), catalog)
    _store(t, "clean_reviews", cleaning.clean_reviews(t["reviews"], settings), catalog)
    _store(t, "clean_products", cleaning.clean_products(t["products"]), catalog)
    labels = cleaning.mega_id_labels(t["clean_orders"], t["clean_items"], t["clean_customers"])
    _store(t, "mega_id_labels", labels, catalog)
    return t


def run_feature_engineering(
    clean: Tables,
    settings: Settings = DEFAULTS,
    catalog: Catalog | None = None,
    predictor: features.Predictor = None,
) -> Tables:
    """Clean tables to the model table."""
    t: Tables = dict(clean)
    _store(t, "tagged_customers", features.tagged_customers(t["clean_customers"], settings), catalog)
    distances = features.order_distances(
        t["clean_items"], t["clean_orders"], t["tagged_customers"], t["clean_sellers"],
        t["clean_geolocation"], t["mega_id_labels"],
    )
    _store(t, "order_distances", distances, catalog)
    stats = features.distance_seller_stats(t["order_distances"])
    _store(t, "distance_seller_stats", stats, catalog)
    reviews = features.review_features(t["clean_reviews"], settings.run_sentiment, predictor)
    _store(t, "review_features", reviews, catalog)
    products = features.product_features(t["clean_products"], t["translation"])
    _store(t, "product_features", products, catalog)
    transactions = features.transaction_features(
        t["clean_orders"], t["clean_items"], t["clean_payments"], t["mega_id_labels"], settings
    )
    _store(t, "transaction_features", transactions, catalog)
    inputs = features.model_inputs(
        t["transaction_features"], t["product_features"], t["review_features"],
        t["distance_seller_stats"],
    )
    _store(t, "model_inputs", inputs, catalog)
    return t


def _store_model(name: str, trained: Trained, catalog: Catalog | None) -> None:
    """Write a model with its predictions, curves and metrics. A skipped model has no file of
    its own, empty tables, and metrics that say so."""
    if catalog is None:
        return
    catalog.save(metrics_frame(trained.predictions, trained), f"{name}_metrics")
    if trained.model is not None:
        catalog.save_model(trained.model, name)
    catalog.save(trained.predictions, f"{name}_predictions_test")
    catalog.save(trained.top, f"{name}_top_10_predictions")
    none = trained.model is None
    for kind, curve in (("pr_curve", pr_curve), ("roc_curve", roc_curve)):
        points = curve(trained.thresholds)
        catalog.save(points.limit(0) if none else points, f"{name}_{kind}")
    trained.release()


def run_preprocessing(
    tables: Tables, settings: Settings = DEFAULTS, catalog: Catalog | None = None
) -> Prepared:
    """Split, scale and encode the model table."""
    prepared = prepare(tables["model_inputs"], settings)
    if catalog:
        catalog.save_model(prepared.preprocessor, "preprocessor")
        names = prepared.train.sparkSession.createDataFrame(
            list(enumerate(prepared.names)), "position int, name string"
        )
        catalog.save(names, "train_columns")
    return prepared


def run_modelling(
    prepared: Prepared, settings: Settings = DEFAULTS, catalog: Catalog | None = None
) -> dict[str, Trained]:
    """Train and evaluate all classifiers."""
    results = {}
    for name, trainer in TRAINERS.items():
        results[name] = trainer(prepared.train, prepared.test, prepared.names, settings)
        _store_model(name, results[name], catalog)
    return results


def run_model_training(
    tables: Tables, settings: Settings = DEFAULTS, catalog: Catalog | None = None
) -> dict[str, Trained]:
    """Preprocessing and modelling in one go, from a stored model table."""
    return run_modelling(run_preprocessing(tables, settings, catalog), settings, catalog)


def run_tuning(
    prepared: Prepared, settings: Settings = DEFAULTS, catalog: Catalog | None = None
) -> Trained:
    tuned = tune_logistic(prepared.train, prepared.test, prepared.names, settings)
    _store_model("tuned_logistic", tuned, catalog)
    return tuned


def run_semi_supervised(
    tables: Tables,
    prepared: Prepared,
    best: Trained,
    settings: Settings = DEFAULTS,
    catalog: Catalog | None = None,
) -> tuple[Tables, Trained]:
    """Pseudo labels from the best model and the weak signs, a retrained model, a bias report."""
    t: Tables = dict(tables)
    masked = weak_positive_mask(t["model_inputs"], settings)
    _store(t, "weak_positive_mask", masked, catalog)
    labelled = pseudo_labels(
        t["weak_positive_mask"], prepared.preprocessor, best.model, settings
    )
    _store(t, "pseudo_labeled_data", labelled, catalog)
    retrained = retrain(t["pseudo_labeled_data"], settings)
    _store_model("ssl_logistic", retrained, catalog)
    _store(t, "ssl_bias_report", bias_report(t["pseudo_labeled_data"], settings), catalog)
    return t, retrained


def run_all(
    raw: Tables,
    settings: Settings = DEFAULTS,
    catalog: Catalog | None = None,
    predictor: features.Predictor = None,
) -> tuple[Tables, dict[str, Trained]]:
    """Every stage in order: raw tables to models and reports."""
    tables = run_data_engineering(raw, settings, catalog)
    tables = run_feature_engineering(tables, settings, catalog, predictor)
    prepared = run_preprocessing(tables, settings, catalog)
    models = run_modelling(prepared, settings, catalog)
    models["tuned_logistic"] = run_tuning(prepared, settings, catalog)
    tables, models["ssl_logistic"] = run_semi_supervised(
        tables, prepared, models["tuned_logistic"], settings, catalog
    )
    return tables, models
