"""Default parameters of all jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


def _list(*values):
    return field(default_factory=lambda: list(values))


@dataclass(frozen=True)
class Settings:
    # The lists of columns, statuses and payment types, as the raw tables have them.
    # Cleaning
    order_dates: list[str] = _list(
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    order_drop: list[str] = _list("order_delivered_carrier_date")
    first_year: int = 2016
    last_year: int = 2018
    unpaid_statuses: list[str] = _list("canceled", "created", "invoiced", "unavailable")
    item_drop: list[str] = _list("shipping_limit_date")
    item_capped: list[str] = _list("price", "freight_value")
    item_cap_percent: float = 99.9
    payment_unwanted: str = "not_defined"
    payment_drop: list[str] = _list("payment_sequential")
    installment_quantile: float = 0.99
    lat_range: tuple[float, float] = (-33.75116944, 5.27438888)
    lng_range: tuple[float, float] = (-73.98283055, -34.79314722)
    max_zip_range: float = 0.5
    review_drop: list[str] = _list(
        "review_id", "review_comment_title", "review_creation_date", "review_answer_timestamp"
    )
    # Features
    payment_types: list[str] = _list("credit_card", "voucher", "debit_card", "boleto")
    dense_cities: int = 5
    run_sentiment: bool = False
    # Preprocessing
    test_share: float = 0.2
    stratify: bool = True
    seed: int = 42
    target: str = "is_repeat_buyer"
    numeric: list[str] = _list(
        "deli_duration_exp", "deli_duration_paid", "deli_cost", "item_price", "total_spent",
        "installment", "distance_km", "high_density_customer_area", "seller_repeat_buyer_rate",
        "review_score", "product_name_length", "product_description_length",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm",
    )
    payment_numeric: list[str] = _list("credit_card", "voucher", "debit_card", "boleto")
    categorical: list[str] = _list("product_category_name")
    # Models
    trees: int = 100
    tree_depth: int = 10
    logistic_c: float = 1.0
    logistic_iterations: int = 500
    logistic_tolerance: float = 1e-6
    # For all logistic models, also those of the grid.
    penalize_intercept: bool = False
    boosted_a_rounds: int = 100
    boosted_a_rate: float = 0.1
    boosted_a_depth: int = 6
    boosted_b_rounds: int = 100
    boosted_b_rate: float = 0.1
    boosted_b_depth: int = 6
    positive_weight: float = 15.0
    # Partitions of training rows. Fitted trees depend on it, so it is not taken from the cores.
    train_partitions: int = 16
    skip: frozenset[str] = frozenset()
    # Tuning
    grid_c: list[float] = _list(0.01, 0.1, 1.0, 10.0)
    grid_iterations: list[int] = _list(300, 500, 1000)
    grid_weights: list[str | None] = _list("balanced", None)
    folds: int = 5
    # Weak labels
    weak_score_above: int = 3
    weak_days_at_most: int = -7
    weak_voucher_share: float = 0.3
    weak_spent_quantile: float = 0.8
    weak_categories: int = 10
    confident: float = 0.8
    retrain_iterations: int = 1000
    top_share: float = 0.1


DEFAULTS = Settings()
