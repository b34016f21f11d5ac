"""Names, thresholds and lookups shared by every step."""

ORDER_ID = "order_id"
LABEL = "is_late_delivery"
PURCHASE_TS = "purchase_ts"

# The ordered feature contract.
FEATURES = (
    "payment_count", "payment_type_mode", "max_installments",
    "order_item_count", "product_count", "seller_count",
    "price_sum", "price_mean", "price_max", "price_std",
    "freight_sum", "freight_mean", "freight_max", "freight_std",
    "total_cost_sum", "total_cost_mean", "total_cost_max",
    "product_category_count", "product_category_mode", "is_multi_category",
    "product_weight_g_mean", "product_weight_g_max",
    "product_length_cm_mean", "product_length_cm_max",
    "product_height_cm_mean", "product_height_cm_max",
    "product_width_cm_mean", "product_width_cm_max",
    "product_volume_mean", "product_volume_max",
    "seller_state_mode", "seller_state_count", "seller_city_count", "seller_zip_mode",
    "purchase_hour", "purchase_dayofweek", "is_weekend_purchase",
    "purchase_month", "purchase_quarter", "is_month_end",
    "estimated_delivery_days", "approval_delay_hours",
    "shipping_limit_min_days", "shipping_window_days", "seller_margin_days",
)
# Text features; the rest are numeric.
CATEGORICAL = ("payment_type_mode", "product_category_mode", "seller_state_mode")
NUMERIC = tuple(c for c in FEATURES if c not in CATEGORICAL)

# Features a scoring record may leave out or send as null.
OPTIONAL = (
    "price_std", "freight_std",
    "product_weight_g_mean", "product_weight_g_max",
    "product_length_cm_mean", "product_length_cm_max",
    "product_height_cm_mean", "product_height_cm_max",
    "product_width_cm_mean", "product_width_cm_max",
    "product_volume_mean", "product_volume_max",
)

# Fields known only after the purchase; never model inputs.
OUTCOME_FIELDS = (
    "is_late_delivery", "order_delivered_customer_date", "order_delivered_carrier_date",
    "order_delivery_date", "actual_delivery_days", "delivery_delay_days",
    "review_score", "review_comment_message", "review_creation_date",
)

# Whole-number features, the flag, and closed ranges of a scoring record.
INTEGER_FEATURES = (
    "payment_count", "order_item_count", "product_count", "seller_count",
    "product_category_count", "seller_state_count", "seller_city_count", "seller_zip_mode",
    "purchase_hour", "purchase_dayofweek", "is_weekend_purchase",
    "purchase_month", "purchase_quarter", "is_month_end",
    "estimated_delivery_days", "shipping_limit_min_days", "shipping_window_days",
    "seller_margin_days",
)
BOOLEAN_FEATURES = ("is_multi_category",)
NON_NEGATIVE = (
    "payment_count", "max_installments", "order_item_count", "product_count", "seller_count",
    "price_sum", "price_mean", "price_max", "freight_sum", "freight_mean", "freight_max",
    "total_cost_sum", "total_cost_mean", "total_cost_max", "product_category_count",
    "seller_state_count", "seller_city_count", "approval_delay_hours",
)
BOUNDED = {
    "purchase_hour": (0, 23),
    "purchase_dayofweek": (0, 6),
    "is_weekend_purchase": (0, 1),
    "purchase_month": (1, 12),
    "purchase_quarter": (1, 4),
    "is_month_end": (0, 1),
    "estimated_delivery_days": (1, 365),
}

# Risk bands, their actions, and the baseline score.
HIGH_RISK = 0.55
MEDIUM_RISK = 0.25
RISK_LEVELS = ("low", "medium", "high")
ACTIONS = {
    "low": "monitor normally",
    "medium": "confirm carrier capacity",
    "high": "prioritize fulfillment intervention",
}
BASELINE_VERSION = "reference-baseline"
BASELINE = {"base": 0.06, "per_day": 0.018, "per_freight": 0.0012, "evening": 0.012,
            "evening_from": 18, "low": 0.01, "high": 0.98}

# Drift monitoring.
DRIFT_FEATURES = (
    "estimated_delivery_days", "freight_sum", "price_sum", "product_count",
    "seller_count", "approval_delay_hours", "shipping_window_days", "total_cost_sum",
)
PSI_LIMIT = 0.2
PSI_BINS = 10
PSI_FLOOR = 1e-6
MIN_AUC = 0.65

# Training.
SPLIT_QUANTILE = 0.8
SEED = 42
MIN_CATEGORY_ROWS = 20

# Operations log and service roll-ups.
HISTORY_LIMIT = 20
PREDICTION_ENDPOINTS = ("/predict", "/batch-predict")
LATENCY_BOUNDS_SECONDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75,
                          1.0, 2.5, 5.0, 7.5, 10.0)
