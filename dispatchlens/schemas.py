"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T


def _struct(columns: str) -> T.StructType:
    """Schema from "name TYPE, ..." with simple types; needs no running session."""
    kinds = {"STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
             "TIMESTAMP_NTZ": T.TimestampNTZType()}
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


ORDERS = _struct(
    "order_id STRING, customer_id STRING, order_status STRING, "
    "order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ, "
    "order_delivered_carrier_date TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ, "
    "order_estimated_delivery_date TIMESTAMP_NTZ")
ORDER_ITEMS = _struct(
    "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
    "shipping_limit_date TIMESTAMP_NTZ, price DOUBLE, freight_value DOUBLE")
CUSTOMERS = _struct(
    "customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix INT, "
    "customer_city STRING, customer_state STRING")
SELLERS = _struct(
    "seller_id STRING, seller_zip_code_prefix INT, seller_city STRING, seller_state STRING")
PRODUCTS = _struct(
    "product_id STRING, product_category_name STRING, product_name_lenght INT, "
    "product_description_lenght INT, product_photos_qty INT, product_weight_g DOUBLE, "
    "product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE")
ORDER_PAYMENTS = _struct(
    "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, "
    "payment_value DOUBLE")
ORDER_REVIEWS = _struct(
    "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
    "review_comment_message STRING, review_creation_date TIMESTAMP_NTZ, "
    "review_answer_timestamp TIMESTAMP_NTZ")
CATEGORY_TRANSLATION = _struct(
    "product_category_name STRING, product_category_name_english STRING")

DEPLOY_RUN = T.StructType([
    *_struct("run_id STRING, started_at STRING, finished_at STRING, duration_seconds INT, branch STRING, "
             "old_commit STRING, new_commit STRING"),
    T.StructField("changed_paths", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType()),
    T.StructField("actions", _struct("restart STRING, trigger STRING, import STRING")),
    *_struct("dag_run_id STRING, host STRING")])
RETRAIN_OUTCOME = _struct("dag_run_id STRING, state STRING, deploy_commit STRING")
#: As a stream needs it: with the time the record was written.
TIMED_OUTCOME = _struct("dag_run_id STRING, state STRING, deploy_commit STRING, recorded_at STRING")

LOG_ENVELOPE = "timestamp STRING, level STRING, logger STRING, message STRING, request_id STRING"
REQUEST_LOG = _struct(
    LOG_ENVELOPE + ", method STRING, endpoint STRING, status INT, latency_ms DOUBLE")
PREDICTION_LOG = _struct(
    LOG_ENVELOPE + ", order_id STRING, late_delivery_probability DOUBLE, risk_level STRING, "
    "model_version STRING, scored_by STRING")
