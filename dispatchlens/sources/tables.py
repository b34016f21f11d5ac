"""Registry of the raw CSV tables and their typed, repeatable load into the raw layer."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dispatchlens import schemas, session
from dispatchlens.sources import files, records
from dispatchlens.sources.layers import Layers


@dataclass(frozen=True)
class CsvTable:
    """Where a raw table comes from and what it looks like."""
    schema: T.StructType
    filename: str
    encoding: str = "UTF-8"


# Table names and file names.
REGISTRY = {
    "orders": CsvTable(schemas.ORDERS, "olist_orders_dataset.csv"),
    "order_items": CsvTable(schemas.ORDER_ITEMS, "olist_order_items_dataset.csv"),
    "customers": CsvTable(schemas.CUSTOMERS, "olist_customers_dataset.csv"),
    "sellers": CsvTable(schemas.SELLERS, "olist_sellers_dataset.csv"),
    "products": CsvTable(schemas.PRODUCTS, "olist_products_dataset.csv"),
    "order_payments": CsvTable(schemas.ORDER_PAYMENTS, "olist_order_payments_dataset.csv"),
    "order_reviews": CsvTable(schemas.ORDER_REVIEWS, "olist_order_reviews_dataset.csv"),
    "product_category_name_translation": CsvTable(
        schemas.CATEGORY_TRANSLATION, "product_category_name_translation.csv"),
}


# Texts that stand for a missing value.
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
                "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, table: CsvTable, data_dir: str, multi_line: bool = False) -> DataFrame:
    """One CSV (a file, or a folder of part files) by its declared schema; empty text and the null markers are null.

    `multi_line` reads quoted line breaks, in UTF-8 files with as many tasks as there are byte ranges. A value that doesn't fit its declared type raises.
    """
    path = f"{data_dir}/{table.filename}"
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in table.schema.fields])
    options = {"escape": '"', "mode": "FAILFAST"}
    if multi_line and table.encoding == "UTF-8":
        session.ship(spark)
        parsed = F.from_csv("record", F.lit(as_text.toDDL()), options | {"multiLine": "true"})
        rows = records.csv_records(spark, path).select(parsed.alias("row")).select("row.*")
    else:
        rows = (spark.read.schema(as_text).options(**options).option("header", True).option("encoding", table.encoding)
                .option("multiLine", multi_line).csv(path))
    return rows.select([_typed(f) for f in table.schema.fields])


def _typed(field: T.StructField) -> Column:
    value = F.when(~F.col(field.name).isin(*NULL_MARKERS), F.col(field.name))
    return value.cast(field.dataType).alias(field.name)


def load_raw(layers: Layers, data_dir: str, tables=None, clear: bool = False) -> dict[str, int]:
    """Load all or the named tables; {table: rows}.

    Unknown names and missing files are reported before anything is cleared or written.
    """
    spark = layers.spark
    unknown = sorted(set(tables or ()) - set(REGISTRY))
    if unknown:
        raise ValueError(f"unknown table(s): {unknown}")
    chosen = {name: t for name, t in REGISTRY.items() if tables is None or name in tables}
    missing = [t.filename for t in chosen.values() if not files.exists(spark, f"{data_dir}/{t.filename}")]
    if missing:
        raise FileNotFoundError(f"missing source file(s) in {data_dir}: {missing}")
    layers.ensure("raw")
    if clear:
        layers.clear("raw")
    return {name: layers.replace("raw", name, read_csv(spark, t, data_dir, name == "order_reviews")).count()
            for name, t in chosen.items()}
