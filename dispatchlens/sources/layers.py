"""Layered table storage: raw, features, predictions and monitoring folders of parquet tables."""

from pyspark.sql import DataFrame, SparkSession, types as T

from dispatchlens.sources import files

LAYERS = ("raw", "features", "predictions", "monitoring")


class Layers:
    """Tables below one root, one folder per layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, table: str = "") -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; one of {LAYERS}")
        return f"{self.root}/{layer}/{table}".rstrip("/")

    def ensure(self, layer: str) -> None:
        files.make(self.spark, self.path(layer))

    def tables(self, layer: str) -> list[str]:
        return files.folders(self.spark, self.path(layer))

    def clear(self, layer: str) -> int:
        """Drop all tables of one layer; returns how many there were."""
        names = self.tables(layer)
        for name in names:
            files.delete(self.spark, self.path(layer, name))
        return len(names)

    def read(self, layer: str, table: str, columns=None, limit: int | None = None,
             order_by: str | None = None) -> DataFrame:
        """A projection of a table; a limit takes the first rows by `order_by`, so it is repeatable."""
        df = self.spark.read.parquet(self.path(layer, table))
        if columns is not None:
            df = df.select(*columns)
        if limit:
            df = (df.orderBy(order_by) if order_by else df).limit(limit)
        return df

    def replace(self, layer: str, table: str, df: DataFrame, partition_by=()) -> DataFrame:
        """Rebuild a table; running it again gives the same table, not more rows."""
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(layer, table))
        return self.read(layer, table)

    def append(self, layer: str, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(layer, table))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV snapshot with a header; quotes are doubled, as the loader expects."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Catalog table bucketed by its join key, so joins and groupings on it need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
