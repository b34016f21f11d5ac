"""Tolerant JSON-lines logs: blank and cut-off lines are skipped, an absent file is empty."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dispatchlens.sources import files
from dispatchlens.sources.layers import empty

SEQUENCE = "seq"
_SEQUENCE_TYPE = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
                               T.StructField("row", T.LongType())])


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log's records plus `seq`, which orders them as they were appended.

    `seq` is file name, split offset and row number within the task: Spark promises no row order,
    but rows of one split are numbered in file order. Rotated files must sort by name.
    """
    with_sequence = T.StructType([*schema.fields, T.StructField(SEQUENCE, _SEQUENCE_TYPE)])
    if not files.exists(spark, path):
        return empty(spark, with_sequence)
    lines = spark.read.text(path).select(
        F.col("value"), F.struct(F.col("_metadata.file_path").alias("file"),
                                 F.col("_metadata.file_block_start").alias("block"),
                                 F.monotonically_increasing_id().alias("row")).alias(SEQUENCE))
    return parse_lines(lines, schema)


def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Text lines to records, skipping every line that is not a JSON object; other columns stay.

    Only the syntax decides about a line. A field whose value can't be read as its declared type is null.
    """
    others = [c for c in lines.columns if c != line]
    parsed = lines.select(F.try_parse_json(F.col(line)).alias("_record"), *others)
    return (parsed.where(F.schema_of_variant("_record").startswith("OBJECT"))
            .select(*[F.try_variant_get("_record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields], *others))


def stream_log(spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The same records as a stream over files arriving in a folder."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.text(folder), schema)


def event_time(column: str = "timestamp"):
    """The envelope's ISO time; null where it can't be read."""
    return F.try_to_timestamp(column)
