"""Tables written to the shared folder and read again: they cut a plan where its result is used more than once."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from dispatchlens import session


def written(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame under a new name in the shared folder, so that a lost executor costs no more than its tasks."""
    spark = frame.sparkSession
    path = session.run_path(spark, f"{name}-{uuid.uuid4().hex}")
    frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes tables of written() that nothing will read again: what was made of them is written itself."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that no one holds any more, now that their results are written.

    Spark deletes them when the driver's memory is collected, which may be long after in a job of many steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
