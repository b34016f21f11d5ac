"""Ingest that keeps what a watermark leaves behind: every record sent is kept, known as a repeat, or late.

Records behind the watermark (the greatest time of the batches before, less the delay) go to a side table instead of
vanishing. Among the others a record repeats an id if the same id was kept before, or stands earlier in the batch, at a time
that isn't behind the watermark by more than the delay. Records without a time are late, records without an id never repeat.
"""

from pyspark.sql import DataFrame, Observation, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from dispatchlens.sources import files
from dispatchlens.streaming.ledger import Ledger

FATES = ("kept", "repeat", "late")


class Arrivals:
    """Table of all records with their `fate`, in folders by batch, fate and hour, so that looking back reads the last hours only."""

    def __init__(self, path: str, schema: T.StructType, key: str, ts: str = "ts", delay_minutes: int = 10):
        self.path, self.schema, self.key, self.ts, self.delay = path, schema, key, ts, delay_minutes * 60_000_000

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = events.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def _stored(self, spark: SparkSession, upto: int) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType()), T.StructField("fate", T.StringType()), T.StructField("hour", T.LongType())])
        return spark.read.schema(stored).parquet(f"{self.path}/rows").where(F.col("batch") <= upto)

    def _judged(self, rows: DataFrame, last: dict | None) -> DataFrame:
        at = F.unix_micros(F.col(self.ts).cast("timestamp"))
        mark = last["mark"] if last else None
        rows = rows.withColumn("_at", at)
        late = F.col("_at").isNull() if mark is None else F.coalesce(F.col("_at") < mark, F.lit(True))
        rows = rows.withColumn("_late", late)
        first = F.row_number().over(W.partitionBy(self.key).orderBy("_at", *[c for c in self.schema.names if c not in (self.key, self.ts)]))
        dated = rows.where(~F.col("_late") & F.col(self.key).isNotNull()).withColumn("_again", first > 1)
        others = rows.where(F.col("_late") | F.col(self.key).isNull()).withColumn("_again", F.lit(False))
        if mark is not None:
            since = mark - self.delay
            recent = self._stored(rows.sparkSession, last["batch"]).where((F.col("fate") == "kept") & (F.col("hour") >= since // 3_600_000_000))
            known = recent.where(F.unix_micros(F.col(self.ts).cast("timestamp")) >= since).select(F.col(self.key).alias("_known")).distinct()
            dated = dated.join(known, F.col(self.key) == F.col("_known"), "left").withColumn("_again", F.col("_again") | F.col("_known").isNotNull()).drop("_known")
        fate = F.when(F.col("_late"), "late").when(F.col("_again"), "repeat").otherwise("kept")
        hour = F.floor(F.col("_at") / 3_600_000_000).cast("long")
        return dated.unionByName(others).withColumns({"fate": fate, "hour": F.coalesce(hour, F.lit(-1).cast("long"))})

    def write(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        ledger = Ledger(spark, self.path)
        if ledger.done(batch):
            return
        last = ledger.last()
        # The batch itself is written once; the counts are observed while its fates are written.
        raw = f"{self.path}/received/batch={batch}"
        rows.write.mode("overwrite").parquet(raw)
        seen = Observation()
        judged = self._judged(spark.read.schema(self.schema).parquet(raw), last).observe(
            seen, F.count("*").alias("sent"), F.max("_at").alias("newest"), *[F.count_if(F.col("fate") == f).alias(f) for f in FATES])
        judged.select(*self.schema.names, "fate", "hour").write.mode("overwrite").partitionBy("fate", "hour").parquet(f"{self.path}/rows/batch={batch}")
        got, counts = seen.get, (last or {}).get("counts", {})
        marks = [m for m in (last and last["mark"], got["newest"] is not None and got["newest"] - self.delay) if m]
        ledger.enter(batch, mark=max(marks, default=None), counts={k: counts.get(k, 0) + got[k] for k in ("sent", *FATES)})
        files.delete(spark, raw)

    def read(self, spark: SparkSession) -> DataFrame:
        """All records received, with `fate`."""
        last = Ledger(spark, self.path).last()
        if last is None or not files.exists(spark, f"{self.path}/rows"):
            return spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("fate", T.StringType())]))
        return self._stored(spark, last["batch"]).drop("batch", "hour")

    def counts(self, spark: SparkSession) -> dict[str, int]:
        """sent, kept, repeat and late over all batches; sent is the sum of the others."""
        last = Ledger(spark, self.path).last()
        return last["counts"] if last else dict.fromkeys(("sent", *FATES), 0)
