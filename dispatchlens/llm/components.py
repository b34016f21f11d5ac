"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.store import dropped, released, written

#: Edges that a task takes; where there are fewer, the steps run in fewer tasks than there are shuffle partitions.
TASK_EDGES = 100_000


def _starred(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Joins every neighbour (the larger ones for a large star, the smaller ones for a small one) to the least of all."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    met = both.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").coalesce(tasks).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of the nodes of edges (a, b): the least id reachable. Few rounds even for long chains."""
    def mark(frame):
        return frame.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)).alias("h")).first()

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = mark(now)
    while True:
        tasks = 1 + seen["n"] // TASK_EDGES
        before, now = now, written(_starred(_starred(now, True, tasks), False, tasks), "edges")
        dropped(before)
        released(edges.sparkSession)
        if (new := mark(now)) == seen:
            return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("label"))).distinct()
        seen = new
