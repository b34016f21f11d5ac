"""CSV files whose quoted fields hold line breaks, read in byte ranges by many tasks.

Whether a line begins inside quotes depends on all quotes before it in its file. One pass counts the quotes of each byte range; running
sums over the ranges (a row each) tell how every range begins. A second pass puts lines together to records inside the
ranges; only records that cross the end of a range are put together from their pieces afterwards. Quotes are doubled inside
quoted fields, so that they don't change the count's parity.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

PIECES = "file string, block long, place int, piece string, text string"
WHOLE, HEAD, TAIL = "whole", "head", "tail"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines; one task reads the lines that begin in a byte range, in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def range_starts(lines: DataFrame) -> DataFrame:
    """(file, block, open): whether the first line of a range begins inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return counted.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("open"))


class _Range:
    """The lines of one range as they come; gives records and the pieces of records that cross its ends."""

    def __init__(self, file: str, block: int, open_: bool):
        self.file, self.block, self.open = file, block, open_
        self.held: list[str] = []  # lines of a record that hasn't ended
        self.inside = open_  # the held lines continue a record of an earlier range
        self.header = block == 0

    def take(self, values: pa.Array) -> tuple[list[str], list[str]]:
        """(records, heads) that end in these lines."""
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.open) % 2
        ends = np.flatnonzero(after == 0)  # a record ends with each of these lines
        self.open = bool(after[-1]) if len(after) else self.open
        texts = values.to_pylist()
        records, heads, at = [], [], 0
        for end in ends.tolist():
            text = texts[end] if end == at and not self.held else "\n".join([*self.held, *texts[at:end + 1]])
            self.held, at = [], end + 1
            text = text[:-1] if text.endswith("\r") else text
            if self.inside:
                heads.append(text)
                self.inside = False
            elif self.header:
                self.header = False
            else:
                records.append(text)
        self.held += texts[at:]
        return records, heads

    def rows(self, piece: str, texts: list[str], place: int) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_pydict({"file": pa.array([self.file] * n, pa.string()), "block": pa.array([self.block] * n, pa.int64()),
                                           "place": pa.array([place] * n, pa.int32()), "piece": pa.array([piece] * n, pa.string()), "text": pa.array(texts, pa.string())})

    def left(self) -> pa.RecordBatch | None:
        """The lines of a record that goes on in the next range: its beginning, or more of one that began earlier."""
        if not self.held:
            return None
        return self.rows(HEAD if self.inside else TAIL, ["\n".join(self.held)], 0 if self.inside else 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        file, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
        number = file.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(block) != 0)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if low == high:
                continue
            name, start = file.dictionary[number[low]].as_py(), int(block[low])
            if now is None or (now.file, now.block) != (name, start):
                if now is not None and (rest := now.left()) is not None:
                    yield rest
                now = _Range(name, start, batch.column(3)[low].as_py())
            records, heads = now.take(batch.column(2).slice(low, high - low))
            if heads:
                yield now.rows(HEAD, heads, 0)
            if records:
                yield now.rows(WHOLE, records, 0)
    if now is not None and (rest := now.left()) is not None:
        yield rest


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a CSV file, or of a folder of them, as text (`record`), without header lines and empty lines."""
    lines = _lines(spark, path)
    # A row for each byte range, 128 MB of input by default; a shuffle would lose the order of the lines.
    starts = range_starts(lines).select(F.col("file").alias("_file"), F.col("block").alias("_block"), "open")
    known = lines.join(F.broadcast(starts), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    pieces = known.select("file", "block", "value", "open").mapInArrow(_pieces, PIECES)
    order = W.partitionBy("file").orderBy("block", "place")
    # A piece belongs to the last record that began before it.
    crossing = pieces.where(F.col("piece") != WHOLE).withColumn("began", F.sum((F.col("piece") == TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "text")))
    joined = crossing.groupBy("file", "began").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("record"))
    whole = pieces.where(F.col("piece") == WHOLE).select(F.col("text").alias("record"))
    return whole.unionByName(joined.select("record")).where("record <> ''")
