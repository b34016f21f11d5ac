"""Exact quantiles (linear interpolation) of large columns.

A sketch gives points just below and above each wanted rank, one pass counts the rows on and
between those points, and only the rows of the few small gaps that hold a wanted rank are grouped
and ranked. The driver sees a few numbers per quantile; no task ranks more than `max_rows` values
of a gap.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F


@dataclass
class _Gap:
    """Rows of a column with low < value < high (None: no bound) and the ranks looked for there."""
    column: str
    ranks: list[int]
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def rows(self) -> Column:
        v = F.col(self.column)
        if self.low is None:
            return v
        return F.when((v > self.low) & (v < self.high), v)


def numeric_view(df: DataFrame, columns) -> DataFrame:
    """The columns as doubles, with NaN as null."""
    as_double = {c: F.col(c).cast("double") for c in columns}
    return df.select([F.when(~F.isnan(v), v).alias(c) for c, v in as_double.items()])


def bucketed(df: DataFrame, points: dict[str, list[float]], prefix: str) -> DataFrame:
    """Adds prefix + column: how many of the column's sorted points are <= its value."""
    if not points:
        return df
    return Bucketizer(inputCols=list(points), outputCols=[prefix + c for c in points],
                      splitsArray=[[-math.inf, *p, math.inf] for p in points.values()]).transform(df)


def long_counts(df: DataFrame, cells: dict[str, str], by=()) -> DataFrame:
    """Rows per (by, name, cell) for several integer cell columns, nulls left out.

    A row becomes a narrow one per column where it lies; the counts are combined before anything is shuffled.
    """
    by = list(by)
    rows = F.array(*[F.struct(F.lit(i).alias("nth"), F.col(c).cast("int").alias("cell")) for i, c in enumerate(cells.values())])
    counted = (df.select(*by, F.inline_outer(rows)).where("cell IS NOT NULL")
               .groupBy(*by, "nth", "cell").agg(F.count("*").alias("n")))
    return counted.select(*by, "n", F.get(F.lit(list(cells)), F.col("nth")).alias("name"), "cell")


def _cell_counts(df: DataFrame, gaps: list[_Gap], points: list[list[float]]) -> dict[tuple[int, int], int]:
    """{(gap, cell): rows}; cell 2i - 1 is on the i-th point, 2i between it and the next one. A task counts its own rows column by column."""
    columns = sorted({g.column for g in gaps})
    told = [(columns.index(g.column), g.low, g.high, np.array(p)) for g, p in zip(gaps, points, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(2 * len(p) + 1, np.int64) for *_, p in told]
        for batch in batches:
            values = [v[~np.isnan(v)] for v in (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)]
            for (place, low, high, p), count in zip(told, counts, strict=True):
                v = values[place]
                if low is not None:
                    v = v[(v > low) & (v < high)]
                upto = np.searchsorted(p, v, "right")
                count += np.bincount(2 * upto - ((upto > 0) & (p[upto - 1] == v)), minlength=len(count))
        for i, count in enumerate(counts):
            cells = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"gap": pa.array(np.full(len(cells), i), pa.int32()), "cell": pa.array(cells, pa.int32()), "n": pa.array(count[cells])})

    counted = df.select(columns).mapInArrow(run, "gap int, cell int, n long").groupBy("gap", "cell").agg(F.sum("n").alias("n"))
    return {(r["gap"], r["cell"]): r["n"] for r in counted.collect()}


def _refine(df: DataFrame, gaps: list[_Gap], accuracy: int) -> tuple[dict, list[_Gap]]:
    """Values of ranks that fall on a sketch point, and smaller gaps for the others."""
    slack = 2.0 / accuracy
    aggs = []
    for i, g in enumerate(gaps):
        places = [(r - g.below) / g.inside for r in g.ranks]
        probs = sorted({min(1.0, max(0.0, p)) for at in places for p in (at - slack, at + 1 / g.inside + slack)})
        aggs.append(F.percentile_approx(g.rows(), probs, accuracy).alias(f"s{i}"))
    sketch = df.agg(*aggs).first()
    points = [sorted(set(sketch[i])) for i in range(len(gaps))]
    counts = _cell_counts(df, gaps, points)
    values, smaller = {}, []
    for i, (g, at) in enumerate(zip(gaps, points)):
        start = g.below
        for cell in range(2 * len(at) + 1):
            n = counts.get((i, cell), 0)
            ranks = [r for r in g.ranks if start <= r < start + n]
            if ranks and cell % 2:
                values |= {(g.column, r): at[cell // 2] for r in ranks}
            elif ranks:
                low = at[cell // 2 - 1] if cell else g.low
                high = at[cell // 2] if cell // 2 < len(at) else g.high
                low = -math.inf if low is None else low
                high = math.inf if high is None else high
                # points are values of the gap, so that each of its smaller gaps lacks a row at least
                smaller.append(_Gap(g.column, ranks, start, n, low, high))
            start += n
    return values, smaller


def _ranked(df: DataFrame, gaps: list[_Gap]) -> dict[tuple[str, int], float]:
    """Group and rank the rows of small gaps; one window per gap. A task hands on the rows in gaps alone, equal values of a batch counted."""
    columns = sorted({g.column for g in gaps})
    told = [(columns.index(g.column), g.low, g.high) for g in gaps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v[~np.isnan(v)] for v in (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)]
            for i, (place, low, high) in enumerate(told):
                v = values[place]
                found, n = np.unique(v if low is None else v[(v > low) & (v < high)], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_pydict({"gap": pa.array(np.full(len(found), i), pa.int32()), "value": pa.array(found), "n": pa.array(n.astype(np.int64))})

    kept = df.select(columns).mapInArrow(run, "gap int, value double, n long")
    wanted = F.array(*[F.lit([r - g.below for r in g.ranks]) for g in gaps])
    upto = F.sum("n").over(W.partitionBy("gap").orderBy("value"))
    hits = (kept.groupBy("gap", "value").agg(F.sum("n").alias("n")).withColumn("upto", upto)
            .select("gap", "value", F.filter(F.get(wanted, F.col("gap")), lambda r: (
                (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))).alias("hit"))
            .where(F.size("hit") > 0))
    return {(gaps[r["gap"]].column, local + gaps[r["gap"]].below): r["value"]
            for r in hits.collect() for local in r["hit"]}


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], sizes: dict[str, int],
                     max_rows: int, accuracy: int) -> dict[tuple[str, int], float]:
    """{(column, rank): value}, rank 0 being the smallest value."""
    values: dict[tuple[str, int], float] = {}
    gaps = [_Gap(c, sorted(set(wanted)), 0, sizes[c]) for c, wanted in ranks.items()]
    while large := [g for g in gaps if g.inside > max_rows]:
        found, smaller = _refine(df, large, accuracy)
        values |= found
        gaps = [g for g in gaps if g.inside <= max_rows] + smaller
    return values | (_ranked(df, gaps) if gaps else {})


def _finite_view(df: DataFrame, columns) -> DataFrame:
    """The columns as doubles; NaN and both infinities are null."""
    as_double = {c: F.col(c).cast("double") for c in columns}
    return df.select([F.when(F.abs(v) < math.inf, v).alias(c) for c, v in as_double.items()])


def _sizes(df: DataFrame, columns) -> dict[str, tuple[int, int, int]]:
    """{column: rows at minus infinity, finite rows, rows at infinity}, in one pass."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.count_if(v == -math.inf).alias(f"low{i}"), F.count_if(F.abs(v) < math.inf).alias(f"finite{i}"),
                 F.count_if(v == math.inf).alias(f"high{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"low{i}"], row[f"finite{i}"], row[f"high{i}"]) for i, c in enumerate(columns)}


def exact_quantiles(df: DataFrame, columns, probs, max_rows: int = 1_000_000,
                    accuracy: int = 10_000) -> dict[str, list[float] | None]:
    """{column: value per probability}; nulls and NaN are left out, None for an empty column.

    Infinities are counted with the sizes and take the outermost ranks, only finite values are searched. Between an
    infinity and a finite value lies the infinity, and between both NaN.
    """
    columns = list(columns)
    sizes = _sizes(df, columns)
    places = {c: [p * (sum(sizes[c]) - 1) for p in probs] for c in columns if sum(sizes[c])}
    ranks = {}
    for c, ats in places.items():
        low, finite, _ = sizes[c]
        inside = [r - low for at in ats for r in (math.floor(at), math.ceil(at)) if low <= r < low + finite]
        if inside:
            ranks[c] = inside
    found = order_statistics(_finite_view(df, columns), ranks, {c: sizes[c][1] for c in ranks}, max_rows, accuracy) if ranks else {}

    def at_rank(c: str, rank: int) -> float:
        low, finite, _ = sizes[c]
        if rank < low:
            return -math.inf
        return found[(c, rank - low)] if rank < low + finite else math.inf

    def at_place(c: str, at: float) -> float:
        low, high = at_rank(c, math.floor(at)), at_rank(c, math.ceil(at))
        share = at - math.floor(at)
        if low == high or not share:
            return low
        return low + (high - low) * share if math.isfinite(high - low) else (1 - share) * low + share * high

    return {c: [at_place(c, at) for at in places[c]] if c in places else None for c in columns}


def approximate_quantiles(df: DataFrame, columns, probs, accuracy: int = 10_000):
    """Same shape from one sketch pass, without interpolation."""
    columns = list(columns)
    row = numeric_view(df, columns).agg(
        *[F.percentile_approx(c, list(probs), accuracy).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"q{i}"] for i, c in enumerate(columns)}
