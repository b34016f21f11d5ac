"""Importance resampling of documents towards a target set, by hashed n-grams.

Features are all runs of 1 to 3 consecutive words, joined by one space, repeats counted; a feature's bucket is its crc32 modulo
BUCKETS. A bucket's gain compares its share among the target texts with its share among the documents; a document's weight
sums the gains of its features, a Gumbel number drawn from its id is added, and the highest scores are drawn.

N-grams of a batch are interned in an open-addressed table (`Interned`): the keys are their xxhash64, a match is confirmed byte by
byte, every slot stores its bucket and count. An occurrence keeps its slot id alone, so the crc32 is taken once for each
distinct n-gram of the batch and buckets are gathered by slot. Gains are known only when the buckets of all documents are
counted; so that no text is interned twice, a document's buckets are written (`packed`, about a byte for each occurrence), counted,
and read again to gather their gains. Only bucket counts (BUCKETS for each task) are shuffled, and then the narrow scores of
documents long enough to be drawn.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lower-cased; null texts have none. A null id has no Gumbel number:
score and rank are null, it isn't drawn and doesn't count among those to draw from. Rows that repeat are documents of their own; ties in score go
to the smaller id. An empty table gives no rows; without target texts all gains compare with an empty target.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.functions.quantiles import bucketed
from dispatchlens.llm.bytewords import Words, sliced
from dispatchlens.llm.store import written

BUCKETS = 10_000
LONGEST = 3
#: Words of a batch that are interned at a time (runs that begin among them); bounds a task's memory, changes no result.
WORDS = 3_000
#: Scores ranked by one task.
RANKED_ROWS = 200_000

class Interned:
    """Distinct byte strings of a buffer in an open-addressed table of arrays.

    `slot` gives each occurrence its slot; `bucket` and `count` are stored by slot. A slot holds the occurrence that claimed it; another
    belongs there only if its 64-bit key, its length and all its bytes are the same, else it goes on to the next slot.
    """

    def __init__(self, data: bytes, begin: np.ndarray, end: np.ndarray, key=xxhash.xxh64_digest):
        n = len(begin)
        self.size = 1 << max(4, (2 * n - 1).bit_length())
        mask = self.size - 1
        strings = [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        keys = np.frombuffer(b"".join(map(key, strings)), ">u8").astype(np.uint64)
        length = end - begin
        self.words = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))  # the 8 bytes from each place
        owner = np.full(self.size, -1, np.int64)
        self.slot = (keys & np.uint64(mask)).astype(np.int64)  # where it looks now, and in the end its slot
        left = np.arange(n)
        while len(left):
            here = self.slot[left]
            holder = owner[here]
            free = holder < 0
            owner[here[free]] = left[free]  # one of those that claim a slot gets it
            holder = owner[here]
            rest = np.flatnonzero(holder != left)  # the others got theirs
            left, holder = left[rest], holder[rest]
            same = (keys[holder] == keys[left]) & (length[holder] == length[left])
            maybe = np.flatnonzero(same)
            same[maybe] = self._equal(begin[left[maybe]], begin[holder[maybe]], length[left[maybe]])
            left = left[~same]
            self.slot[left] = (self.slot[left] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(self.size, np.int64)
        self.bucket[used] = np.fromiter(map(zlib.crc32, map(strings.__getitem__, owner[used].tolist())), np.int64, len(used)) % BUCKETS
        self.count = np.bincount(self.slot, minlength=self.size)

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the bytes from places a and b on are the same, eight at a time."""
        out = np.ones(len(a), bool)
        left, at = np.arange(len(a)), 0
        while len(left):
            rest = length[left] - at
            difference = self.words[a[left] + at] ^ self.words[b[left] + at]
            short = np.flatnonzero(rest < 8)
            difference[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            equal = difference == 0
            out[left[~equal]] = False
            at += 8
            left = left[equal & (rest > 8)]
        return out


def _interned(words: Words) -> Iterator[tuple[Interned, np.ndarray, slice]]:
    """The table of each stretch of words, the word of the stretch where each occurrence begins, and the stretch."""
    for low in range(0, len(words.starts), WORDS):
        begin, end, word = words.runs(low, min(low + WORDS, len(words.starts)), LONGEST)
        yield Interned(words.bytes, begin, end), word - low, slice(low, min(low + WORDS, len(words.starts)))


def packed(owner: np.ndarray, bucket: np.ndarray, n: int) -> list[bytes]:
    """The sorted buckets of each of n texts as gaps, a byte each; 255 stands for a gap of 255 that goes on in the next byte."""
    order = np.sort(owner * BUCKETS + bucket)
    owner, bucket = order // BUCKETS, order % BUCKETS
    gap = np.diff(bucket, prepend=0)
    fresh = np.flatnonzero(np.diff(owner, prepend=-1))
    gap[fresh] = bucket[fresh]
    size = gap // 255 + 1
    out = np.full(size.sum(), 255, np.uint8)
    out[np.cumsum(size) - 1] = gap % 255
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, size, n)))).astype(np.int64).tolist()
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def unpacked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each occurrence."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    upto = np.cumsum(raw, dtype=np.int64)
    starts = np.concatenate(([0], upto))[np.cumsum(sizes) - sizes]
    ends = raw != 255
    return owner[ends], (upto - starts[owner])[ends]


def bucketed_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, n_words, buckets) of rows (doc_id, text)."""
    def run(batches):
        for batch in sliced(batches):
            words = Words([x.encode() for x in batch.column(1).to_pylist()])
            n_words = np.diff(words.first)
            text = np.repeat(np.arange(batch.num_rows), n_words)
            # an occurrence gets its bucket by slot, and its text by the word where it begins
            found = [(text[stretch][word], table.bucket[table.slot]) for table, word, stretch in _interned(words)]
            owner, bucket = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": pa.array(n_words, pa.int64()),
                                              "buckets": pa.array(packed(owner, bucket, batch.num_rows), pa.binary())})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, buckets binary")


def _keyed(frame: DataFrame, key: str, text: str) -> DataFrame:
    return frame.select(frame[key].alias("doc_id"), F.coalesce(frame[text].cast("string"), F.lit("")).alias("text"))


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all rows of bucketed_texts() by bucket."""
    def counted(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in sliced(batches):
            total += np.bincount(unpacked(batch.column(0).to_pylist())[1], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int32()), "n": pa.array(total[found], pa.int64())})

    sums = texts.select("buckets").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket."""
    all_source, all_target = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_source + BUCKETS) / ((s + 1) * (all_target + BUCKETS))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def gumbel(doc_id, seed: int) -> int | None:
    if doc_id is None:
        return None
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(texts: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of bucketed_texts()."""
    def measured(batches):
        for batch in sliced(batches):
            n = batch.num_rows
            owner, bucket = unpacked(batch.column(2).to_pylist())
            upto = np.concatenate(([0], np.cumsum(gain[bucket])))
            edges = np.searchsorted(owner, np.arange(n + 1))
            weight = upto[edges[1:]] - upto[edges[:-1]]
            noise = [gumbel(i, seed) for i in batch.column(0).to_pylist()]
            score = [None if g is None else int(w) + g for w, g in zip(weight, noise, strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": batch.column(1), "n_features": pa.array(np.diff(edges), pa.int64()),
                                              "weight": pa.array(weight, pa.int64()), "score": pa.array(score, pa.int64())})

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(measured, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def drawn(scored: DataFrame, least_words: int, percent: int, rows_per_task: int = RANKED_ROWS) -> DataFrame:
    """All rows with `rank`: 1, 2, 3... for the highest floor(percent * N / 100) scores among the N rows of enough words.

    Scores are cut into ranges of about equal size; a range's first rank follows from the sizes of those above, so that no task ranks
    all rows, and ranges wholly below the last rank aren't ranked at all.
    """
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    rows = scored.where(able)
    n = rows.count()
    wanted = percent * n // 100
    ranges = -(-n // rows_per_task)
    cuts = []
    if ranges > 1:
        probs = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(map(float, rows.agg(F.percentile_approx("score", probs, max(10_000, 4 * ranges))).first()[0])))
    cut = bucketed(scored.withColumn("_score", F.col("score").cast("double")), {"_score": cuts} if cuts else {}, "_range")
    cut = cut.withColumn("_range", F.when(able, F.col("_range_score").cast("int") if cuts else F.lit(0)))
    sizes = cut.where("_range IS NOT NULL").groupBy("_range").agg(F.count("*").alias("n"))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    sizes = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_above")).where(F.col("_above") < wanted)
    placed = cut.join(F.broadcast(sizes), F.col("_range") == F.col("_of"), "left")
    columns = [c for c in scored.columns if c != "n_words"]
    inside = Window.partitionBy("_range").orderBy(F.desc("score"), "doc_id")
    ranked = placed.where("_of IS NOT NULL").select(*columns, (F.row_number().over(inside) + F.col("_above")).cast("long").alias("rank"))
    rest = placed.where("_of IS NULL").select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, least_words: int = 20, percent: int = 5, seed: int = 42,
              key: str = "doc_id", target_key: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    texts = written(bucketed_texts(_keyed(docs, key, text)), "buckets")
    gain = gains(bucket_counts(texts), bucket_counts(bucketed_texts(_keyed(target, target_key, text))))
    return drawn(written(weighted(texts, gain, seed), "weighted"), least_words, percent)
