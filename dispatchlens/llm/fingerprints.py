"""Document fingerprints by consistent weighted sampling.

A text's weighted terms are its runs of two words (the edges of the text count as words), each with the number of its
occurrences. For every sample k a term has three fixed random numbers, r and c of Gamma(2, 1) and b uniform; with
t = floor(ln(weight) / r + b) it stands at ln(c) - r * (t - b + 1), and the term standing lowest is the sample together with
its t. Two texts draw the same sample with a probability equal to their generalised Jaccard similarity, the sum of the lesser
over the sum of the greater weights. As the lowest value is a function of k, term and t, 16 bits of its hash name the sample:
a fingerprint is SAMPLES such names, and the likeness of two is the share of equal ones.

Words are [^\\x20\\x09-\\x0D]+, A-Z lower-cased. Texts without a word, null ones among them, share one fingerprint, which is like
itself (1) and unlike all others (0). Documents stand in ascending order of id (nulls first), equal ids by a hash of their text and
then the text; rows that repeat are documents of their own, next to each other. The document after the last one is the first; a
single one follows itself. Ids of any type that Spark orders are kept; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm.store import written

SAMPLES = 128
#: Documents taken from a batch at a time, and terms sampled at a time; neither changes a result.
SLICE = 128
TERMS = 32_768
#: Words kept with their hash by a worker before it starts anew.
WORDS = 500_000
NONE = 0xFFFF

_seeded = np.random.default_rng(11)
_LEVELS = 1 << 16


def _gamma_levels() -> np.ndarray:
    """The quantiles of Gamma(2, 1) in the middle of _LEVELS equal shares: its distribution is 1 - (1 + x) exp(-x)."""
    share = (np.arange(_LEVELS) + 0.5) / _LEVELS
    low, high = np.zeros(_LEVELS), np.full(_LEVELS, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = -np.expm1(-middle) - middle * np.exp(-middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


_R = _gamma_levels().astype(np.float32)
_LN_C = np.log(_gamma_levels()).astype(np.float32)
_FACTORS = _seeded.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _seeded.integers(0, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FIRST, _LAST = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"first of a text", b"last of a text"))
_U = np.uint64


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, in this order."""
    x = a * _MIX[0] + b
    x ^= x >> _U(31)
    x *= _MIX[1]
    x ^= x >> _U(29)
    x *= _MIX[2]
    return x ^ (x >> _U(32))


def weighted_terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes of a text and their occurrences; both empty without a word."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(_hashes) > WORDS:
        _hashes.clear()
    ids = np.empty(len(words) + 2, np.uint64)
    ids[0], ids[-1] = _FIRST, _LAST
    ids[1:-1] = list(map(_hashes.__getitem__, words))
    return np.unique(mixed(ids[:-1], ids[1:]), return_counts=True)


def _lowest(terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(samples, groups): the lowest value of each run of terms beginning at starts."""
    out = np.empty((SAMPLES, len(starts)), np.float32)
    heavy = np.flatnonzero(weights > 1)
    ln_weight = np.log(weights[heavy]).astype(np.float32)
    for k in range(SAMPLES):
        x = terms * _FACTORS[k]
        r = _R.take((x >> _U(48)).view(np.int64))
        up = x.astype(np.uint32).astype(np.float32)  # 1 - b
        up *= np.float32(2.0**-32)
        value = _LN_C.take(((x >> _U(32)) & _U(0xFFFF)).view(np.int64))
        if len(heavy):
            rh = r[heavy]
            steps = np.floor(ln_weight / rh + (np.float32(1) - up[heavy]))
            up[heavy] += steps
        value -= r * up
        np.minimum.reduceat(value, starts, out=out[k])
    return out


def sampled(texts: list[str]) -> np.ndarray:
    """(texts, SAMPLES) of 16 bits: the fingerprints."""
    found = [weighted_terms(t) for t in texts]
    lows = np.full((SAMPLES, len(texts)), np.inf, np.float32)
    held, size = [], 0

    def measure():
        starts = np.cumsum([0] + [len(h) for _, h, _ in held])[:-1]
        own = _lowest(np.concatenate([h for _, h, _ in held]), np.concatenate([w for _, _, w in held]), starts)
        for j, (i, _, _) in enumerate(held):
            np.minimum(lows[:, i], own[:, j], out=lows[:, i])

    for i, (terms, weights) in enumerate(found):
        for at in range(0, len(terms), TERMS):
            held.append((i, terms[at:at + TERMS], weights[at:at + TERMS]))
            size += len(held[-1][1])
            if size >= TERMS:
                measure()
                held, size = [], 0
    if held:
        measure()
    bits = np.ascontiguousarray(lows.T).view(np.uint32) * np.uint32(2654435761)
    names = np.minimum(bits >> np.uint32(16), np.uint32(NONE - 1)).astype("<u2")
    names[[len(t) == 0 for t, _ in found]] = NONE
    return names


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=-1)


def edited(text: str, after: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text, or all of it."""
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


def _rows(ids: list, texts: list[str], own: np.ndarray, after: list[str], following: np.ndarray, schema: pa.Schema, part: int) -> pa.RecordBatch:
    made = [edited(t, a) for t, a in zip(texts, after, strict=True)]
    other = sampled(made)
    n = len(ids)
    columns = {
        "kind": ["row"] * n, "part": [part] * n, "doc_id": ids, "text": [None] * n, "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in made], "fingerprint": [x.tobytes() for x in own],
        "edited_fingerprint": [x.tobytes() for x in other], "near_edited": likeness(own, other), "near_next": likeness(own, following)}
    return pa.RecordBatch.from_pydict(columns, schema)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row; fingerprints in hex.

    One shuffle brings the texts into order. Each task handles its run of documents as a stream; the last of a run lacks the
    next one's beginning, so the ends of runs (a row or two a task) are written with the results and matched afterwards.
    """
    id_type = docs.schema[key].dataType
    rows = docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    runs = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    made = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, schema = TaskContext.get().partitionId(), None, None

        def end(kind, i, t, print_):
            blank = dict.fromkeys(schema.names, [None])
            return pa.RecordBatch.from_pydict(blank | {"kind": [kind], "part": [part], "doc_id": [i], "text": [t], "fingerprint": [print_.tobytes()]}, schema)

        for batch in batches:
            if schema is None:
                kinds = {"kind": pa.string(), "part": pa.int32(), "doc_id": batch.schema.field("doc_id").type, "text": pa.string(), "n_chars": pa.int64(), "edited_sha256": pa.string(),
                         "fingerprint": pa.binary(), "edited_fingerprint": pa.binary(), "near_edited": pa.float64(), "near_next": pa.float64()}
                schema = pa.schema(list(kinds.items()))
            for at in range(0, batch.num_rows, SLICE):
                ids, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                own = sampled(texts)
                if held is None:
                    yield end("head", ids[0], texts[0], own[0])
                else:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], np.vstack([held[2][None], own])
                if len(ids) > 1:
                    yield _rows(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:], schema, part)
                held = ids[-1], texts[-1], own[-1]
        if held is not None:
            yield end("tail", *held)

    table = written(runs.mapInArrow(measured, made), "fingerprints")
    heads = table.where("kind = 'head'").select(F.col("part").alias("_next"), F.col("text").alias("after"), F.col("fingerprint").alias("following"))
    # One number for each task that had rows.
    parts = sorted(r["_next"] for r in heads.select("_next").collect())
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "_part int, _then int")
    tails = table.where("kind = 'tail'").select("part", "doc_id", "text", "fingerprint").join(F.broadcast(after), F.col("part") == F.col("_part"))
    tails = tails.join(heads, F.col("_then") == F.col("_next")).select("doc_id", "text", "fingerprint", "after", "following")

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                                ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
            for at in range(0, batch.num_rows, SLICE):
                ids, texts, own, then, following = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                own, following = (np.frombuffer(b"".join(x), "<u2").reshape(len(x), SAMPLES) for x in (own, following))
                full = pa.schema([("kind", pa.string()), ("part", pa.int32()), schema.field("doc_id"), ("text", pa.string()), *list(schema)[1:]])
                yield _rows(ids, texts, own, then, following, full, 0).select(schema.names)

    columns = made.fieldNames()[2:3] + made.fieldNames()[4:]
    ends = tails.mapInArrow(finished, T.StructType([made[c] for c in columns]))
    whole = table.where("kind = 'row'").select(*columns).unionByName(ends)
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return whole.withColumns(hexed)
