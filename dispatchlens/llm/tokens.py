"""Token ids in a binary file format: one zstandard frame a document, all with one trained dictionary.

The dictionary is trained on the serialized ids of a bounded sample of documents (DICTIONARY_DOCS rows by smallest hash)
and stored beside the segments, as a table of its own (sha256, dictionary); every segment names it by its SHA-256, and a reader needs
nothing but the folder. A segment is one row of a Parquet folder, so that Spark commits whole files and a lost task leaves
nothing behind:

    "TOKS", version u8, bytes an id u8, reserved u16, dictionary sha256 (32 bytes), documents u32,
    validity u8 x n, document id i64 x n, ids u64 x n, offset u64 x (n + 1), frames

All numbers are little-endian. A document is read alone by its offset. Documents stand in ascending order of id, nulls first,
equal ids by a hash of their first characters and then by their text. Null texts are empty and hold the end id alone. Strings of special tokens
in a text are those tokens, as the library has it. Ids must be whole numbers.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens import session
from dispatchlens.llm.chunks import ChunkEncoder

END = 2
DICTIONARY_DOCS = 400
DICTIONARY_BYTES = 65_536
SEGMENT_BYTES = 2_000_000
LEVEL = 3
HEAD = "<4sBBH32sI"
#: Characters of a text that help to deal out rows of one id.
KEY_CHARS = 64
DICTIONARY = "sha256 string, dictionary binary"
SEGMENTS = "part int, seq int, first_start long, n_ids long, segment binary"


@lru_cache(maxsize=1)
def _encoder(path: str) -> tuple["Encoder", int]:
    """The library's byte-level encoder; ids are written in 2 bytes where the vocabulary allows."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    width = 2 if tokenizer.get_vocab_size() <= 65_536 else 4
    code = {2: "H", 4: "I"}[width]

    def whole(texts):
        return [array(code, e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return Encoder(ChunkEncoder(whole), whole, special), width


class Encoder:
    """Texts to bytes of ids; a text that holds a special token's string is encoded by the library as a whole."""

    def __init__(self, chunks: ChunkEncoder, whole, special: list[str]):
        self.chunks, self.whole, self.special = chunks, whole, special

    def texts(self, texts: list[str]) -> list[bytes]:
        marked = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        out = self.chunks.texts([t if k not in marked else "" for k, t in enumerate(texts)] if marked else texts)
        for k, ids in zip(marked, self.whole([texts[k] for k in marked]), strict=True):
            out[k] = ids
        return out


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _dictionary(rows: DataFrame, path: str) -> bytes:
    """Trained on the driver on a bounded sample; empty where there is too little to train on."""
    # the sample is taken by id alone and then read, so that no text is sorted
    picked = rows.select("doc_id").distinct().orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(DICTIONARY_DOCS)
    sample = rows.join(F.broadcast(picked.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).select("text")

    def serialized(batches):
        encoder, width = _encoder(path)
        for batch in _sliced(batches):
            yield pa.RecordBatch.from_pydict({"ids": pa.array(encoder.texts(batch.column(0).to_pylist()), pa.binary())})

    samples = sorted(bytes(r["ids"]) for r in sample.mapInArrow(serialized, "ids binary").limit(2 * DICTIONARY_DOCS).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in samples if s]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write(docs: DataFrame, path: str, end: int = END, folder: str | None = None) -> str:
    """Writes segments and their dictionary, into the shared folder if none is given; returns the folder."""
    if not isinstance(docs.schema["doc_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError("document ids must be whole numbers")
    spark = docs.sparkSession
    folder = folder or session.run_path(spark, f"tokens-{uuid.uuid4().hex}")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    dictionary = _dictionary(rows, path)
    name = hashlib.sha256(dictionary).digest()

    def pack(batches):
        encoder, width = _encoder(path)
        compress = zstandard.ZstdCompressor(level=LEVEL, **_compression(dictionary)).compress
        last = np.array([end], dtype=f"<u{width}").tobytes()
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, held = [], [], [], 0

        def segment():
            n = len(ids)
            head = struct.pack(HEAD, b"TOKS", 1, width, 0, name, n)
            index = (np.array([i is not None for i in ids], "u1").tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes()
                     + np.array(counts, "<u8").tobytes() + np.cumsum([0, *map(len, frames)]).astype("<u8").tobytes())
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "first_start": pa.array([start], pa.int64()),
                                               "n_ids": pa.array([sum(counts)], pa.int64()), "segment": pa.array([head + index + b"".join(frames)], pa.binary())})

        for batch in _sliced(batches):
            for i, raw in zip(batch.column(0).to_pylist(), encoder.texts(batch.column(1).to_pylist()), strict=True):
                raw += last
                ids.append(i)
                counts.append(len(raw) // width)
                frames.append(compress(raw))
                held += len(frames[-1])
                if held >= SEGMENT_BYTES:
                    yield segment()
                    seq, start = seq + 1, start + sum(counts)
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield segment()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.left("text", F.lit(KEY_CHARS)))]  # rows of one id can be many
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    parts.mapInArrow(pack, SEGMENTS).write.parquet(f"{folder}/segments")
    spark.createDataFrame([(name.hex(), bytearray(dictionary))], DICTIONARY).coalesce(1).write.parquet(f"{folder}/dictionary")
    return folder


def opened(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes]:
    """The segments of a folder and the dictionary that stands beside them."""
    row = spark.read.schema(DICTIONARY).parquet(f"{folder}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["sha256"]:
        raise ValueError("the stored dictionary is damaged")
    return spark.read.schema(SEGMENTS).parquet(f"{folder}/segments"), dictionary


def _opened(segment: bytes, dictionary: bytes):
    """(width, ids or None, counts, offsets, where frames begin); refuses a segment of another dictionary."""
    magic, version, width, _, name, n = struct.unpack_from(HEAD, segment)
    if (magic, version) != (b"TOKS", 1) or name != hashlib.sha256(dictionary).digest():
        raise ValueError("not a segment of this dictionary")
    at = struct.calcsize(HEAD)
    valid = np.frombuffer(segment, "u1", n, at)
    ids = np.frombuffer(segment, "<i8", n, at + n)
    counts = np.frombuffer(segment, "<u8", n, at + 9 * n)
    offsets = np.frombuffer(segment, "<u8", n + 1, at + 17 * n)
    return width, [int(i) if v else None for i, v in zip(ids, valid, strict=True)], counts, offsets, at + 17 * n + 8 * (n + 1)


def document(segment: bytes, place: int, dictionary: bytes) -> np.ndarray:
    """The ids of one document, without reading the others."""
    width, _, _, offsets, base = _opened(segment, dictionary)
    frame = segment[base + int(offsets[place]): base + int(offsets[place + 1])]
    return np.frombuffer(zstandard.ZstdDecompressor(**_compression(dictionary)).decompress(frame), f"<u{width}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_bytes) of each document of a folder, from its frame."""
    segments, dictionary = opened(spark, folder)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each partition that was written
    before = totals.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    rows = segments.join(F.broadcast(before), F.col("part") == F.col("_part")).select("segment", (F.col("first_start") + F.col("_before")).alias("start"))

    def unpack(batches):
        decompress = zstandard.ZstdDecompressor(**_compression(dictionary)).decompress
        for batch in batches:
            for segment, start in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                segment = segment.as_py()
                width, ids, counts, offsets, base = _opened(segment, dictionary)
                crc, sizes = [], []
                for k in range(len(ids)):
                    raw = decompress(segment[base + int(offsets[k]): base + int(offsets[k + 1])])
                    own = np.frombuffer(raw, f"<u{width}").astype("<u4")
                    crc.append(zlib.crc32(own.tobytes()))
                    sizes.append(len(own))
                starts = start + np.cumsum([0, *sizes])[:-1]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()),
                                                  "ids_crc32": pa.array(crc, pa.int64()), "n_bytes": pa.array(np.diff(offsets.astype("i8")), pa.int64())})

    return rows.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long, n_bytes long")
