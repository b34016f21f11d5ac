"""SentencePiece encoding and decoding as a weighted transducer.

The normaliser (a mark in front, spaces to marks), the pieces and the byte fallback are compiled to weighted arcs once. The
model merges by score, which a sum of piece weights alone can't reproduce; so the piece arcs are composed with an acceptor of
neighbours: two pieces may follow each other if merging their own characters gives back just these two. A
sequence whose neighbours all pass is the model's own segmentation. An input is composed with both, and its ids are the
shortest path in the tropical semiring, where a piece weighs what its score lacks to the best one and a byte arc, open only to
a character without a piece, more than any piece. No piece crosses from another character to a mark, so the
path of a text is that of its words, joined. Null texts are empty and have no ids.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.chunks import CACHE_CHARS, ChunkEncoder, keeps

MARK = "▁"
#: Answers of the acceptor that a worker keeps before it starts anew.
ACCEPTED_PAIRS = 400_000
#: Parts of words kept with their ids likewise.
KNOWN_PARTS = 400_000
NOTHING = float("inf")


class Transducer:
    """Arcs of a model file: pieces by their characters, bytes by their values."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        best = max(model.get_score(i) for i in normal)
        self.arcs = {self.pieces[i]: (best - model.get_score(i), i) for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_weight = max(w for w, _ in self.arcs.values()) + 1.0
        self.longest = max(map(len, self.arcs))
        if any(MARK in p.lstrip(MARK) for p in self.arcs):
            raise ValueError("a piece crosses from a word to a mark; words can't be encoded apart")
        self.plain = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.plain[i] = bytes([value])
        # lengths of the pieces by their last three characters (or two, if there are no more), descending, so that few spans are looked up
        lengths: dict[str, set[int]] = {}
        for p in self.arcs:
            if len(p) > 1:
                lengths.setdefault(p[-3:], set()).add(len(p))
        self.lengths = {c: sorted(n | lengths.get(c[-2:], set()), reverse=True) for c, n in lengths.items()}
        self.joined = {pair for p in self.arcs for pair in zip(p, p[1:], strict=False)}
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.accepted: dict[tuple[str, str], bool] = {}

    def parted(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes the piece last; none for a character, or if merging never gives the piece."""
        if piece not in self.parts:
            parts, halves = list(piece), None
            while len(parts) > 1:
                weight, at = min((self.arcs.get(a + b, (NOTHING,))[0], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if weight == NOTHING:
                    break
                halves = parts[at], parts[at + 1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.parts[piece] = halves if len(parts) == 1 else None
        return self.parts[piece]

    def follows(self, left: str, right: str) -> bool:
        """Whether the acceptor lets right follow left; left is empty at the start and after a byte.

        Merges are undone backwards in time from both pieces. If at some time what touches from both sides would have merged
        before the merge undone last, the two are not what merging gives. At equal weight the merge further left comes first.
        """
        key = (left, right)
        found = self.accepted.get(key)
        if found is None:
            if len(self.accepted) >= ACCEPTED_PAIRS:
                self.accepted.clear()
            found = self.accepted[key] = self._apart(left, right)
        return found

    def _apart(self, left: str, right: str) -> bool:
        if len(right) > 1 and self.parted(right) is None:
            return False
        if not left:
            return True
        undone = (NOTHING, 0)
        while True:
            arc = self.arcs.get(left + right)
            if arc is not None and (arc[0], 0) < undone:
                return False
            a, b = self.parted(left), self.parted(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and self.arcs[left][0] > self.arcs[right][0]:
                undone, left = (self.arcs[left][0], 0), a[1]
            else:
                undone, right = (self.arcs[right][0], 1), b[0]

    def path(self, text: str) -> list[int]:
        """Ids of the shortest path over normalised characters."""
        return next(self.paths([text]))

    def paths(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each text's shortest path. What a text has in common with the start of the one before is composed once, so that
        sorted texts cost least."""
        best, last, back, before = [0.0], [""], [(0, ())], ""
        arcs, lengths, accepted, follows = self.arcs, self.lengths, self.accepted, self.follows
        for text in texts:
            common = 0
            for a, b in zip(text, before, strict=False):
                if a != b:
                    break
                common += 1
            del best[common + 1:], last[common + 1:], back[common + 1:]
            before = text
            for end in range(common + 1, len(text) + 1):
                char = text[end - 1]
                # no other neighbour passes once one has: a prefix has one segmentation
                sizes = lengths.get(text[end - 3:end]) if end > 2 else None
                for size in sizes or (lengths.get(text[end - 2:end], ()) if end > 1 else ()):
                    start = end - size
                    if start < 0:
                        continue
                    found = text[start:end]
                    arc = arcs.get(found)
                    if arc is None:
                        continue
                    key = (last[start], found)
                    if accepted[key] if key in accepted else follows(*key):
                        best.append(best[start] + arc[0])
                        last.append(found)
                        back.append((start, (arc[1],)))
                        break
                else:
                    arc = arcs.get(char)
                    if arc is None:
                        value = char.encode("utf-8", "surrogatepass")
                        arc, char = (self.byte_weight * len(value), *(self.bytes[b] for b in value)), ""
                    best.append(best[end - 1] + arc[0])
                    last.append(char)
                    back.append((end - 1, arc[1:]))
            out: list[int] = []
            at = len(text)
            while at:
                at, ids = back[at]
                out.extend(reversed(ids))
            yield out[::-1]

    def parts_of(self, text: str) -> list[str]:
        """The text cut wherever no piece joins two neighbouring characters; its path is that of the parts, joined."""
        if self.joined.issuperset(zip(text, text[1:], strict=False)):
            return [text]
        cuts = [k for k, pair in enumerate(zip(text, text[1:], strict=False), 1) if pair not in self.joined]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def decode(self, ids) -> str:
        plain = self.plain
        return b"".join([plain[i] for i in ids])[1:].decode("utf-8", "replace")


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _given_back() -> None:
    _encoder.cache_clear()
    transducer.cache_clear()


@lru_cache(maxsize=1)
def _encoder(path: str) -> ChunkEncoder:
    keeps("pieces", _given_back)
    model = transducer(path)
    known: dict[str, bytes] = {}

    def encode(chunks):
        if len(known) > KNOWN_PARTS:
            known.clear()
        parts = [model.parts_of(c.replace(" ", MARK)) for c in chunks]
        missing = sorted({p for own in parts for p in own if p not in known})
        known.update(zip(missing, (array("I", ids).tobytes() for ids in model.paths(missing)), strict=True))
        yield from (b"".join([known[p] for p in own]) for own in parts)
        for p in missing:
            if len(p) > CACHE_CHARS:
                del known[p]

    encoder = ChunkEncoder(encode)
    learn = encoder._learn
    encoder._learn = lambda cache, found, before: learn(cache, found, before or MARK)  # the first chunk has the mark in front
    return encoder


def _ids(texts: list[str], path: str) -> list[np.ndarray]:
    out = [np.frombuffer(x if t else b"", "<u4") for t, x in zip(texts, _encoder(path).texts(["" if MARK in t else t for t in texts]), strict=True)]
    for k, t in enumerate(texts):
        if MARK in t:  # marks of its own may join with those of spaces
            out[k] = np.array(transducer(path).path(MARK + t.replace(" ", MARK)), "<u4")
    return out


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def _batches(batches, rows: int = 500):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    rows = _rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in _batches(batches):
            ids = _ids(batch.column(1).to_pylist(), path)
            offsets = np.cumsum([0, *map(len, ids)]).astype("i4")
            values = np.concatenate([*ids, np.empty(0, "<u4")]).astype("i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); ids of control pieces give their names."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = transducer(path)
        for batch in _batches(batches):
            texts = [model.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, n_byte_tokens, ids_crc32, round_trip): of encode(), and whether decode() of it gives the text back.

    Encoding and decoding run in one task, so that ids never leave it. A mark in the text itself decodes to a space.
    """
    rows = _rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = transducer(path)
        is_byte = np.zeros(len(model.pieces), bool)
        is_byte[list(model.bytes.values())] = True
        for batch in _batches(batches):
            texts = batch.column(1).to_pylist()
            ids = _ids(texts, path)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                pa.array([model.decode(x.tolist()) == t.replace(MARK, " ") for x, t in zip(ids, texts, strict=True)], pa.bool_()),
            ], ["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean")
