"""Words of many texts at once, as places in one buffer of bytes.

A word is a run of digits, letters and all characters above ASCII; A-Z are lower-cased. On UTF-8 this is a matter of single bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0"):ord("9") + 1] = _IN_WORD[ord("a"):ord("z") + 1] = _IN_WORD[0x80:] = True


class Words:
    """The words of several texts in one buffer, lower-cased, one space between words, so that a run of words is a slice."""

    def __init__(self, texts: list[bytes]):
        raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        inside = _IN_WORD[raw]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        # a byte after a word becomes the space behind it; all other bytes between words go
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        raw[~inside] = 32
        self.bytes = raw[keep].tobytes() + bytes(8)
        held = inside[keep]
        before = np.concatenate(([False], held[:-1])) if len(held) else held
        self.starts = np.flatnonzero(held & ~before)
        self.stops = np.flatnonzero(~held & before)
        # words of each text: those that begin before its end
        kept_upto = np.concatenate(([0], np.cumsum(keep)))[text_ends] if len(texts) else text_ends
        self.first = np.concatenate(([0], np.searchsorted(self.starts, kept_upto))).astype(np.int64)

    def runs(self, low: int, high: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, stop, first word) of all runs of up to `longest` words that begin at words low to high and stay in their text."""
        at = np.arange(low, high)
        last = self.first[np.searchsorted(self.first, at, "right")]
        begin, end, word = [], [], []
        for n in range(1, longest + 1):
            own = at[at + n <= last]
            begin.append(self.starts[own])
            end.append(self.stops[own + n - 1])
            word.append(own)
        return np.concatenate(begin), np.concatenate(end), np.concatenate(word)


def sliced(batches: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts, the last column, have about so many bytes; a longer text is a slice alone."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto
