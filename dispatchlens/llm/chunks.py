"""Encoding of texts chunk by chunk, each distinct chunk once in a worker while its cache lasts."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable

#: Chunks kept by a worker before its cache starts anew (about 200 bytes each), and the longest one kept.
CACHE_CHUNKS = 600_000
CACHE_CHARS = 64
_DOUBLED = re.compile(r"\s | \s")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_clear: dict[str, Callable[[], None]] = {}


def keeps(name: str, clear: Callable[[], None]) -> None:
    """Says that this worker keeps something for tasks to come, and how it is given back."""
    _clear[name] = clear


def forget() -> None:
    """Gives back what this worker kept for other steps: Spark's workers live on from one step to the next."""
    if _clear:
        for name in list(_clear):
            _clear.pop(name)()
        gc.collect()  # encoders refer to themselves


class ChunkEncoder:
    """Splits a text at single spaces between other characters; a chunk but the first keeps its space in front.

    encode(list of chunks) gives the bytes of each; the bytes of a text are those of its chunks, joined. That holds for
    tokenizers that never join characters across such a space.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.encode = encode
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[bytes]:
        split = [_BOUNDARY.split(t) if t[:1] == " " or _DOUBLED.search(t) else t.split(" ") for t in texts]
        self._learn(self.first, {c[0] for c in split}, "")
        later, out, lacking = self.later, [], []
        for k, c in enumerate(split):  # one look-up a chunk; a text that lacks one is joined later
            rest = c[1:]
            found = list(map(later.get, rest))
            try:
                out.append(self.first[c[0]] + b"".join(found))
            except TypeError:
                out.append(b"")
                lacking.append((k, rest, found))
        long = self._learn(later, {x for _, rest, found in lacking for x, y in zip(rest, found, strict=True) if y is None}, " ")
        for k, rest, found in lacking:
            out[k] = self.first[split[k][0]] + b"".join([later[x] if y is None else y for x, y in zip(rest, found, strict=True)])
        for c in long:
            del later[c]
        if len(later) > CACHE_CHUNKS:
            later.clear()
        self.first.clear()
        return out

    def _learn(self, cache: dict[str, bytes], chunks: set[str], before: str) -> list[str]:
        missing = [c for c in chunks if c not in cache]
        cache.update(zip(missing, self.encode([before + c for c in missing]), strict=True))
        return [c for c in missing if len(c) > CACHE_CHARS]
