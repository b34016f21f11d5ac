"""Small weighted finite-state transducers over the tropical semiring: weights add along a path, the least path counts."""

from __future__ import annotations

from collections import deque
from collections.abc import Hashable, Iterable
from dataclasses import dataclass, field

NOTHING = float("inf")


@dataclass
class Transducer:
    """Arcs (state, input) -> [(output, weight, state)] and final weights; state 0 is the start."""
    arcs: dict[tuple[Hashable, str], list[tuple[str, float, Hashable]]] = field(default_factory=dict)
    finals: dict[Hashable, float] = field(default_factory=dict)
    start: Hashable = 0

    def arc(self, state, symbol: str, output: str, weight: float, to) -> Transducer:
        self.arcs.setdefault((state, symbol), []).append((output, weight, to))
        return self

    def compose(self, other: Transducer) -> Transducer:
        """What reads as self does and writes what other makes of that; only states that can be reached."""
        out = Transducer(start=(self.start, other.start))
        by_state: dict[Hashable, list] = {}
        for (state, symbol), found in self.arcs.items():
            by_state.setdefault(state, []).append((symbol, found))
        queue, seen = deque([out.start]), {out.start}
        while queue:
            pair = queue.popleft()
            a, b = pair
            if a in self.finals and b in other.finals:
                out.finals[pair] = self.finals[a] + other.finals[b]
            for symbol, found in by_state.get(a, ()):
                for middle, w, to in found:
                    for output, v, then in other.arcs.get((b, middle), ()):
                        out.arc(pair, symbol, output, w + v, (to, then))
                        if (to, then) not in seen:
                            seen.add((to, then))
                            queue.append((to, then))
        return out

    def shortest(self, choices: Iterable[list[tuple[str, float]]]) -> tuple[float, Hashable] | None:
        """(weight, final state) of the least path over an input, each place of which offers symbols with weights of their own
        (an acceptor composed on the way); None without a path."""
        now = {self.start: 0.0}
        for offered in choices:
            then: dict[Hashable, float] = {}
            for state, weight in now.items():
                for symbol, own in offered:
                    for _, w, to in self.arcs.get((state, symbol), ()):
                        total = weight + own + w
                        if total < then.get(to, NOTHING):
                            then[to] = total
            now = then
        ends = [(w + self.finals[s], repr(s), s) for s, w in now.items() if s in self.finals]
        if not ends:
            return None
        weight, _, state = min(ends, key=lambda e: e[:2])
        return weight, state
