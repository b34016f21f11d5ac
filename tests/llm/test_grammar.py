"""The composed toxicity grammar against paths enumerated by hand, and whole clauses."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import toxicity
from dispatchlens.llm.queries import op10_toxicity
from dispatchlens.llm.wfst import Transducer

WEIGHTS = {"fool": 4.0, "brute*": 3.0, "kill": 1.0}
CONTEXTS = {"target": 0.7, "negated": -2.0, "reported": -1.5}
GRAMMAR = toxicity.compiled(CONTEXTS)


def by_hand(clause):
    """The best choice of the mark, from the definition."""
    words = toxicity.WORD.findall(clause.lower())
    best = None
    for k, w in enumerate(words):
        weight = max((v for key, v in WEIGHTS.items() if w == key or key[-1] == "*" and w.startswith(key[:-1])), default=None)
        if weight is None:
            continue
        others = words[:k] + words[k + 1:]
        flags = (any(x in toxicity.TARGETS for x in others), any(x in toxicity.NEGATIONS for x in words[max(0, k - toxicity.REACH):k]),
                 any(x in toxicity.REPORTS for x in words[:k]))
        total = weight + sum(CONTEXTS[c] for c, on in zip(toxicity.CONTEXTS, flags) if on)
        best = total if best is None else max(best, total)
    return best


VOCABULARY = ["fool", "brutes", "kill", "you", "not", "said", "tree", "stone", "never"]


@pytest.mark.parametrize("seed", range(4))
def test_shortest_paths_are_the_best_choices(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        clauses = [" ".join(rng.choice(VOCABULARY, rng.integers(1, 9))) for _ in range(rng.integers(1, 4))]
        got = sorted(round(s, 9) for s, _ in toxicity.matches("Intro words. " + "; ".join(clauses) + "!", WEIGHTS, GRAMMAR))
        assert got == sorted(round(x, 9) for c in clauses if (x := by_hand(c)) is not None)


def test_a_report_counts_over_any_distance():
    """No limit of characters: ninety words between the report and the threat."""
    text = "he said " + "word " * 90 + "kill"
    assert toxicity.matches(text, WEIGHTS, GRAMMAR)[0][1] == ("target", "reported")
    assert toxicity.matches("he said: " + "word " * 90 + "kill", WEIGHTS, GRAMMAR)[0][1] == ()
    assert len(toxicity.matches("x " * 50_000 + "fool " + "y " * 50_000 + "you", WEIGHTS, GRAMMAR)) == 1


def test_each_transducer_has_its_say():
    flags = {c: toxicity.matches(t, WEIGHTS, GRAMMAR)[0] for c, t in {"plain": "fool tree", "target": "tree fool you", "negated": "not a fool", "far": "not one tree or stone fool", "reported": "said fool"}.items()}
    assert flags["plain"] == (4.0, ()) and flags["far"] == (4.0, ())
    assert flags["target"] == (4.7, ("target",)) and flags["negated"] == (2.0, ("negated",)) and flags["reported"] == (2.5, ("reported",))
    # the mark is chosen where it costs least: the second word isn't negated
    assert toxicity.matches("not fool tree stone tree brute", WEIGHTS, GRAMMAR)[0] == (3.0, ())
    assert toxicity.matches("fool", {}, GRAMMAR) == [] and toxicity.matches("", WEIGHTS, GRAMMAR) == []


def test_composition_is_what_two_steps_give():
    rng = np.random.default_rng(1)

    def random_transducer():
        t = Transducer(finals={0: 0.5, 2: 0.0})
        for s, x in itertools.product(range(3), "ab"):
            for _ in range(rng.integers(0, 3)):
                t.arc(s, x, str(rng.choice(list("ab"))), float(rng.integers(0, 9)), int(rng.integers(0, 3)))
        return t

    def paths(t, word):
        """All (weight, output) of a word."""
        found = [(0.0, t.start, "")]
        for x in word:
            found = [(w + v, to, out + y) for w, s, out in found for y, v, to in t.arcs.get((s, x), ())]
        return [(w + t.finals[s], out) for w, s, out in found if s in t.finals]

    for _ in range(30):
        one, two = random_transducer(), random_transducer()
        for word in map("".join, itertools.product("ab", repeat=3)):
            want = min((w + v for w, out in paths(one, word) for v, _ in paths(two, out)), default=None)
            got = one.compose(two).shortest([[(x, 0.0)] for x in word])
            assert (None if got is None else got[0]) == want


def test_query_finds_held_out_toxic_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in op10_toxicity(spark, sf_dir).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    toxic, clean = [p for y, p in held if y == 1], [p for y, p in held if y == 0]
    assert len(got) == 10_000 and all(0 <= r["score"] <= 1 and math.isfinite(r["score"]) for r in got.values())
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.03


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels, F.col("doc_id") < 0)
    assert toxicity.score(docs, grammar).collect() == []
    assert 0 <= toxicity.probability("kill you", grammar) <= 1
