"""Toxicity by a weighted pattern grammar over clauses.

A clause is read as symbols: insult and threat (words and word beginnings with learned weights, found by an Aho-Corasick
automaton), target, negation, report, and other words. Each part of the grammar is a weighted transducer over these symbols: the
matcher takes one insult or threat of the clause and marks it, the target, negation and report transducers change the weight of the mark by
what stands around it: a target anywhere in the clause, a negation up to REACH words before the mark, a report anywhere
before it. They are composed to one transducer, and a clause's score is its shortest path in the tropical semiring over all choices
of the mark; a clause without an insult or threat has no path. Clauses combine to a document by the best one and the logarithm of their number.

Learned: word weights as log odds of the label, by counting on labelled documents with enough support; the weights of the three contexts by
counting the contexts of the best clause of each document. The labelled documents used are bounded by FIT_DOCS (those of smallest
hash). Clauses end at . ! ? ; : and line ends, whatever their length. Empty and null texts have no path and get the rate of documents without
one. Words are runs of letters, lower-cased. Rows that repeat get equal scores; of copies of a labelled text one counts, toxic if any is.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.store import written
from dispatchlens.llm.wfst import Transducer

FIT_DOCS = 20_000
#: Lengths of word beginnings learned; different toxic texts needed, at least and as a share of all; least log odds.
BEGINNINGS = (4, 5, 6)
SUPPORT = 6
SUPPORT_SHARE = 0.015
LEAST_ODDS = 3.0
#: Different pairs of neighbours needed, as a share of the toxic texts that hold the word.
SPREAD = 0.7
WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")
#: Fixed word lists of the grammar's other automata, in the four languages of the texts.
THREATS = ("kill", "hurt", "destroy", "töten", "schlagen", "sterben", "tuer", "frapper", "mourir", "matar", "golpear", "morir")
TARGETS = ("you", "your", "he", "she", "they", "them", "him", "her", "this", "that", "these", "those", "people", "du", "dich", "sie", "ihr", "er", "tu", "toi", "vous", "il", "elle", "ils", "usted", "ustedes", "él", "ella", "ellos")
NEGATIONS = ("not", "never", "no", "nobody", "without", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "sans", "nunca", "sin", "ningún")
REPORTS = ("said", "says", "called", "wrote", "quoted", "according", "sagte", "schrieb", "nannte", "dit", "écrit", "selon", "dijo", "escribió", "según")
PRIOR = 8.0
#: Words up to which a negation reaches.
REACH = 3
#: Contexts of a mark, in the order of the composition.
CONTEXTS = ("target", "negated", "reported")
SYMBOLS = ("insult", "target", "negation", "report", "other")


def _lower(text: str) -> str:
    return text.lower()


def _fold(number: int, name: str = "doc_id"):
    return F.crc32(F.col(name).cast("string").cast("binary")) % number


def fit(docs: DataFrame, labels: DataFrame, held_out) -> dict:
    """The grammar's weights, from labelled documents for which held_out (a column over doc_id) is false."""
    train = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    train = train.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    train = F.broadcast(train.select(F.col("doc_id").alias("_id"), "toxic"))
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = rows.join(train, F.col("doc_id") == F.col("_id")).groupBy("text").agg(F.max("toxic").alias("toxic"))  # a text counts once

    def words(batches):
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(WORD.findall(_lower(text or "")))
                begins = {w[:n] + "*" for w in own for n in BEGINNINGS if len(w) >= n}
                seen[toxic].update(own)
                seen[toxic].update(begins)
                seen[toxic][""] += 1
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.string()), "clean": pa.array([seen[0][k] for k in keys], pa.int64()), "toxic": pa.array([seen[1][k] for k in keys], pa.int64())})

    counts = rows.mapInArrow(words, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = written(counts, "counts")
    whole = counts.where("feature = ''").first()
    totals = (whole["clean"], whole["toxic"]) if whole else (0, 0)
    base = math.log((totals[1] + 0.5) / (totals[0] + 0.5))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - F.lit(base)
    enough = (F.col("toxic") >= max(SUPPORT, SUPPORT_SHARE * totals[1])) & (odds >= LEAST_ODDS) & (F.col("feature") != "")
    # a document has few words that a given share of all toxic ones have
    kept, support = {}, {}
    for r in counts.where(enough).select("feature", odds.alias("w"), "toxic").collect():
        kept[r["feature"]], support[r["feature"]] = r["w"], r["toxic"]
    rate = (totals[1] + 0.5) / (sum(totals) + 1)
    threats = {r["feature"]: math.log((r["toxic"] + PRIOR * rate) / (r["clean"] + PRIOR * (1 - rate))) - base for r in counts.where(F.col("feature").isin(*THREATS)).collect()}

    def contexts(batches):
        for batch in batches:
            found = {x for text in batch.column(0).to_pylist() for x in _neighbours(text or "", kept)}
            yield pa.RecordBatch.from_pydict({"feature": pa.array([f for f, _ in found], pa.string()), "context": pa.array([c for _, c in found], pa.string())})

    # near copies of one toxic text repeat its words among the same neighbours; an insult stands among many
    spread = rows.where("toxic = 1").mapInArrow(contexts, "feature string, context string").groupBy("feature").agg(F.count_distinct("context").alias("n")).collect() if kept else []
    kept = {r["feature"]: kept[r["feature"]] for r in spread if r["n"] >= SPREAD * support[r["feature"]]}
    # a shorter beginning speaks for the longer ones and the words below it
    kept = {k: w for k, w in kept.items() if not any(k[:n] + "*" in kept for n in BEGINNINGS if n < len(k.rstrip("*")) or n == len(k.rstrip("*")) and k[-1] != "*")}
    for w in THREATS:  # those that no labelled text has weigh nothing
        kept.setdefault(w, threats.get(w, 0.0))
    plain = compiled(dict.fromkeys(CONTEXTS, 0.0))

    def states(batches):
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = matches(text or "", kept, plain)
                best = max(found)[1] if found else ()
                for key in ("match", *best) if found else ("none",):
                    seen[toxic][key] += 1
            keys = ["none", "match", *CONTEXTS]
            yield pa.RecordBatch.from_pydict({"state": pa.array(keys), "clean": pa.array([seen[0][k] for k in keys], pa.int64()), "toxic": pa.array([seen[1][k] for k in keys], pa.int64())})

    by_state = {r["state"]: (r["clean"], r["toxic"]) for r in rows.mapInArrow(states, "state string, clean long, toxic long").groupBy("state").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect()}
    clean, toxic = by_state.get("match", (0, 0))
    share = (toxic + 0.5) / (clean + toxic + 1)
    matched = math.log(share / (1 - share))

    def weight(state):  # a context leans to the share of all matches until it has its own counts
        c, t = by_state.get(state, (0, 0))
        return math.log((t + PRIOR * share) / (c + PRIOR * (1 - share))) - matched

    none = by_state.get("none", (0, 0))
    return {"words": kept, "contexts": {k: weight(k) for k in CONTEXTS}, "match": matched, "none": math.log((none[1] + 0.5) / (none[0] + 10.0)),
            "centre": sorted(kept.values())[len(kept) // 2] if kept else 0.0}


def compiled(contexts: dict[str, float]) -> Transducer:
    """The composed grammar; weights are negative log odds. A final state is (((matched, target), negation), report)."""
    match = Transducer(finals={1: 0.0})
    target = Transducer(finals={0: 0.0, 1: -contexts["target"]})
    negation = Transducer(finals={**{k: 0.0 for k in range(REACH + 1)}, "negated": -contexts["negated"]})
    report = Transducer(finals={0: 0.0, 1: 0.0, "reported": -contexts["reported"]})
    for x in SYMBOLS:
        for state in (0, 1):
            match.arc(state, x, x, 0.0, state)  # an insult may also be passed over
            target.arc(state, x, x, 0.0, 1 if x == "target" else state)
        for k in range(REACH + 1):
            negation.arc(k, x, x, 0.0, REACH if x == "negation" else max(0, k - 1))
        negation.arc("negated", x, x, 0.0, "negated")
        for state in (0, 1):
            report.arc(state, x, x, 0.0, 1 if x == "report" else state)
        report.arc("reported", x, x, 0.0, "reported")
    match.arc(0, "mark", "mark", 0.0, 1)
    for state in (0, 1):
        target.arc(state, "mark", "mark", 0.0, state)
    for k in range(REACH + 1):
        negation.arc(k, "mark", "mark", 0.0, "negated" if k else 0)
    report.arc(0, "mark", "mark", 0.0, 0).arc(1, "mark", "mark", 0.0, "reported")
    return match.compose(target).compose(negation).compose(report)


def contexts_of(state) -> tuple[str, ...]:
    (((_, target), negation), report) = state
    return tuple(c for c, on in zip(CONTEXTS, (target == 1, negation == "negated", report == "reported"), strict=True) if on)


@lru_cache(maxsize=4)
def _automaton(keys: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for k in sorted(keys, reverse=True):  # of "word" and "word*", the beginning is kept
        found.add_word(k.rstrip("*"), (len(k.rstrip("*")), k))
    found.make_automaton()
    return found


def _found(low: str, weights: dict[str, float]):
    """(start, stop, key) of the learned words and beginnings in a lower-cased text, at word limits."""
    for last, (size, key) in _automaton(tuple(weights)).iter(low):
        start, stop = last - size + 1, last + 1
        if not (start and low[start - 1].isalpha()) and (key[-1] == "*" or not (stop < len(low) and low[stop].isalpha())):
            yield start, stop, key


def _neighbours(text: str, weights: dict[str, float]):
    """(key, the words before and behind it), for each found key."""
    low = _lower(text)
    if weights:
        for start, stop, key in _found(low, weights):
            while key[-1] == "*" and stop < len(low) and low[stop].isalpha():
                stop += 1
            yield key, f"{_next(low, start - 1, -1)} | {_next(low, stop, 1)}"


def _next(low: str, at: int, step: int) -> str:
    """The next run of characters other than spaces from a place on, forwards or backwards."""
    while 0 <= at < len(low) and low[at].isspace():
        at += step
    end = at
    while 0 <= end < len(low) and not low[end].isspace():
        end += step
    return low[at:end] if step > 0 else low[end + 1:at + 1]


def _symbols(clause: str, begins: int, found: dict[int, float]):
    """What each word of a clause offers the grammar; a found word may be the mark, at its weight, or be passed over."""
    for m in WORD.finditer(clause):
        word = m[0]
        symbol = "negation" if word in NEGATIONS else "report" if word in REPORTS else "target" if word in TARGETS else "other"
        weight = found.get(begins + m.start())
        yield [(symbol, 0.0)] if weight is None else [("mark", -weight), ("insult" if symbol == "other" else symbol, 0.0)]


def matches(text: str, weights: dict[str, float], grammar: Transducer, centre: float | None = None) -> list[tuple[float, tuple[str, ...]]]:
    """(score, contexts) of the shortest path of each clause that holds an insult or a threat. With a centre, word weights count up to it."""
    if not weights:
        return []
    low = _lower(text)
    words: dict[int, float] = {}
    for start, _, key in _found(low, weights):
        w = weights[key] if centre is None else min(0.0, weights[key] - centre)
        words[start] = max(w, words.get(start, -math.inf))
    if not words:
        return []
    ends = [0, *(m.end() for m in CLAUSE.finditer(low)), len(low) + 1]
    clauses: dict[int, dict[int, float]] = {}
    for start, w in words.items():
        clauses.setdefault(bisect.bisect_right(ends, start) - 1, {})[start] = w
    out = []
    for k, found in clauses.items():
        path = grammar.shortest(_symbols(low[ends[k]:ends[k + 1]], ends[k], found))
        if path is not None:
            out.append((-path[0], contexts_of(path[1])))
    return out


def _probability(found: list[tuple[float, tuple[str, ...]]], grammar: dict) -> float:
    if not found:
        return 1 / (1 + math.exp(-grammar["none"]))
    return 1 / (1 + math.exp(-(grammar["match"] + max(found)[0] + math.log(len(found)))))


def probability(text: str, grammar: dict) -> float:
    return _probability(matches(text, grammar["words"], compiled(grammar["contexts"]), grammar["centre"]), grammar)


def score(docs: DataFrame, grammar: dict) -> DataFrame:
    """(doc_id, score, n_clauses) for each row."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        composed = compiled(grammar["contexts"])
        for batch in batches:
            found = [matches(t or "", grammar["words"], composed, grammar["centre"]) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_probability(f, grammar) for f in found], pa.float64()),
                                              pa.array([len(f) for f in found], pa.int64())], ["doc_id", "score", "n_clauses"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, n_clauses long")
