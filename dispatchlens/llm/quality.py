"""Quality rules as a short-circuit cascade.

Each rule says when a text is rejected. On a small sample the cost of every rule is timed and its share of rejections counted;
the rules then run by rejection per cost, each only on texts that those before it let pass. The order changes the time
taken and never the verdict: a text is kept when no rule rejects it. Null texts have no words and fail.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.text import spaced_words

SAMPLE_ROWS = 256
REPEATS = 4
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 30
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 25


def repeat_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more.

    Equal windows are neighbours once hashes are sorted with their places; then the places that repeat are sorted again and
    each counts the words up to the next one, three at most.
    """
    count = F.size(words)
    windows = F.when(count >= 4, F.transform(F.sequence(F.lit(0), count - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    return F.coalesce(_once(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(0)), F.lit(0)).cast("long")


def _once(value: Column, use) -> Column:
    """use(value), with the value made once: transform over an array of one names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _covered(windows: Column) -> Column:
    def covered(pairs):
        def twin(p, k):
            before, after = F.get(pairs, k - 1), F.get(pairs, k + 1)
            return F.coalesce(before["h"] == p["h"], F.lit(False)) | F.coalesce(after["h"] == p["h"], F.lit(False))
        places = F.array_sort(F.transform(F.filter(pairs, twin), lambda p: p["i"]))
        return F.aggregate(places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                           lambda got, i: F.struct(i.alias("last"), (got["n"] + F.least(F.lit(3), i - got["last"])).alias("n")), lambda got: got["n"])

    return _once(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)


def _read(docs: DataFrame, *kept: Column) -> DataFrame:
    """The words, the lines with a word and the body of each text, beside what else is kept."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return docs.select(*kept, body.alias("_body"), spaced_words(body).alias("_words"), lines.alias("_lines"))


def _counters() -> dict[str, Column]:
    return {"n_words": F.size("_words").cast("long"),
            "word_chars": F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
            "n_symbols": F.length(F.regexp_replace("_body", "[^#*$%&|<>]++", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeat_words(F.col("_words"))}


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words); one row for each row of docs."""
    return _read(docs, docs["doc_id"].alias("doc_id")).select("doc_id", *(c.alias(name) for name, c in _counters().items()))


@dataclass(frozen=True)
class Rule:
    """rejects(counters): true for a bad text; the counters it reads are made when it is reached."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("few_words", lambda c: c["n_words"] < MIN_WORDS),
    Rule("repeats", lambda c: 100 * c["n_repeat_words"] > MAX_REPEAT_PCT * c["n_words"]),
    Rule("symbols", lambda c: 100 * c["n_symbols"] > MAX_SYMBOL_PCT * c["word_chars"]),
    Rule("dup_lines", lambda c: 100 * c["n_dup_lines"] > MAX_DUP_LINE_PCT * c["n_lines"]),
    Rule("word_length", lambda c: (c["word_chars"] < MIN_WORD_CHARS * c["n_words"]) | (c["word_chars"] > MAX_WORD_CHARS * c["n_words"])),
)
BASE_RULES = ("few_words", "repeats")


def ordered(docs: DataFrame, given: Sequence[Rule] = RULES) -> list[Rule]:
    """The rules by rejection per second on a bounded sample: the first SAMPLE_ROWS texts, each measured REPEATS times."""
    sample = docs.select(docs["text"].cast("string").alias("text")).limit(SAMPLE_ROWS).collect()
    if not sample:
        return list(given)
    texts = docs.sparkSession.createDataFrame([(r["text"],) for r in sample], "text string")
    rows = _read(texts.select("text", F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))))
    worth = {}
    for rule in given:
        began = time.perf_counter()
        rejected = rows.agg(F.count_if(rule.rejects(_counters())).alias("n")).first()["n"]
        worth[rule.name] = (rejected + 1) / (time.perf_counter() - began)
    return sorted(given, key=lambda rule: -worth[rule.name])


def _verdict(cascade: Sequence[Rule], counters: dict[str, Column]) -> Column:
    verdict = F.lit(True)
    for rule in reversed(cascade):
        verdict = F.when(rule.rejects(counters), False).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, cascade: Sequence[Rule] | None = None) -> DataFrame:
    """measured() with base_failed and kept."""
    cascade = ordered(docs) if cascade is None else cascade
    rows = measured(docs)
    counters = {name: rows[name] for name in rows.columns}
    failed = F.lit(False)
    for rule in RULES:
        if rule.name in BASE_RULES:
            failed = failed | rule.rejects(counters)
    return rows.select("*", failed.alias("base_failed"), (~failed & _verdict(cascade, counters)).alias("kept"))


def kept(docs: DataFrame, cascade: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of docs that no rule rejects, all columns as they are; a counter is made only where a rule that reads it is reached.

    The verdict passes through a generator, so that the filter on it isn't pushed below the split into words, which would
    then be made anew for each use.
    """
    cascade = ordered(docs) if cascade is None else cascade
    rows = _read(docs, F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    rows = rows.select("_row", F.explode_outer(F.array(_verdict(cascade, _counters()))).alias("_kept")).where("_kept")
    return rows.select("_row.*")
