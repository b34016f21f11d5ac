"""Column helpers shared by the text operators. All of them work on whole texts and count code points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP = "[\\x20\\x09-\\x0D]+"
BLOCK = 256
#: Characters of the shortest match whose surroundings are asked for.
SHORTEST = 5


def identified(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only the key and the text, null texts as empty, and a hash of the text: rows that share both are the same row twice."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(docs[key].alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("_hash"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; texts of one byte a character take the quick built-in, those without A-Z stay."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).when(text.rlike("[A-Z]"), F.translate(text, UPPER, UPPER.lower())).otherwise(text)


def spaced_words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def running_total(steps: Column) -> Column:
    """Inclusive running sums of an array of numbers, in blocks, so that a long array isn't copied once for each value."""
    def inside(block):
        return F.slice(F.aggregate(block, F.array(F.lit(0).cast("long")),
                                   lambda got, step: F.array_append(got, F.element_at(got, -1) + step)),
                       F.lit(2), F.size(block))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
                         lambda b: inside(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    before = F.aggregate(blocks, F.array(F.lit(0).cast("long")),
                         lambda got, block: F.array_append(got, F.element_at(got, -1) + F.element_at(block, -1)))
    return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)),
                                lambda block, start: F.transform(block, lambda v: v + start)))


def hits(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def ends(found: Column, gaps: Column) -> Column:
    """The end of each match: the running length of the gap before it and the match."""
    steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda hit, gap: (F.length(gap) + F.length(hit)).cast("long"))
    return F.when(F.size(found) > 0, running_total(steps))


def with_spans(frame: DataFrame, patterns: dict[str, str], around: int = 0) -> DataFrame:
    """For each named pattern a column of structs (start, stop, hit, before, after); text must be a column.

    before and after are the `around` characters on either side, other matches of the pattern included.
    """
    names = list(patterns)
    kept = [c for c in frame.columns if not c.startswith("_found_")]
    frame = frame.select(*kept, *(hits(F.col("text"), patterns[n]).alias(f"_found_{n}") for n in names))
    frame = frame.select("*", *(F.when(F.size(f"_found_{n}") > 0, F.split("text", patterns[n], -1)).alias(f"_gaps_{n}") for n in names))
    frame = frame.select("*", *(ends(F.col(f"_found_{n}"), F.col(f"_gaps_{n}")).alias(f"_ends_{n}") for n in names))

    def spans(n):
        found, gaps, stops = (F.col(f"_{x}_{n}") for x in ("found", "gaps", "ends"))
        side, most = F.lit(around), around // SHORTEST + 1  # no more neighbours than that reach into a side

        def before(i):
            n = F.least(i, F.lit(most))
            pieces = F.zip_with(F.slice(gaps, i - n + 1, n), F.slice(found, i - n + 1, n), lambda gap, hit: F.concat(F.right(gap, side), F.right(hit, side)))
            return F.right(F.concat(F.array_join(pieces, ""), F.right(F.get(gaps, i), side)), side)

        def after(i):
            n = F.least(F.size(found) - i - 1, F.lit(most))
            pieces = F.zip_with(F.slice(found, i + 2, n), F.slice(gaps, i + 3, n), lambda hit, gap: F.concat(F.left(hit, side), F.left(gap, side)))
            return F.left(F.concat(F.left(F.get(gaps, i + 1), side), F.array_join(pieces, "")), side)

        def span(hit, i):
            stop = F.get(stops, i)
            return F.struct((stop - F.length(hit)).alias("start"), stop.alias("stop"), hit.alias("hit"),
                            (before(i) if around else F.lit("")).alias("before"), (after(i) if around else F.lit("")).alias("after"))

        return F.transform(found, span).alias(n)

    return frame.select(*kept, *(spans(n) for n in names))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
