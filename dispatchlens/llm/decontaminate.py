"""Overlap of documents with benchmark items by winnowing.

Each window of an item (WINDOW words, or the whole of a shorter item) and each document keep, of K-word hashes, the smallest
of every run of WINDOW - K + 1: a passage of WINDOW shared words then always keeps the same hash at the same place.
Kept hashes are joined, and each hit is extended to its whole window and compared word by word, so nothing is reported by
hash alone. Words are runs of digits, letters and all characters above ASCII, A-Z lower-cased; null texts have none.
Items of fewer words than WINDOW take a shorter K of their own. Rows that repeat an id and a text give as many equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.text import ascii_lower, digest, identified

WINDOW = 10
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
PLACE_BITS = 28
#: Fingerprints of the benchmark up to this many are sent to all tasks (a row is under 400 bytes: 80 MB at most); beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, BETWEEN), lambda w: w != ""), ascii_lower)


def _gram(length: int) -> int:
    return length // 2 + 1


def _fingerprints(given: Column, length: int) -> Column:
    """The smallest k-gram of each window of so many words, the leftmost of equal ones: 36 bits of its hash above 28 of its place.

    A text holds fewer than 2 ** 28 words, as a string ends at 2 GB.
    """
    k = _gram(length)
    run = length - k + 1

    def gram(i):
        return F.shiftleft(F.xxhash64(F.lit(length), *(F.get(given, i + j) for j in range(k))), PLACE_BITS).bitwiseOR(i.cast("long"))

    def smallest(grams):
        return F.transform(F.sequence(F.lit(0), F.size(grams) - run), lambda i: F.least(*(F.get(grams, i + j) for j in range(run))))

    def fresh(mins):
        return F.filter(mins, lambda m, i: (i == 0) | (m != F.get(mins, i - 1)))

    grams = F.transform(F.sequence(F.lit(0), F.size(given) - k), gram)
    # transform over an array of one names a value, so that it is made once
    kept = F.get(F.transform(F.transform(F.array(grams), smallest), fresh), 0) if run > 1 else grams
    return F.when(F.size(given) >= length, kept)


def _place(kept: Column) -> Column:
    return kept.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: (length, words, items, h, at): the ids of the items that hold it, its fingerprint and where that begins."""
    own = benchmark.select(benchmark[key].cast("string").alias("item"), words(F.coalesce(benchmark[text].cast("string"), F.lit(""))).alias("all"))
    own = own.where(F.size("all") > 0).select("item", "all", F.least(F.size("all"), F.lit(WINDOW)).alias("length"))
    each = own.select("item", "length", F.explode_outer(F.transform(F.sequence(F.lit(1), F.size("all") - F.col("length") + 1), lambda i: F.slice("all", i, F.col("length")))).alias("words"))
    each = each.groupBy("length", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    kept = F.coalesce(*(F.when(F.col("length") == n, F.get(_fingerprints(F.col("words"), n), 0)) for n in range(1, WINDOW + 1)))
    each = each.select("*", kept.alias("kept"))
    return each.select("length", "words", "items", F.shiftright("kept", PLACE_BITS).alias("h"), _place(F.col("kept")).alias("at"))


def contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for each row of docs: words inside an occurring window, items with one (sorted)."""
    return _grouped(docs, benchmark, broadcast_rows).select("doc_id", "n_words", "n_hit", "items", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")


def _grouped(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    bench = windows(benchmark)
    sizes = {r["length"]: r["n"] for r in bench.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths = sorted(sizes) or [WINDOW]
    bench = bench.select(F.col("length").alias("b_length"), F.col("words").alias("b_words"), "items", F.col("h").alias("b_h"), F.col("at").alias("b_at"))
    few = sum(sizes.values()) <= broadcast_rows
    if few:
        bench = F.broadcast(bench)
    rows = identified(docs).select("doc_id", "_hash", words(F.col("text")).alias("words"))
    texts = rows.select("doc_id", "_hash", F.size("words").cast("long").alias("n_words"), "words")
    # one entry without a hash stands for the document itself
    own = F.array(F.lit(None).cast("long"))
    prints = F.concat(own, *(F.coalesce(_fingerprints(F.col("words"), n), F.slice(own, 1, 0)) for n in lengths))
    rows = rows.select("doc_id", "_hash", F.size("words").cast("long").alias("n_words"), "words", prints.alias("prints"))
    # never empty; explode() would have Spark test the size of prints below, with the words made anew inside
    rows = rows.select("doc_id", "_hash", "n_words", *(["words"] if few else []), F.explode_outer("prints").alias("kept"))
    rows = rows.withColumns({"h": F.shiftright("kept", PLACE_BITS), "at": _place(F.col("kept"))}).drop("kept")
    start = F.col("at") - F.col("b_at")
    hit = rows.join(bench, F.col("h") == F.col("b_h"), "left")
    hit = hit.where(F.col("h").isNull() | (F.col("b_h").isNotNull() & (start >= 0)))
    if not few:
        # a fingerprint goes without its text to the join; the words meet the hits alone, once for each document
        spans = F.struct(F.col("at"), F.col("b_at"), F.col("b_length"), F.col("b_words"), F.col("items"))
        found = hit.where("h is not null").groupBy(F.col("doc_id").alias("_id"), F.col("_hash").alias("_text")).agg(F.collect_list(spans).alias("found"))
        found = found.join(texts.select("doc_id", "_hash", "words").dropDuplicates(["doc_id", "_hash"]), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_text") == F.col("_hash")))
        found = found.select("doc_id", "_hash", F.lit(None).cast("long").alias("n_words"), "words", F.lit(0).cast("long").alias("h"), F.inline("found"))
        alone = hit.where("h is null").select("doc_id", "_hash", "n_words", F.lit(None).cast("array<string>").alias("words"), "h", "at", "b_at", "b_length", "b_words", "items")
        hit = found.unionByName(alone)
    same = (start >= 0) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("b_length")) == F.col("b_words"))
    hit = hit.where(F.col("h").isNull() | same)
    hit = hit.select("doc_id", "_hash", "n_words", F.when(F.col("h").isNotNull(), F.struct(start.alias("start"), (start + F.col("b_length")).alias("stop"))).alias("span"),
                     F.when(F.col("h").isNull(), 1).alias("self"), F.col("items").alias("found"))
    grouped = hit.groupBy("doc_id", "_hash").agg(F.max("n_words").alias("n_words"), F.count("self").cast("int").alias("copies"),
                                                 F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("found").alias("found"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda got, s: F.struct(F.greatest(got["last"], s["stop"]).alias("last"), (got["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(got["last"], s["start"]))).alias("n")),
                          lambda got: got["n"])
    return grouped.select("doc_id", "_hash", "copies", "n_words", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("found"))).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a hit; all columns stay."""
    hit = _grouped(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_text"))
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (own == hit["_text"]), "left_anti")


def report(found: DataFrame) -> DataFrame:
    """contaminated() with the items as a count and a digest."""
    return found.select("doc_id", "n_words", F.col("n_hit"), F.size("items").cast("long").alias("n_items"),
                        digest(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
