"""Ranked lexical search: the best documents of every query, from an index that is searched best first.

Documents are indexed in blocks of up to BLOCK_DOCS, each a row with the posting lists of the query terms it holds (local document
numbers in ascending order of id, and occurrences). Counts over all documents give every posting its impact, and a sparse table
over each posting list answers which document of an interval has the list's greatest impact, in two look-ups.

A block is searched for one query from the interval of all its documents. The sum of the lists' greatest impacts, times their
weights, bounds every score inside an interval. The interval of the highest bound is taken first; its document of the greatest
single contribution is scored exactly and splits it in two, which are bounded anew. What is left when no bound reaches the worst of the
best documents found so far (also in earlier blocks of the task) can't hold a better one, so the result is exact; of equal
scores the smaller id counts, and an interval whose ids are all greater than that is left too.

Terms are the maximal runs of digits, letters and characters above ASCII, A-Z lower-cased; null texts have none. Rows that repeat are documents and
queries of their own. A null document id counts as greater than all others. An empty table of documents or of queries gives no rows.
Queries are sent to the tasks in groups of about GROUP_WORDS words, one pass over the documents for each group, so there
may be any number of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.bytewords import Words, sliced
from dispatchlens.llm.store import written

BLOCK_DOCS = 8_192
#: Postings after which a block is closed, whatever its documents.
BLOCK_POSTINGS = 2_000_000
#: Words of the queries sent to the tasks at once.
GROUP_WORDS = 200_000
#: Intervals taken together in one step; a step's order doesn't change the result.
STEP = 32
NO_ID = (1 << 63) - 1


def grouped_queries(queries: DataFrame, key: str, text: str, group_words: int = GROUP_WORDS) -> DataFrame:
    """(group, item, text): rows with a term-sized share of words each, numbered by group."""
    rows = queries.select(queries[key].alias("item"), F.coalesce(queries[text].cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0
    groups = -(-size // group_words) or 1
    return rows.select(F.pmod(F.xxhash64(F.col("item").cast("string"), "text"), F.lit(groups)).alias("group"), "item", "text")


class Query:
    """The distinct terms of a text by number, and how often each occurs."""

    def __init__(self, text: str, vocabulary: dict[bytes, int]):
        words = Words([text.encode()]).bytes.rstrip(b"\0").split()
        numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        self.terms, self.repeats = np.unique(np.array(numbers, np.int64), return_counts=True)


def _postings(texts: list[str], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and (text, term, occurrences) sorted by text."""
    words = Words([t.encode() for t in texts])
    n = np.diff(words.first)
    every = words.bytes.rstrip(b"\0").split()
    terms = np.fromiter(map(vocabulary.get, every, repeat(-1)), np.int64, len(every))
    known = np.flatnonzero(terms >= 0)
    owner = np.repeat(np.arange(len(texts)), n)[known]
    pairs, tf = np.unique(owner * len(vocabulary) + terms[known], return_counts=True)
    return n, pairs // max(len(vocabulary), 1), pairs % max(len(vocabulary), 1), tf


def index(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text",
          block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Blocks of posting lists of the vocabulary's terms: ids, sizes, lists (term, begin), documents and occurrences.

    n_docs and n_words count all documents with a word, also those without a term of the vocabulary, which need no place in a block.
    """
    def block(held, n_docs, n_words):
        ids, sizes, owner, terms, tf = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(ids, kind="stable")
        local = np.empty(len(ids), np.int64)
        local[order] = np.arange(len(ids))
        owner = local[owner]
        by_list = np.lexsort((owner, terms))
        terms, owner, tf = terms[by_list], owner[by_list], tf[by_list]
        lists, begin = np.unique(terms, return_index=True)
        columns = {"ids": ids[order].astype("<i8"), "sizes": sizes[order].astype("<i8"), "lists": lists.astype("<i4"),
                   "begins": np.append(begin, len(terms)).astype("<i4"), "owners": owner.astype("<u4"), "tfs": tf.astype("<u4")}
        return pa.RecordBatch.from_pydict({"n_docs": pa.array([n_docs], pa.int64()), "n_words": pa.array([n_words], pa.int64())}
                                          | {k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.empty(0, np.int64),) * 5
        held, size, count, n_docs, n_words = [empty], 0, 0, 0, 0
        for batch in sliced(batches):
            ids = np.array([NO_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            n, owner, terms, tf = _postings(batch.column(1).to_pylist(), vocabulary)
            n_docs, n_words = n_docs + int((n > 0).sum()), n_words + int(n.sum())
            has, place = np.unique(owner, return_inverse=True)
            held.append((ids[has], n[has], place + count, terms, tf))
            size, count = size + len(terms), count + len(has)
            if count >= block_docs or size >= block_postings:
                yield block(held, n_docs, n_words)
                held, size, count, n_docs, n_words = [empty], 0, 0, 0, 0
        if n_docs:
            yield block(held, n_docs, n_words)

    rows = docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    binary = ", ".join(f"{c} binary" for c in ("ids", "sizes", "lists", "begins", "owners", "tfs"))
    return written(rows.mapInArrow(built, f"n_docs long, n_words long, {binary}"), "postings")


def frequencies(blocks: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a word, their words, and the documents holding each term of the vocabulary."""
    totals = blocks.agg(F.sum("n_docs").alias("d"), F.sum("n_words").alias("w")).first()

    def sizes(batches):
        held = np.zeros(terms, np.int64)
        for batch in batches:
            for lists, begins in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[np.frombuffer(lists, "<i4")] += np.diff(np.frombuffer(begins, "<i4"))
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": pa.array(found, pa.int32()), "n": pa.array(held[found], pa.int64())})

    df = np.zeros(terms, np.int64)
    counted = blocks.select("lists", "begins").mapInArrow(sizes, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # a row for each term of the group
        df[r["term"]] = r["n"]
    return totals["d"] or 0, totals["w"] or 0, df


class Block:
    """Posting lists with their impacts and sparse tables of the place of the greatest impact."""

    def __init__(self, row: dict, n_docs: int, n_words: int, terms: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        sizes = np.frombuffer(row["sizes"], "<i8")
        lists = np.frombuffer(row["lists"], "<i4")
        begins = np.frombuffer(row["begins"], "<i4").astype(np.int64)
        self.docs = np.frombuffer(row["owners"], "<u4").astype(np.int64)
        tf = np.frombuffer(row["tfs"], "<u4").astype(np.int64)
        self.begin, self.end = np.zeros(terms, np.int64), np.zeros(terms, np.int64)
        self.begin[lists], self.end[lists] = begins[:-1], begins[1:]
        # Python's integers, as 75 * n * N may pass 64 bits
        m = (25 + (75 * sizes.astype(object) * n_docs) // max(n_words, 1)).astype(np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs])
        # list and document in one sorted number, to find a document in a list
        self.places = np.repeat(lists.astype(np.int64), np.diff(begins)) * len(self.ids) + self.docs
        self.best = [np.arange(len(self.docs), dtype=np.int32)]
        longest = int(np.diff(begins).max(initial=0))
        while 2 << (len(self.best) - 1) <= longest:
            half, last = 1 << (len(self.best) - 1), self.best[-1]
            left, right = last[:-half], last[half:]
            self.best.append(np.where(self.impact[right] > self.impact[left], right, left))
        # a level is read where its whole reach lies in one list, so that reaching over a border does no harm
        width = max(len(x) for x in self.best) if len(self.docs) else 0
        self.table = np.zeros((len(self.best), width), np.int32)
        for level, x in zip(self.table, self.best, strict=True):
            level[:len(x)] = x
        del self.best

    def greatest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(impact, place) of the greatest impact in places low to high (exclusive); impact 0 for an empty range."""
        size = high - low
        some = size > 0
        level = np.frexp(np.where(some, size, 1))[1] - 1
        a = self.table[level, np.where(some, low, 0)]
        b = self.table[level, np.where(some, high - (1 << level), 0)]
        place = np.where(self.impact[b] > self.impact[a], b, a)
        return np.where(some, self.impact[place], 0), place


def best_of(block: Block, query: Query, weight: np.ndarray, top: int, best: list[tuple[int, int]], step: int = STEP) -> list[tuple[int, int]]:
    """The `top` highest (score, -id) of those in `best` and the block's documents, as a heap.

    A score is above 0. The heap's first entry is the worst one kept; while it isn't full, every score above 0 is wanted.
    """
    here = (block.end[query.terms] > block.begin[query.terms]) & (weight[query.terms] > 0)
    terms = query.terms[here]
    if not len(terms):
        return best
    factor = weight[terms] * query.repeats[here]
    low, high = block.begin[terms][None], block.end[terms][None]  # an interval is a row: a range of places in each list
    first = np.zeros(1, np.int64)  # the interval's first document
    value, place = block.greatest(low, high)
    bound = value @ factor
    while True:
        if len(best) >= top:
            worst, worst_id = best[0][0], -best[0][1]
            open_ = (bound > worst) | ((bound == worst) & (block.ids[np.minimum(first, len(block.ids) - 1)] < worst_id))
        else:
            open_ = bound > 0
        if not open_.all():
            low, high, first, bound, value, place = (x[open_] for x in (low, high, first, bound, value, place))
        if not len(bound):
            return best
        # the highest bounds, of equal ones those of the smallest documents
        taken = np.lexsort((first, -bound))[:step]
        lo, hi, at, own, spot = low[taken], high[taken], first[taken], value[taken], place[taken]
        # the split: the document of the greatest single contribution
        chosen = spot[np.arange(len(taken)), np.argmax(own * factor, axis=1)]
        doc = block.docs[chosen]
        there = np.searchsorted(block.places, terms[None] * len(block.ids) + doc[:, None])
        there = np.clip(there, lo, hi)
        inside = there < hi
        hit = inside & (block.docs[np.where(inside, there, 0)] == doc[:, None])
        score = np.where(hit, block.impact[np.where(hit, there, 0)], 0) @ factor
        for s, i in zip(score.tolist(), block.ids[doc].tolist(), strict=True):
            if len(best) < top:
                heapq.heappush(best, (s, -i))
            elif (s, -i) > best[0]:
                heapq.heapreplace(best, (s, -i))
        # the two rests of each interval
        new_low, new_high = np.vstack((lo, there + hit)), np.vstack((there, hi))
        new_first = np.concatenate((at, doc + 1))
        new_value, new_place = block.greatest(new_low, new_high)
        rest = np.ones(len(bound), bool)
        rest[taken] = False
        low, high = np.vstack((low[rest], new_low)), np.vstack((high[rest], new_high))
        first, bound = np.concatenate((first[rest], new_first)), np.concatenate((bound[rest], new_value @ factor))
        value, place = np.vstack((value[rest], new_value)), np.vstack((place[rest], new_place))


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def _searched(blocks: DataFrame, queries: list[Query], n_docs: int, n_words: int, weight: np.ndarray, top: int) -> DataFrame:
    """(query, doc_id, score): the best documents of each task for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch.slice(at, 1).to_pylist()[0], n_docs, n_words, len(weight))
                if len(block.ids):
                    best = [best_of(block, q, weight, top, b) for q, b in zip(queries, best, strict=True)]
        found = [(q, -i, s) for q, b in enumerate(best) for s, i in b]
        numbers, ids, scores = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_pydict({"query": pa.array(numbers, pa.int32()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    return blocks.select("ids", "sizes", "lists", "begins", "owners", "tfs").mapInArrow(run, "query int, doc_id long, score long")


def searched(docs: DataFrame, queries: DataFrame, top: int = 10, doc_key: str = "doc_id", query_key: str = "item_id", text: str = "text",
             block_docs: int = BLOCK_DOCS, group_words: int = GROUP_WORDS) -> DataFrame:
    """(item_id, rank, doc_id, score): up to `top` documents of a score above 0 for each query, best first, equal ones by id."""
    spark = docs.sparkSession
    asked = written(grouped_queries(queries, query_key, text, group_words), "queries")
    kind = queries.schema[query_key].dataType.simpleString()
    parts = []
    for g in [r["group"] for r in asked.select("group").distinct().orderBy("group").collect()]:
        rows = asked.where(F.col("group") == g).orderBy("item", "text").collect()  # about GROUP_WORDS words
        vocabulary: dict[bytes, int] = {}
        own = [Query(r["text"], vocabulary) for r in rows]
        blocks = index(docs, vocabulary, doc_key, text, block_docs)
        n_docs, n_words, df = frequencies(blocks, len(vocabulary))
        found = _searched(blocks, own, n_docs, n_words, term_weights(n_docs, df), top)
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"_query int, item_id {kind}")
        parts.append(ranked.join(F.broadcast(names), F.col("query") == F.col("_query")).select(
            "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
    whole = parts[0] if parts else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
