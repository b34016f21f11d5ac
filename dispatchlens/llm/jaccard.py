"""Exact self-join of documents on the Jaccard similarity of their five-word shingles, by prefixes under several token orders.

A document is the set of 48-bit hashes of its shingles; documents of the same set are one node. If two sets are similar
enough, their prefixes under any one order of all tokens share a token. The first order puts frequent tokens last, after counts
of all tokens in COUNT_BUCKETS buckets, and its prefixes are joined through inverted lists; similar sets share many tokens of
these prefixes, and pairs that share fewer are never compared. The second and third orders are by other hashes; their longer
prefixes must share several tokens. Whole sets are compared only for pairs that pass all orders.

A list of MANY members or more isn't paired with itself at once: first its members meet its pivot, the least by size. Where that makes ALIKE
of them one component, they are near copies, and the others meet PIVOTS more in each of ROUNDS rounds, the least ones under hash orders that all
lists share. What is linked is merged to components. Then all pairs of different components in any list are formed, so that no link between
components is lost; a group of copies has nearly become one component by then and costs about its size.

To compare sets, each is sent once to every pivot it meets: a pivot's partners are sorted behind it, PARTNERS to a task at most,
and pass by it as a stream. Null or empty texts are empty sets without links; fewer than five words are one shingle. Rows that repeat stay.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.chunks import forget
from dispatchlens.llm.components import components
from dispatchlens.llm.store import dropped, released, written

WORDS = 5
PERCENT = 80
COUNT_BUCKETS = 1 << 18
#: A token counted more often than its bucket's usual load by this much is hot; its list is handled by joins that split.
HOT = 4096
#: Buckets of the filter that lets through the rows of candidates before they are shuffled.
FILTER_BUCKETS = 1 << 20
#: Members of a list that meet its pivot before it is paired; the share of them that one component must have for further
#: pivots, how many a round has, and rounds; members from which a list is paired by components first. They change the cost alone.
MANY, ALIKE, PIVOTS, ROUNDS, LONG = 64, 0.2, 2, 4, 256
#: Sets that a task compares with one pivot; a pivot with more partners stands in several tasks.
PARTNERS = 512
TOKEN_BYTES = 6
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit values: another order for each seed."""
    v = values ^ np.uint64(seed)
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, np.uint64(min(len(h), WORDS)))
    for k in range(min(WORDS, len(h))):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[k:k + n]
    out = np.sort(mixed(out, SEEDS[0]) >> np.uint64(64 - 8 * TOKEN_BYTES))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def _packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.reshape(-1).view("<u8")


def _node(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def least_overlap(n: int) -> int:
    """Tokens that a similar set of any size shares with a set of n."""
    return -(-PERCENT * n // 100)


def _may_share(n, m, common):
    """Whether two sets whose prefixes share so many tokens can be similar; columns.

    The prefix that ends earlier in the order holds no other token of the other set, so what it lacks is lacking in the
    whole; it may be either of the two.
    """
    needed = F.ceil(F.lit(PERCENT) * (n + m) / (100 + PERCENT))
    return (_prefix(n) - common <= n - needed) | (_prefix(m) - common <= m - needed)


def _extra(n: int) -> int:
    return n // 20


def _orders(tokens: np.ndarray) -> list[np.ndarray]:
    """Prefixes under the second and third order, as sorted 32-bit parts of the tokens: a pair must share _extra() + 1 of them."""
    size = len(tokens) - least_overlap(len(tokens)) + 1 + _extra(len(tokens))
    out = []
    for seed in SEEDS[1:]:
        rank = mixed(tokens, seed)
        first = np.partition(rank, size - 1)[:size] if size < len(rank) else rank
        out.append(np.sort((first >> np.uint64(32)).astype(np.uint32)))
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))


def _map(rows: DataFrame, each, schema: str) -> DataFrame:
    """each(ids, list of token arrays) -> dict of columns, over small batches; the tokens of a batch's texts."""
    def run(batches):
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_pydict(each(part.column(0), [shingles(t) for t in part.column(1).to_pylist()]))

    return rows.mapInArrow(run, schema)


def _first(rows: DataFrame, kind: str) -> DataFrame:
    """(doc_id, id, n) of each row, and after them for each task (bucket, n): the tokens it counted. id is null there."""
    def run(batches):
        forget()
        counts = np.zeros(COUNT_BUCKETS, np.int64)
        at_least_one = None
        for batch in batches:
            at_least_one = batch
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tokens = [shingles(t) for t in part.column(1).to_pylist()]
                counts += np.bincount(np.concatenate(tokens) & np.uint64(COUNT_BUCKETS - 1), minlength=COUNT_BUCKETS)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "id": pa.array([_node(t) for t in tokens], pa.int64()), "n": pa.array([len(t) for t in tokens], pa.int64()), "bucket": pa.nulls(len(tokens), pa.int32())})
        if at_least_one is not None:
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(len(used), at_least_one.schema.field(0).type), "id": pa.nulls(len(used), pa.int64()), "n": pa.array(counts[used], pa.int64()), "bucket": pa.array(used, pa.int32())})

    return rows.mapInArrow(run, f"doc_id {kind}, id long, n long, bucket int")


def _tiers(first: DataFrame) -> tuple[np.ndarray, int]:
    """For each bucket how far its count is above the usual load, in powers of two, and the first tier that is hot."""
    found = first.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # COUNT_BUCKETS rows at most
    counts = np.zeros(COUNT_BUCKETS)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    usual = float(np.median(counts))
    noise = 4 * math.sqrt(usual) + 8
    return np.floor(np.log2(np.maximum(1.0, (counts - usual) / noise))).astype(np.uint8), int(math.log2(max(2.0, HOT / noise)))


def _prefix(n):
    """Tokens of a set of n that the first order's lists hold; a number or a column."""
    return n - (least_overlap(n) if isinstance(n, int) else F.ceil(F.lit(PERCENT) * n / 100)) + 1


def _near(n, m):
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)).cast("boolean")


def _postings(rows: DataFrame, tiers: np.ndarray, hot: int, wanted: bool) -> DataFrame:
    """(token, id, n) of the hot or of the other tokens in prefixes under the first order: rising tier, then hash."""
    def each(_, sets):
        token, node, size = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for t in sets:
            if len(t):
                tier = tiers[t & np.uint64(COUNT_BUCKETS - 1)]
                order = np.lexsort((t, tier))[:_prefix(len(t))]
                order = order[(tier[order] >= hot) == wanted]
                token.append(t[order])
                node.append(np.full(len(order), _node(t)))
                size.append(np.full(len(order), len(t), np.int32))
        return {"token": pa.array(np.concatenate(token).view(np.int64)), "id": pa.array(np.concatenate(node)), "n": pa.array(np.concatenate(size))}

    return _map(rows, each, "token long, id long, n int")


def _lists(rows: DataFrame, tiers: np.ndarray, hot: int) -> tuple[DataFrame, DataFrame]:
    """(token, id, n, members, pivot, pivot_n) of tokens with two nodes or more; the pivot is the list's least (n, id).

    Lists of tokens that aren't hot are bounded by their bucket's count, and a window reads them, after one exchange that also
    serves to drop repeats. Those of hot tokens, from a reading of their own, are counted and joined; their written table is given too.
    """
    facts = {"members": F.count("*").cast("int"), "pivot": F.min(F.struct("n", "id"))}
    whole = Window.partitionBy("token")
    cool = _postings(rows, tiers, hot, False).repartition("token").dropDuplicates(["token", "id", "n"])
    cool = cool.select("token", "id", "n", F.count("*").over(whole).cast("int").alias("members"), facts["pivot"].over(whole).alias("pivot"))
    stored = warm = written(_postings(rows, tiers, hot, True).distinct(), "hot")
    heads = warm.groupBy(F.col("token").alias("_token")).agg(*(c.alias(k) for k, c in facts.items()))
    warm = warm.join(heads, F.col("token") == F.col("_token")).select("token", "id", "n", *facts)
    kept = cool.unionByName(warm).where("members > 1")
    return kept.select("token", "id", "n", "members", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pivot_n")), stored


class Join:
    """The join over one table of documents: its written tables and what they give."""

    def __init__(self, docs: DataFrame):
        self.spark = spark = docs.sparkSession
        if spark.conf.get(BATCH_BYTES, None) in (None, "-1"):
            spark.conf.set(BATCH_BYTES, str(16 << 20))  # sets of long texts would make batches of any size
        self.rows = _texts(docs)
        self.kind = self.rows.schema["doc_id"].dataType.simpleString()
        self.first = written(_first(self.rows, self.kind), "nodes")
        self.members = self.first.where("bucket is null").select("doc_id", "id", "n")

    def _sets(self, need: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(id, tokens) of the nodes of need (id), from one text of each; and the written table of those texts' owners."""
        owners = self.members.where("n > 0").groupBy("id").agg(F.min(F.struct(F.xxhash64("doc_id"), F.col("doc_id")))["doc_id"].alias("owner"))
        owners = written(owners.join(need.withColumnRenamed("id", "need"), F.col("id") == F.col("need"), "left_semi"), "owners")
        bucket = F.pmod(F.xxhash64("owner"), F.lit(FILTER_BUCKETS))
        mask = np.zeros(FILTER_BUCKETS, bool)
        mask[owners.select(bucket.alias("x")).distinct().toArrow()["x"].to_numpy()] = True

        def run(batches):
            for batch in batches:
                batch = batch.filter(pa.array(mask[batch.column(1).to_numpy(zero_copy_only=False)])).select([0])
                for at in range(0, batch.num_rows, 256):
                    sets = [shingles(t) for t in batch.slice(at, 256).column(0).to_pylist()]
                    yield pa.RecordBatch.from_pydict({"id": pa.array([_node(t) for t in sets], pa.int64()), "tokens": pa.array([_packed(t) for t in sets], pa.binary())})

        rows = self.rows.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BUCKETS)).alias("x"))
        # of the copies of a node only rows of its owner's bucket get here
        sets = rows.mapInArrow(run, "id long, tokens binary").join(owners.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_semi").dropDuplicates(["id"])
        return sets, owners

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar; first by the other orders, then by whole sets."""
        pairs = written(pairs.select("a", "b"), "pairs")
        tasks = F.floor((F.col("partners") - 1) / PARTNERS).cast("int")
        sizes = pairs.groupBy(F.col("b").alias("key")).agg(F.count("*").alias("partners"))
        partners = pairs.join(sizes, F.col("b") == F.col("key")).select(
            F.col("a").alias("id"), "key", F.pmod(F.xxhash64("a"), tasks + 1).cast("int").alias("salt"), F.lit(True).alias("partner"))
        pivots = sizes.select(F.col("key").alias("id"), "key", F.explode(F.sequence(F.lit(0), tasks)).alias("salt"), F.lit(False).alias("partner"))
        roles = written(partners.unionByName(pivots), "roles")
        sets, owners = self._sets(roles.select("id").distinct())
        met = roles.join(sets.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).select("key", "salt", "partner", "id", "tokens")
        met = met.repartition("key", "salt").sortWithinPartitions("key", "salt", "partner")

        def compared(batches):
            key, pivot, orders = None, None, None
            for batch in batches:
                a, b = [], []
                for at in range(batch.num_rows):
                    k, partner, node, raw = (batch.column(c)[at].as_py() for c in (0, 2, 3, 4))
                    tokens = _unpacked(raw)
                    if not partner:
                        key, pivot, orders = k, tokens, _orders(tokens)
                    elif k != key:
                        raise ValueError("a partner came before its pivot")
                    elif _passes(len(tokens), len(pivot), _orders(tokens), orders) and _similar(tokens, pivot):
                        a.append(node)
                        b.append(k)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        links = written(met.mapInArrow(compared, "a long, b long"), "links")
        dropped(pairs, roles, owners)
        released(self.spark)
        return links

    def links(self) -> DataFrame:
        """Links (a, b) between nodes whose components are those of all similar pairs."""
        tiers, hot = _tiers(self.first)
        lists, hot_ones = _lists(self.rows, tiers, hot)
        lists = written(lists, "lists")
        dropped(hot_ones)
        released(self.spark)
        many = lists.where(F.col("members") >= MANY)
        star = many.where((F.col("id") != F.col("pivot")) & _near(F.col("n"), F.col("pivot_n"))).select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
        found = self.verified(star)
        labels = components(found)
        dropped(found)
        rest = written(_mixed(many, labels), "rest")  # the rounds draw from no other lists
        for turn in range(ROUNDS):
            links = self.verified(_drawn(rest, turn))
            if links.isEmpty():
                break
            labels = components(_stars(labels).unionByName(links))  # what was linked before stands for its links
            dropped(links)
            left = written(_mixed(rest, labels), "rest")
            dropped(rest)
            rest = left
            released(self.spark)
        dropped(rest)
        rest = written(_mixed(lists, labels), "rest")
        dropped(lists)
        released(self.spark)
        return _stars(labels).unionByName(self.verified(_across(rest)))


def _stars(labels: DataFrame) -> DataFrame:
    """Edges (a, b) of the same components, one for each node but the label."""
    return labels.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))


def _mixed(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, id, n, members, label) of the lists that hold several components."""
    known = lists.select("token", "id", "n", "members").join(labels.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    known = known.select("token", "id", "n", "members", F.coalesce("label", "id").alias("label"))
    several = known.groupBy(F.col("token").alias("_token")).agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("_token")
    return known.join(several, F.col("token") == F.col("_token"), "left_semi")


def _drawn(rest: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of members and pivots of other components, in the lists of near copies."""
    many = rest.where(F.col("members") >= MANY)
    held = many.groupBy("token", "label").agg(F.count("*").alias("n"), F.max("members").alias("members"))
    held = held.groupBy(F.col("token").alias("_held")).agg(F.max("n").alias("most"), F.max("members").alias("members"))
    alike = many.join(held.where(F.col("most") >= ALIKE * F.col("members")).select("_held"), F.col("token") == F.col("_held"), "left_semi")
    draws = [F.min(F.struct(F.xxhash64(F.lit(turn * PIVOTS + k), "id").alias("rank"), F.col("id").alias("b"), F.col("n").alias("m"), F.col("label").alias("other"))) for k in range(PIVOTS)]
    heads = alike.groupBy(F.col("token").alias("_token")).agg(F.array(*draws).alias("draws")).select("_token", F.inline("draws"))
    met = alike.join(heads, F.col("token") == F.col("_token")).where((F.col("label") != F.col("other")) & _near(F.col("n"), F.col("m")))
    return met.select(F.col("id").alias("a"), "b").distinct()


def _across(rest: DataFrame) -> DataFrame:
    """All pairs (a, b) of different components that share so many tokens of their first prefixes that they may be similar."""
    def sides(frame):
        one = frame.select(F.col("token").alias("t1"), F.col("label").alias("l1"), F.col("id").alias("a"), F.col("n").alias("n_a"))
        two = frame.select(F.col("token").alias("t2"), F.col("label").alias("l2"), F.col("id").alias("b"), F.col("n").alias("n_b"))
        return one, two

    near = _near(F.col("n_a"), F.col("n_b"))
    one, two = sides(rest.where(F.col("members") < LONG))
    short = one.join(two, (F.col("t1") == F.col("t2")) & (F.col("l1") < F.col("l2")) & near)
    # in long lists pairs of labels, and then their members: a label's own pairs are never looked at
    long = rest.where(F.col("members") >= LONG)
    kinds = long.select("token", "label").distinct()
    other = kinds.select(F.col("token").alias("_token"), F.col("label").alias("_label"))
    across = kinds.join(other, (F.col("token") == F.col("_token")) & (F.col("label") < F.col("_label"))).select("token", "label", "_label")
    one, two = sides(long)
    pairs = across.join(one, (F.col("token") == F.col("t1")) & (F.col("label") == F.col("l1"))).join(two, (F.col("token") == F.col("t2")) & (F.col("_label") == F.col("l2")) & near)
    columns = ["a", "b", "n_a", "n_b"]
    swap = F.col("a") < F.col("b")
    pairs = short.select(columns).unionByName(pairs.select(columns)).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"))
    pairs = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("common"))
    return pairs.where(_may_share(F.col("n_a"), F.col("n_b"), F.col("common"))).select("a", "b")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _passes(na: int, nb: int, a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    """Whether the prefixes share enough under each further order. Equal 32-bit parts only let more pairs pass."""
    least = min(_extra(na), _extra(nb)) + 1
    for x, y in zip(a, b, strict=True):
        if int(np.isin(x, y).sum()) < least:
            return False
    return True


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = _common(x, y)
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: the least doc_id reachable by links; a null id counts as the largest."""
    join = Join(docs)
    labels = components(join.links()).select(F.col("id").alias("_id"), "label")
    members = join.members.join(labels, F.col("id") == F.col("_id"), "left").select("doc_id", "n", F.coalesce("label", "id").alias("label"))
    full = members.where("n > 0")
    least = full.groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("component_id"))
    out = full.join(least, F.col("label") == F.col("_label")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the first of their component; of rows that repeat an id all stay."""
    first = joined(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_first"]), "left_semi")
