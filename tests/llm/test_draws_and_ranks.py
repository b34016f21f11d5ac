"""Fingerprints, resampling and ranked search against brute force on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import fingerprints as fp, resampling, search
from dispatchlens.llm.bytewords import Words
from dispatchlens.llm.queries import op11_fingerprints, op12_resampling, op13_search

RNG = np.random.default_rng(3)
NAMES = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma".split()


def prose(n, k=len(NAMES)):
    return " ".join(RNG.choice(NAMES[:k], n))


COPY = prose(60)
TEXTS = ["", None, " \n\t", "x", "Aé B-c\n9 é", "%%% ***", "Nd, " * 40, COPY, COPY, COPY.upper(), prose(5000), prose(25), prose(19), "a b \x00c DÉ"]
TEXTS += [prose(int(n)) for n in RNG.integers(1, 90, 40)] + [COPY] * 12
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return WORD.findall(lowered(text))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with an id twice, a null id, and columns named like results; items that repeat."""
    to = tmp_path_factory.mktemp("draws")
    rows = [(3 * i, t, 1, "clash", 0.5) for i, t in enumerate(TEXTS)] + [(21, TEXTS[7], 1, "clash", 0.5), (24, "other text", 1, "x", 0.5), (None, COPY, 1, "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, fingerprint string, score double")
    docs.repartition(5).write.parquet(f"{to}/documents.parquet")
    items = [(1, COPY), (2, "alpha ALPHA beta zz"), (2, "alpha ALPHA beta zz"), (3, None), (4, ""), (5, "nothing here"), (6, prose(30) + " nd é")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{to}/benchmark.parquet")
    return str(to)


def stored(spark, folder, name="documents", key="doc_id"):
    return [(r[key], r["text"] or "") for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]


# Fingerprints --------------------------------------------------------------------------------

def brute_fingerprint(text):
    """Consistent weighted sampling term by term, from the definition, in the same single precision."""
    words = text.encode().lower().split()
    if not words:
        return [fp.NONE] * fp.SAMPLES
    ids = [int(fp._FIRST), *(fp.xxhash.xxh64_intdigest(w) for w in words), int(fp._LAST)]
    weights = Counter(zip(ids, ids[1:]))
    terms = {pair: int(fp.mixed(np.array([pair[0]], np.uint64), np.array([pair[1]], np.uint64))[0]) for pair in weights}
    one, out = np.float32(1), []
    for factor in map(int, fp._FACTORS):
        lowest = None
        for pair, weight in weights.items():
            x = terms[pair] * factor & (1 << 64) - 1
            r, ln_c, up = fp._R[x >> 48], fp._LN_C[x >> 32 & 0xFFFF], np.float32(x & 0xFFFFFFFF) * np.float32(2.0**-32)
            t = np.floor(np.float32(np.log(weight)) / r + (one - up))
            value = np.float32(ln_c - np.float32(r * np.float32(up + t)))
            lowest = value if lowest is None else min(lowest, value)
        bits = int(np.array([lowest], np.float32).view(np.uint32)[0]) * 2654435761 & 0xFFFFFFFF
        out.append(min(bits >> 16, fp.NONE - 1))
    return out


def test_samples_match_the_definition():
    texts = [t or "" for t in TEXTS[:9]] + TEXTS[11:16] + ["a b a b a b a b c"]
    assert fp.sampled(texts).tolist() == [brute_fingerprint(t) for t in texts]


def test_blocks_of_terms_change_nothing(monkeypatch):
    whole = fp.sampled([t or "" for t in TEXTS])
    monkeypatch.setattr(fp, "TERMS", 7)
    assert (fp.sampled([t or "" for t in TEXTS]) == whole).all()


def test_collisions_follow_the_generalised_jaccard():
    errors = []
    for _ in range(120):
        a = prose(int(RNG.integers(5, 200)), 4)
        b = fp.edited(a, prose(60, 4))
        x, y = (dict(zip(*map(np.ndarray.tolist, fp.weighted_terms(t)))) for t in (a, b))
        names = x.keys() | y.keys()
        want = sum(min(x.get(n, 0), y.get(n, 0)) for n in names) / sum(max(x.get(n, 0), y.get(n, 0)) for n in names)
        one, other = fp.sampled([a, b])
        errors.append(fp.likeness(one, other) - want)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.07


def test_every_document_meets_the_next_one(spark, folder):
    got = op11_fingerprints(spark, folder).collect()
    rows = stored(spark, folder)
    assert len(got) == len(rows)
    # the order within equal ids is by a hash; both orders of the id that has two texts are tried
    answers = []
    for sign in (1, -1):
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, sign * len(r[1])))
        want = []
        prints = fp.sampled([t for _, t in order])
        for i, (doc, text) in enumerate(order):
            after = (i + 1) % len(order)
            made = fp.edited(text, order[after][1])
            other = fp.sampled([made])[0]
            want.append((doc, len(text), hashlib.sha256(made.encode()).hexdigest(), prints[i].tobytes().hex(), other.tobytes().hex(),
                         round(float(fp.likeness(prints[i], other)), 9), round(float(fp.likeness(prints[i], prints[after])), 9)))
        answers.append(sorted(want, key=repr))
    mine = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got]
    assert sorted(mine, key=repr) in answers


def test_edges_of_fingerprints(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprints(spark.createDataFrame([], schema)).collect() == []
    alone = fp.fingerprints(spark.createDataFrame([(4, "abcdefgh")], schema)).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and alone["near_next"] == 1.0
    blank = {r["doc_id"]: r for r in fp.fingerprints(spark.createDataFrame([(1, None), (2, ""), (3, "word")], schema)).collect()}
    assert blank[1]["near_next"] == 1.0 and blank[2]["near_next"] == 0.0 and blank[1]["fingerprint"] == blank[2]["fingerprint"]
    names = fp.fingerprints(spark.createDataFrame([("b", "x y"), ("a", "x y z")], "doc_id string, text string")).collect()
    assert {r["doc_id"] for r in names} == {"a", "b"}


# Resampling ----------------------------------------------------------------------------------

def features_of(text):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resampled(rows, targets, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    source, target = Counter(), Counter()
    for _, text in rows:
        source.update(map(bucket, features_of(text)))
    for _, text in targets:
        target.update(map(bucket, features_of(text)))
    s_all, t_all = source.total(), target.total()
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000)))) for b in source}
    out = []
    for doc, text in rows:
        f = features_of(text)
        weight = sum(gain[bucket(x)] for x in f)
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None, len(words_of(text))])
    able = sorted((r for r in out if r[5] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_matches_brute_force(spark, folder):
    got = op12_resampling(spark, folder)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_resampled(stored(spark, folder), stored(spark, folder, "benchmark", "item_id"))
    mine = sorted((tuple(r) for r in got.collect()), key=repr)
    assert mine == want and sum(r[4] is not None for r in want) >= 1


@pytest.mark.parametrize("rows_per_task", [3, 1000])
def test_ranks_hold_over_many_ranges(spark, rows_per_task):
    rows = [(i, 30 if i % 5 else 3, 1, 1, int(s)) for i, s in enumerate(RNG.integers(0, 40, 300))] + [(None, 30, 1, 1, None)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(4)
    got = resampling.drawn(scored, 20, 30, rows_per_task).collect()
    able = sorted((r for r in rows if r[1] >= 20 and r[4] is not None), key=lambda r: (-r[4], r[0]))
    want = {r[0]: k for k, r in enumerate(able[:30 * len(able) // 100], 1)}
    assert len(got) == len(rows) and {r["doc_id"]: r["rank"] for r in got if r["rank"]} == want


def test_interned_strings_are_verified_byte_by_byte():
    words = Words([t.encode() for t in (prose(400), "x" * 70 + " " + "x" * 69 + "y", "é a", "")])
    begin, end, _ = words.runs(0, len(words.starts), 3)
    spans = [words.bytes[a:b] for a, b in zip(begin, end)]
    for key in (resampling.xxhash.xxh64_digest, lambda s: (len(s) % 5).to_bytes(8), lambda s: bytes(8)):
        table = resampling.Interned(words.bytes, begin, end, key)
        by_slot = defaultdict(set)
        for slot, span in zip(table.slot.tolist(), spans):
            by_slot[slot].add(span)
        assert all(len(v) == 1 for v in by_slot.values()) and len(by_slot) == len(set(spans))
        assert all(table.bucket[k] == zlib.crc32(next(iter(v))) % 10_000 for k, v in by_slot.items())
        assert table.count.sum() == len(spans) and all(table.count[k] == spans.count(next(iter(v))) for k, v in list(by_slot.items())[:50])


def test_stretches_of_words_lose_no_run(monkeypatch):
    words = Words([(t or "").encode() for t in TEXTS])
    monkeypatch.setattr(resampling, "WORDS", 7)
    total = sum(int(table.count.sum()) for table, _, _ in resampling._interned(words))
    assert total == sum(len(features_of(t)) for t in TEXTS)


def test_packed_buckets_come_back():
    owner = RNG.integers(0, 30, 4000) * 2  # every other text has none
    bucket = np.where(RNG.random(4000) < 0.3, RNG.integers(0, 10_000, 4000), RNG.choice([0, 254, 255, 256, 510, 9_999], 4000))
    texts, found = resampling.unpacked(resampling.packed(owner, bucket, 61))
    assert sorted(zip(texts.tolist(), found.tolist())) == sorted(zip(owner.tolist(), bucket.tolist()))
    empty = resampling.packed(owner[:0], bucket[:0], 3)
    assert empty == [b""] * 3 and [len(x) for x in resampling.unpacked(empty)] == [0, 0]


def test_resampling_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(docs, items).collect() == []
    some = spark.createDataFrame([(1, prose(30)), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in resampling.resampled(some, items).collect()) == brute_resampled([(1, some.first()["text"]), (2, "")], [])


# Ranked search -------------------------------------------------------------------------------

def brute_search(rows, items, top=10):
    counts = [(doc, Counter(words_of(text))) for doc, text in rows]
    counts = [(doc, c) for doc, c in counts if c]
    n_all, l_all = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_all + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 25 + 75 * c.total() * n_all // l_all
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in words_of(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def test_search_matches_brute_force(spark, folder):
    got = op13_search(spark, folder)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(stored(spark, folder), stored(spark, folder, "benchmark", "item_id"))


@pytest.mark.parametrize("block_docs, group_words", [(4, 20), (1000, 1)])
def test_blocks_and_groups_change_nothing(spark, folder, block_docs, group_words):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = search.searched(docs, items, top=7, block_docs=block_docs, group_words=group_words).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_search(stored(spark, folder), stored(spark, folder, "benchmark", "item_id"), 7)


def test_best_first_search_scores_few_of_many_copies():
    """Thousands of equal documents: the smallest ids are found without scoring the others."""
    n = 4000
    docs = np.arange(n)
    row = {"ids": docs.astype("<i8"), "sizes": np.full(n, 9, "<i8"), "lists": np.array([0, 1], "<i4"), "begins": np.array([0, n, 2 * n], "<i4"),
           "owners": np.concatenate((docs, docs)).astype("<u4"), "tfs": np.ones(2 * n, "<u4")}
    block = search.Block({k: v.tobytes() for k, v in row.items()}, n, 9 * n, 2)
    seen, real = [], search.Block.greatest

    def counting(self, low, high):
        seen.append(len(low))
        return real(self, low, high)

    search.Block.greatest = counting
    try:
        best = search.best_of(block, search.Query("a b", {}), np.array([5, 7]), 10, [], step=1)
    finally:
        search.Block.greatest = real
    assert sorted(-i for _, i in best) == list(range(10)) and sum(seen) < 60


def test_greatest_impact_of_every_range():
    tfs = RNG.integers(1, 9, 57)
    row = {"ids": np.arange(57, dtype="<i8"), "sizes": np.full(57, 30, "<i8"), "lists": np.array([0], "<i4"), "begins": np.array([0, 57], "<i4"),
           "owners": np.arange(57, dtype="<u4"), "tfs": tfs.astype("<u4")}
    block = search.Block({k: v.tobytes() for k, v in row.items()}, 57, 57 * 30, 1)
    low, high = np.triu_indices(58)
    value, place = block.greatest(low, high)
    for a, b, v, p in zip(low.tolist(), high.tolist(), value.tolist(), place.tolist()):
        assert v == max(block.impact[a:b].tolist(), default=0) and (a == b or block.impact[p] == v and a <= p < b)


def test_search_of_empty_tables(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert search.searched(docs.where(F.lit(False)), items).collect() == []
    assert search.searched(docs, items.where(F.lit(False))).collect() == []
    assert search.searched(docs, spark.createDataFrame([("q", "%%%")], "item_id string, text string")).collect() == []
