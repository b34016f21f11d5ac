"""Cases that a cut of the job would miss."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from dispatchlens.llm import html, lm, pii, secrets
from dispatchlens.llm.queries import MULTI_BPE


def test_language_model_learns_from_every_document(spark):
    """A first document of over 200,000 ids doesn't keep the later ones out of the model."""
    words = "river stone cloud window garden paper table horse".split()
    phrase = "quick brown foxes jump over lazy dogs today".split()
    rng = np.random.default_rng(0)
    rows = [(0, " ".join(rng.choice(words, 210_000)))] + [(i, " ".join(phrase * 40)) for i in range(1, 120)]
    rows += [(-1, " ".join(phrase * 3)), (-2, " ".join(phrase[::-1] * 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in lm.scored(docs, F.col("doc_id") < 0, public_tokenizers.path(MULTI_BPE)).collect()}
    assert got[-1]["base_score"] == got[-2]["base_score"]
    assert got[-1]["score"] > got[-2]["score"] + 3


def test_batches_hold_every_id():
    blocks = [b for n in (0, 5, 20_000, 31, 150_000) for b in lm._blocks(np.arange(n, dtype="<u2"))]
    pairs = [(x, y) for b in blocks for x, y in zip(b[:-1].tolist(), b[1:].tolist(), strict=True)]
    seen = [(x, y) for first, then in lm._batches(blocks) for x, y in zip(first.reshape(-1).tolist(), then.reshape(-1).tolist(), strict=True)]
    assert set(seen) == set(pairs) and 0 <= len(seen) - len(pairs) < lm.WINDOW


def test_weights_as_rows_come_back():
    model = lm.Attention.started(np.arange(100))
    back = lm.from_rows(lm.as_rows(model.w))
    assert all((back[k] == v).all() for k, v in model.w.items())


def test_repeated_boilerplate_in_the_container_is_left_out(spark):
    """A box of an unlisted class on all pages of a host is a constant; what differs, or stands on one page copied often, stays."""
    def page(i):
        return f"<html><body><main><h1>Title {i}</h1><div class=x7>Subscribe to our letter</div><p>Story number {i} is long enough.</p></main></body></html>"

    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(8)]
    rows += [(100 + i, f"http://b.example/{i}", page(77)) for i in range(9)] + [(200, "http://b.example/x", page(78))]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[i] == f"Title {i}\nStory number {i} is long enough." for i in range(8))
    assert got[103] == "Title 77\nSubscribe to our letter\nStory number 77 is long enough."


def test_account_numbers_end_by_country_and_lists_share_context(spark):
    texts = ["DE89 3704 0044 0532 0130 00 BIC: COBADEFF", "DE89370400440532013000 EUR 500", "to DE89 3704 0044 0532 0130 00 Bank", "NO93 8601 1117 947 NOK",
             "DE89370400440532013001 EUR", "SSN 123-45-6789, 123-45-6780", "call 212-555-0100, 212-555-0101, 212-555-0102", "123-45-6789, 123-45-6780"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"]:s["stop"]]) for s in r["spans"] if s["kind"] not in pii.BASE] for r in pii.find_pii(docs).collect()}
    spaced, whole = ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "DE89370400440532013000")
    assert [got[i] for i in range(5)] == [[spaced], [whole], [spaced], [("iban", "NO93 8601 1117 947")], []]
    assert got[5] == [("national_id", "123-45-6789"), ("national_id", "123-45-6780")]
    assert got[6] == [("local_phone", f"212-555-010{k}") for k in range(3)] and got[7] == []


def test_context_is_the_text_on_either_side(spark):
    from dispatchlens.llm.text import with_spans

    text = "é call " + "12345 " * 40 + "x" * 60 + "12345 end"
    row = with_spans(spark.createDataFrame([(text,)], "text string"), {"n": "[0-9]{5}"}, 48).first()
    assert len(row["n"]) == 41
    assert all((s["before"], s["after"]) == (text[max(0, s["start"] - 48):s["start"]], text[s["stop"]:s["stop"] + 48]) for s in row["n"])


def test_parts_are_linked_over_a_long_value(spark):
    """The scope is what lies between two parts, not their own length."""
    far = " " * (secrets.SCOPE + 1)
    value = "token=" + "Z" * 400
    texts = [f"{value} user=alice", f"{value} user=alice host: db.example.org", f"{value}{far}user=alice", f"{value}{far[:-1]}user=alice"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
    assert got == {0: ["assign", "identifier"], 1: ["assign", "identifier", "endpoint"], 2: ["assign"], 3: ["assign", "identifier"]}


def test_language_model_scores_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(2)
    words = "river stone cloud window garden paper table horse".split()
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(1, 80))))) for i in range(60)] + [(60, None), (61, ""), (7, "river stone"), (7, "river stone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for parts in (1, 5):
        scored = lm.scored(docs.repartition(parts), F.col("doc_id") % 7 == 2, public_tokenizers.path(MULTI_BPE)).collect()
        got.append(sorted((tuple(r) for r in scored), key=repr))
    assert len(got[0]) == 64
    for a, b in zip(*got, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 2e-3


def test_language_model_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.scored(docs, F.lit(False), public_tokenizers.path(MULTI_BPE)).collect() == []
    held = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [r["train_tokens"] for r in lm.scored(held, F.lit(True), public_tokenizers.path(MULTI_BPE)).collect()] == [0, 0]


def test_fingerprints_joined_by_a_shuffle_give_the_same(spark):
    from dispatchlens.llm import decontaminate

    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)]
    item = " ".join(rng.choice(words, 30))
    texts = [None, "", item, " ".join(rng.choice(words, 300)) + " " + item, item[:90] + " " + item, " ".join(rng.choice(words, 5000)), "w1 w2 w3", "w3 w1 w2 w3"]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "w1 w2 w3"), (3, None), (4, " ".join(words[:12]))], "item_id long, text string")
    one, other = (sorted(map(repr, decontaminate.contaminated(docs, bench, n).collect())) for n in (200_000, 0))
    assert one == other and len(one) == 10
    plan = decontaminate._grouped(docs, bench, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan
