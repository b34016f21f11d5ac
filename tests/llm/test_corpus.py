"""The pipeline and the near-copy join over awkward tables, against brute force."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from dispatchlens.llm import jaccard
from dispatchlens.llm.queries import PIECES, op9_jaccard, pipeline

RNG = np.random.default_rng(12)
NAMES = [f"{a}{b}" for a in "ba ke lo mi nu ra so ti vu ze".split() for b in "dan fel gor hix jum pak ros tin vel wob".split()]


def prose(n):
    return " ".join(RNG.choice(NAMES, n))


def edited(text, n):
    words = text.split()
    for at in RNG.choice(len(words), n, replace=False):
        words[at] = f"x{int(RNG.integers(10**6))}"
    return " ".join(words)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(texts):
    """{id: least id reachable} by comparing all pairs; ids are places."""
    own = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(own)):
        for b in range(a):
            if own[a] and own[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in range(len(own))}


def near_copies():
    """A large group of copies with edits around the limit, a chain of small steps, a shared passage, exact copies and odd rows."""
    base, passage = prose(150), prose(50)
    texts = [edited(base, int(n)) for n in RNG.integers(0, 5, 90)]
    step = prose(100)
    for _ in range(12):
        step = edited(step, 1)
        texts.append(step)
    texts += [prose(60) + " " + passage + " " + prose(60) for _ in range(80)]
    texts += [texts[3]] * 9 + [texts[3].upper(), "", " ", "one two", "one two", "one two three four five", None, prose(3000)]
    return texts


@pytest.mark.parametrize("many, long, partners", [(64, 256, 512), (4, 8, 3), (10**6, 2, 512)])
def test_components_of_near_copies(spark, tmp_path, monkeypatch, many, long, partners):
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "LONG", long)
    monkeypatch.setattr(jaccard, "PARTNERS", partners)
    global RNG
    RNG = np.random.default_rng(12)
    texts = near_copies()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op9_jaccard(spark, str(tmp_path)).collect()}
    want = components(texts)
    assert len({c for c in want.values()}) > 60  # the group falls into several components
    assert got == {i: (len(shingles(t)), want[i]) for i, t in enumerate(texts)}


def test_packed_tokens_come_back():
    tokens = jaccard.shingles(prose(300).encode())
    assert (jaccard._unpacked(jaccard._packed(tokens)) == tokens).all() and len(jaccard._unpacked(b"")) == 0


# The pipeline --------------------------------------------------------------------------------

KEY = "AKIA" + "Q" * 16


def corpus():
    """Texts of every kind a stage decides on, by name."""
    item = prose(14)
    good = {f"good{i}": prose(60) for i in range(12)}
    copies = {f"copy{i}": edited(good["good0"], 1) for i in range(3)} | {"same": good["good1"]}
    bad = {"short": prose(49), "none": None, "empty": "", "repeats": "a b c " * 30, "symbols": "### " * 10 + prose(52), "lines": "one line\n" * 20 + prose(55)}
    leaked = {"leak": prose(40) + " " + item.upper() + " " + prose(40), "part": prose(40) + " " + " ".join(item.split()[:9]) + " " + prose(40)}
    secret = {"key": prose(60) + f" {KEY} end", "hex": prose(60) + " 0123456789abcdef0 é"}
    return good | copies | bad | leaked | secret, item


def test_pipeline_matches_brute_force(spark, tmp_path):
    texts, item = corpus()
    names = list(texts)
    rows = [(i, texts[n], "en", "s", len(texts[n] or ""), "clash") for i, n in enumerate(names)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {names[r["doc_id"]]: r for r in pipeline(spark, str(tmp_path)).collect()}

    kept = [n for n in names if n not in ("short", "none", "empty", "repeats", "symbols", "lines")]
    label = components([texts[n] for n in kept])
    kept = [n for i, n in enumerate(kept) if label[i] == i]
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", t.lower())
    windows = {tuple(words(item)[i:i + 10]) for i in range(5)}
    kept = [n for n in kept if not windows & {tuple(words(texts[n])[i:i + 10]) for i in range(len(words(texts[n])))}]
    assert set(got) == set(kept) and not {"copy0", "copy1", "copy2", "same", "leak"} & set(got) and "part" in got
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    for n in kept:
        text = texts[n].replace(KEY, "<access>").replace("0123456789abcdef0", "<hex>")
        ids = np.array(model.encode(text), "<u4")
        assert (got[n]["n_tokens"], got[n]["ids_crc32"], got[n]["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    spark.createDataFrame([(1, prose(60), "x")], "doc_id long, text string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
