"""Registered queries of the text operators: each applies one to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.llm import decontaminate, fingerprints, html, jaccard, lm, pieces, pii, quality, resampling, search, secrets, tokens, toxicity
from dispatchlens.llm.shipping import ship
from dispatchlens.llm.text import digest, joined

#: Vocabulary files, by name in the folder of public tokenizers.
BYTE_BPE, MULTI_BPE, PIECES = "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(number: int) -> Column:
    """crc32 of the id's text, modulo a number; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % number


def _counts(kinds, spans: Column) -> list[Column]:
    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(kind) for kind in kinds]


def op1_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *_counts(pii.BASE, F.col("spans")), digest(joined(base)).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        *_counts([k for k in pii.PATTERNS if k not in pii.BASE], F.col("spans")),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score"))


def op2_secrets(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *_counts(secrets.BASE, F.col("spans")), digest(joined(base)).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        *_counts([k for k in secrets.PATTERNS if k not in secrets.BASE], F.col("spans")))


def op3_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_lm(spark, sf_dir):
    return lm.scored(table(spark, sf_dir, "documents"), crc_fold(7) == 2, public_tokenizers.path(MULTI_BPE))


def op5_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark, sf_dir):
    return decontaminate.report(decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_tokens(spark, sf_dir):
    return tokens.read(spark, tokens.write(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)))


def op9_jaccard(spark, sf_dir):
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold(5) == 0, F.lit(False))
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.score(docs, grammar).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


def op11_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op12_resampling(spark, sf_dir):
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_search(spark, sf_dir):
    return search.searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii, "op2_secrets": op2_secrets, "op3_sentencepiece": op3_sentencepiece, "op4_lm": op4_lm, "op5_html": op5_html,
    "op6_quality": op6_quality, "op7_decontaminate": op7_decontaminate, "op8_tokens": op8_tokens, "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity, "op11_fingerprints": op11_fingerprints, "op12_resampling": op12_resampling, "op13_search": op13_search,
    "pipeline": pipeline,
}
