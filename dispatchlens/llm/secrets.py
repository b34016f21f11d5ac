"""Secrets: strong patterns, and weak parts of credentials that are reported only where complementary parts lie near.

Null texts count as empty. Strong kinds are leftmost and non-overlapping; one that fails its length is dropped without
another try. Weak parts are linked by an interval join within a document: parts are near if at most SCOPE characters lie between the
end of one and the start of the other, seen from the last end before and the first start after by role, so that no pairs are written. A weak secret needs an identifier in its scope, an identifier a secret,
an endpoint both. Rows that repeat an id and a text give as many equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.text import identified, with_spans

SCOPE = 240
_VALUE = "[\"']?\\x20*[:=]\\x20*[\"']?"
PATTERNS = {
    "assign": "(?i:password|passwd|secret|token|api_?key)" + _VALUE + "[A-Za-z0-9+/_.=-]+",
    "access": "AKIA[A-Z0-9]{14,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{16,}+",
    "identifier": "(?<![A-Za-z])(?i:user(?:name)?|login|client_?id|account_?id|access_key_id)" + _VALUE + "[A-Za-z0-9._@-]{3,}+",
    "weak_secret": "(?<![A-Za-z])(?i:pass|pwd|pin|secret|private_key|key|credential)" + _VALUE + "[A-Za-z0-9+/_.=!-]{6,}+",
    "endpoint": "(?<![A-Za-z])(?i:https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\\x00-\\x20\"'<>]++"
                "|(?<![A-Za-z])(?i:host|endpoint|server)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
}
BASE = ("assign", "access", "hex")
#: Which part of a credential a kind is.
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "weak_secret": "secret", "endpoint": "endpoint"}
KEYS = "^(?i:password|passwd|secret|token|api_?key)" + _VALUE


def _parts(found: DataFrame) -> DataFrame:
    """One row for each part, and one of kind null for the document itself."""
    def part(rank, kind):
        return lambda s: F.struct(F.lit(kind).cast("string").alias("kind"), F.lit(rank).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"))

    none = F.lit(None).cast("long")
    arrays = [F.array(part(-1, None)({"start": none, "stop": none}))]
    for rank, kind in enumerate(PATTERNS):
        spans = F.col(kind)
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(F.regexp_replace(s["hit"], KEYS, "")) >= 12)
        arrays.append(F.transform(spans, part(rank, kind)))
    return found.select("doc_id", "_hash", F.inline_outer(F.concat(*arrays)))


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, _hash, copies, spans) for each id and text."""
    parts = _parts(with_spans(identified(docs), PATTERNS))
    whole = Window.partitionBy("doc_id", "_hash")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    back, ahead = whole.orderBy("start").rangeBetween(*so_far), whole.orderBy(F.desc("start")).rangeBetween(*so_far)

    def beside(role):
        kinds = [k for k, r in ROLES.items() if r == role]
        own = F.col("kind").isin(kinds)
        last_stop, next_start = F.max(F.when(own, F.col("stop"))).over(back), F.min(F.when(own, F.col("start"))).over(ahead)
        return F.coalesce(last_stop >= F.col("start") - SCOPE, F.lit(False)) | F.coalesce(next_start <= F.col("stop") + SCOPE, F.lit(False))

    parts = parts.select("*", beside("identifier").alias("has_identifier"), beside("secret").alias("has_secret"))
    linked = (F.when(F.col("kind").isin(*BASE), True).when(F.col("kind") == "weak_secret", F.col("has_identifier"))
              .when(F.col("kind") == "identifier", F.col("has_secret")).otherwise(F.col("has_identifier") & F.col("has_secret")))
    span = F.when(F.col("kind").isNotNull() & linked, F.struct("start", "rank", "kind", "stop"))
    return parts.groupBy("doc_id", "_hash").agg(F.count(F.when(F.col("kind").isNull(), 1)).cast("int").alias("copies"),
                                                F.array_sort(F.collect_set(span)).alias("spans"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for each row: spans of (start, rank, kind, stop), by start and then by kind as in PATTERNS."""
    return _grouped(docs).select("doc_id", "spans", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")


def _masked(text: Column, spans: Column) -> Column:
    """The text with its spans, those that overlap taken together, replaced by the first one's kind."""
    def merge(got, s):
        last = F.element_at(got, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"), last["kind"].alias("kind"))
        fresh = F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        joins = s["start"] < last["stop"]
        return F.when(joins, F.array_append(F.slice(got, F.lit(1), F.size(got) - 1), longer)).otherwise(F.array_append(got, fresh))

    nothing = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"), F.lit("").alias("kind"))
    merged = F.aggregate(spans, F.array(nothing), merge)

    def piece(s, i):
        stop = F.when(i + 1 < F.size(merged), F.get(merged, i + 1)["start"]).otherwise(F.length(text))
        mark = F.when(s["kind"] == "", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        return F.concat(mark, F.substring(text, (s["stop"] + 1).cast("int"), (stop - s["stop"]).cast("int")))

    return F.array_join(F.transform(merged, piece), "")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every reported span of its texts masked; a null text stays null, n_chars follows where it exists."""
    spans = _grouped(docs).where(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_text"), F.col("spans").alias("_spans"))
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    held = docs.join(spans, docs["doc_id"].eqNullSafe(spans["_id"]) & (own == spans["_text"]), "left")
    clean = F.when(spans["_spans"].isNull(), docs["text"]).otherwise(_masked(docs["text"], spans["_spans"]))
    new = {"text": clean, "n_chars": F.when(spans["_spans"].isNull(), docs["n_chars"]).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": clean}
    return held.select(*(new[c].alias(c) if c in new else docs[c] for c in docs.columns))
