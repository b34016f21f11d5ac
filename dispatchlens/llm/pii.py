"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Texts that are null count as empty. Matches are leftmost and non-overlapping within a kind; a proposal whose check fails is
dropped without another try at the same characters. Kinds may overlap one another. Repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.text import identified, with_spans

AROUND = 48
THRESHOLD = 0.5
#: Characters of an account number by country, as registered; those of other codes are taken as far as they go.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
_IBAN = "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
#: Possessive forms, and a start only where a run starts, keep each search linear in the text. After a match that ends
#: inside a run, \G lets the rest of the run be searched.
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}+",
    "card": "[0-9](?:[\\x20-]?[0-9]){12,}+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "iban": f"(?<![A-Za-z0-9])(?:{_IBAN}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])",
    "national_id": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": "(?<![0-9+().-])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9-])",
    "spelled_email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\\x20?[(\\[]at[)\\]]\\x20?[A-Za-z0-9-]++(?:(?:\\.|\\x20?[(\\[]dot[)\\]]\\x20?)[A-Za-z0-9-]++)++",
}
BASE = ("email", "ip", "card", "phone")
#: Score before context, and the words near a span that raise it.
PRIORS = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.3, "local_phone": 0.3, "spelled_email": 0.6}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "\\bip\\b|address|server|host|login|visitor",
    "card": "card|visa|master|credit|debit|karte|tarjeta|carte|payment",
    "phone": "phone|tel|call|mobile|fax|anruf|llam|appel",
    "iban": "iban|account|bank|konto|cuenta|compte|transfer",
    "national_id": "\\bssn\\b|social security|national id|tax id|personal number",
    "local_phone": "phone|\\btel|call|mobile|fax|anruf|llam|appel",
    "spelled_email": "mail|contact|write|kontakt|correo|courriel",
}
#: Words that say a number is something else.
AGAINST = "\\border\\b|invoice|version|isbn|part no|serial|\\bsku\\b|example only"
STEP = 0.3


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _mod97(hit: Column) -> Column:
    """The remainder of the account number, its first four characters moved to the end and letters read as 10 to 35."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    def step(rest, char):
        code = F.ascii(char)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _valid(kind: str, hit: Column) -> Column | None:
    digits = _digits(hit)
    if kind == "ip":
        return F.forall(F.split(hit, "\\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return (F.length(digits) <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return _mod97(hit) == 1
    if kind == "national_id":
        return ~hit.rlike("^(000|666|9)|-00-|-0000$")
    return None


def _scored(kind: str) -> Column:
    """The kind's valid spans with their score; an added kind must reach the threshold, a base one always stays."""
    def span(s):
        near = F.lower(F.concat_ws(" ", s["before"], s["after"]))
        score = F.lit(PRIORS[kind]) + F.when(near.rlike(CONTEXT[kind]), STEP).otherwise(0.0) - F.when(near.rlike(AGAINST), STEP).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                        F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))

    def passes(s):
        return _valid(kind, s["hit"])

    spans = F.col(kind) if _valid(kind, F.lit("")) is None else F.filter(kind, passes)
    spans = F.transform(spans, span)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans): spans of (kind, start, stop, score), by kind as in PATTERNS and then by start; whole texts."""
    found = with_spans(identified(docs).drop("_hash"), PATTERNS, AROUND)
    return found.select("doc_id", "text", F.concat(*(_scored(kind) for kind in PATTERNS)).alias("spans"))
