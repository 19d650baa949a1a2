"""Text as column expressions: pages to text, redaction, readability, relevance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Personal-data patterns.
PII = {"aadhaar": r"\b\d{4}\s?\d{4}\s?\d{4}\b", "indian_mobile": r"\b(?:\+?91[\-\s]?)?[6-9]\d{9}\b", "email": r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b", "pan": r"\b[A-Z]{5}\d{4}[A-Z]\b"}
#: Terms of court language that a summary must not hold.
LEGALESE = ["stayed proceedings", "vide order", "learned counsel", "the instant matter", "quashed the proceedings", "aforesaid", "hereinafter", "prima facie", "cognizance", "petitioner", "petitioners", "respondent", "respondents", "u/s", "r/w"]
#: Charge statutes that make a judgment relevant.
STATUTES = [
    r"\bPOCSO\b", r"\bBNS\b[^\n]{0,20}?\b(?:6[3-9]|7[0-9])\b", r"\b(?:6[3-9]|7[0-9])\b[^\n]{0,8}?\bBNS\b", r"\bIPC\b[^\n]{0,20}?\b(?:37[56][A-E]?|354[A-D]?)\b", r"\b(?:37[56][A-E]?|354[A-D]?)\b[^\n]{0,8}?\bIPC\b",
    r"\b(?:u/s\.?|under\s+section[s]?|section[s]?)\s*(?:37[56][A-E]?|354[A-D]?)\b", r"\bgang[\s-]?rape\b", r"\b(?:penetrative|aggravated)\s+sexual\s+assault\b", r"\boutrag(?:e|ing)\s+(?:the|her)\s+modesty\b",
]


def strip_html(html: Column, most: int = 20_000) -> Column:
    """A page's text: scripts, styles and tags go, white space shrinks, at most ``most`` characters."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    return F.substring(F.trim(F.regexp_replace(t, r"\s+", " ")), 1, most)


#: All personal data has a digit or this sign; a text without either needs no closer look.
_MARKS = "[0-9@]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def redact(text: Column) -> Column:
    """The text with a mark for each piece of personal data."""

    def each(t: Column) -> Column:
        out = t
        for pattern in PII.values():
            out = F.regexp_replace(out, pattern, "[redacted]")
        return F.when(t.rlike(_MARKS), out).otherwise(t)

    return bound(text, each)


def pii_hits(text: Column) -> Column:
    """The names of the kinds of personal data in the text, in fixed order."""
    none = F.array().cast("array<string>")
    return bound(text, lambda t: F.when(t.rlike(_MARKS), F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in PII.items()]))).otherwise(none))


def native_script(text: Column) -> Column:
    return text.rlike(r"[ऀ-ൿ]")


def statute_hit(text: Column) -> Column:
    return text.rlike("(?i)" + "|".join(STATUTES))


def readability_violations(summary: Column, most: int = 25) -> Column:
    """Reasons in order: terms, sections in prose, overlong sentences."""
    words = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(summary, F.lit(r"(?i)\b(" + "|".join(sorted(LEGALESE, key=len, reverse=True)) + r")\b"), F.lit(1)), lambda w: F.lower(w))))
    section = summary.rlike(r"(?i)\bunder\s+section\b|\bsection\s+\d|\b\d{2,4}[A-Za-z]?\s*(?:IPC|BNS|BNSS|POCSO)\b|\b(?:IPC|BNS|BNSS|POCSO)\s*\d")
    sizes = F.filter(F.transform(F.split(summary, r"[.!?]+"), lambda s: F.size(F.filter(F.split(s, r"\s+"), lambda w: w != ""))), lambda n: n > most)
    return F.concat(F.transform(words, lambda w: F.concat(F.lit("legalese term '"), w, F.lit("'"))), F.when(section, F.array(F.lit("cites a statute section by number in prose"))).otherwise(F.array().cast("array<string>")), F.transform(sizes, lambda n: F.concat(F.lit(f"sentence exceeds {most} words ("), n.cast("string"), F.lit(")"))))
