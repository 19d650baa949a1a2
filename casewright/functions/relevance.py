"""Whether a document might report an offence, by terms in several languages; the terms are given, not built in."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from casewright.functions.text import statute_hit

#: English terms that are enough to try the filter; a deployment gives its own, in all its languages.
ENGLISH = ("rape", "raped", "gang rape", "gang-rape", "gangrape", "molested", "molestation", "sexual assault", "sexual harassment", "sexually assaulted", "sexually abused", "child abuse", "child sexual", "outraging modesty", "eve teasing", "stalking", "voyeurism", "acid attack", "disrobed", "minor girl", "minor boy", "pocso")


def roman_pattern(terms: Iterable[str]) -> str:
    """Any of the terms, whatever its case, not next to another Latin letter; longer terms first."""
    return "(?i)(?<![a-z])(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + ")(?![a-z])"


def _native(text: Column, terms: Iterable[str]) -> Column:
    parts = [re.escape(t) for t in sorted(terms, key=len, reverse=True)]
    return text.rlike("|".join(parts)) if parts else F.lit(False)


def media_hit(text: Column, roman: Iterable[str] = ENGLISH, native: Mapping[str, Iterable[str]] | None = None) -> Column:
    """Whether the text has a Latin term as whole words, a term in a native script anywhere, or names a statute; false for null.

    Recall counts: a hit means that the document is read closely, not that it is in scope.
    """
    every = [t for terms in (native or {}).values() for t in terms]
    return F.coalesce(text.rlike(roman_pattern(roman)) | _native(text, every) | statute_hit(text), F.lit(False))


def term_languages(text: Column, native: Mapping[str, Iterable[str]]) -> Column:
    """The languages, in the order given, whose native terms the text has."""
    return F.array_compact(F.array(*[F.when(F.coalesce(_native(text, terms), F.lit(False)), F.lit(n)) for n, terms in native.items()])) if native else F.array().cast("array<string>")


#: Fixed value: offences by name, for hits whose snippet names no section.
NAMED = r"(?i)\b(?:rape|pocso|sexual\s+assault|sexual\s+offence|molest\w*|gang[\s-]?rape|outrag\w+\s+\w*\s*modesty)\b"


def hit_qualifies(title: Column, headline: Column) -> Column:
    """Whether a search hit's title or headline names a statute or an offence: only then is the judgment fetched."""
    both = F.concat_ws(" ", title, headline)
    return F.coalesce(statute_hit(both) | both.rlike(NAMED), F.lit(False))
