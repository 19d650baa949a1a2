"""Traces of persons in free text: ages, relationships, occupations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

#: Ways to tell an age.
AGES = {
    "numeric_years_old": r"\b\d{1,2}\s*[-–]?\s*(?:year|yr)s?[\s\-–]*old\b", "aged_number": r"\bage[d]?\s+\d{1,2}\b", "descriptor_number": r"\b(?:minor|girl|boy|child|student|victim|woman|man|male|female)\s+(?:aged\s+)?\d{1,2}\b",
    "school_class": r"\bclass\s+(?:[IVX]{1,4}|\d{1,2})\b", "ordinal_standard": r"\b\d{1,2}(?:st|nd|rd|th)\s+(?:standard|std|grade|class)\b", "teenager_word": r"\b(?:teenage[rd]?|adolescent)\b",
    "spelled_years_old": r"\b(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty)[\s\-](?:year|yr)s?[\s\-–]*old\b",
}
#: Words for how two persons are related.
RELATIONS = (
    "husband", "wife", "spouse", "father", "mother", "brother", "sister", "son", "daughter", "uncle", "aunt", "cousin", "nephew", "niece", "grandfather", "grandmother", "grandson", "granddaughter",
    "in-law", "in-laws", "father-in-law", "mother-in-law", "brother-in-law", "sister-in-law", "son-in-law", "daughter-in-law", "stepfather", "stepmother", "stepson", "stepdaughter", "step-father",
    "step-mother", "guardian", "relative", "neighbour", "neighbor", "boyfriend", "girlfriend", "fiance", "fiancee", "fiancé", "fiancée", "partner",
)
#: Occupations.
OCCUPATIONS = (
    "cabin crew member", "cabin crew", "crew member", "air hostess", "flight attendant", "stewardess", "nurse", "doctor", "teacher", "tutor", "lecturer", "professor", "student", "scholar", "intern",
    "software engineer", "software professional", "it professional", "it employee", "techie", "bpo employee", "call centre employee", "call center employee", "engineer", "developer", "programmer",
    "architect", "receptionist", "secretary", "accountant", "cashier", "tailor", "beautician", "hairdresser", "singer", "dancer", "actress", "actor", "journalist", "reporter", "news anchor",
    "housemaid", "housekeeper", "domestic worker", "domestic help", "labourer", "laborer", "vendor", "hawker", "shopkeeper", "waitress", "bartender", "homemaker", "housewife", "anganwadi worker",
    "asha worker", "sex worker", "sales girl", "salesgirl", "saleswoman", "maid",
)
#: Institutions that may follow an occupation, and verbs and nouns that tell whose it is.
INSTITUTIONS = (
    "school", "college", "university", "institute", "academy", "hospital", "hostel", "factory", "mill", "company", "firm", "office", "clinic", "salon", "parlour", "showroom", "mall", "hotel",
    "restaurant", "airlines?",
)
SUFFERED = r"\b(?:rape[ds]?|gang[\s-]?rape[ds]?|assault(?:ed|ing)?|molest(?:ed|ing)?|attack(?:ed|ing)?|abus(?:ed|ing)|violat(?:ed|ing)|sodomi[sz](?:ed|ing))\b"
CHARGED = r"\b(?:arrested|booked|convicted|held|detained|apprehended|nabbed|remanded|jailed|imprisoned|sentenced|charged|chargesheeted|absconding)\b"
ACCUSED = r"\b(?:accused|convict|convicts|offender|perpetrator|rapist|molester|assailant|attacker|abuser|defendant|appellant|culprit|suspect)\b"
#: Fixed value: what stands for an occupation afterwards.
OCCUPATION_MARK = "[occupation withheld]"
#: Characters on each side of an occupation in which verbs and nouns count.
CONTEXT = 30


def age_hits(text: Column) -> Column:
    """Names of the ways in which the text tells an age, in fixed order."""
    return F.array_compact(F.array(*[F.when(text.rlike("(?iU)" + p), F.lit(n)) for n, p in AGES.items()]))


def relations(text: Column) -> Column:
    """Words of relationship in the text, as written, in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"(?iU)\b(" + "|".join(map(re.escape, RELATIONS)) + r")\b"), 1), F.array().cast("array<string>"))


def identity_detail(minor: Column, *texts: Column) -> Column:
    """Whether a case without a minor tells an age or a relationship in one of its texts."""
    found = [(F.size(age_hits(t)) > 0) | (F.size(relations(t)) > 0) for t in (F.coalesce(t, F.lit("")) for t in texts)]
    return ~F.coalesce(minor, F.lit(False)) & F.exists(F.array(*found), lambda x: x)


def occupation_spans(text: str) -> list[tuple[int, int]]:
    """Where the text tells what a victim does for a living; the accused's own occupation is none.

    A verb of suffering just before decides first; then whichever of suffering and charging comes first after it;
    then a noun for the accused just before. What nothing decides counts as the victim's.
    """
    out = []
    for m in _PHRASE.finditer(text):
        before, after = text[max(0, m.start() - CONTEXT) : m.start()], text[m.end() : m.end() + CONTEXT]
        if not _SUFFERED.search(before):
            suffered, charged = _SUFFERED.search(after), _CHARGED.search(after)
            if charged and (suffered is None or charged.start() < suffered.start()):
                continue
            if suffered is None and _ACCUSED.search(before):
                continue
        out.append(m.span())
    return out


_SUFFERED, _CHARGED, _ACCUSED = (re.compile(p, re.I) for p in (SUFFERED, CHARGED, ACCUSED))
#: Fixed value: an occupation, with its article and employer before and its institution after.
_PLACE = r"[\w.&'-]+"
_PHRASE = re.compile(
    rf"(?:\b(?:a|an|the)\s+(?:{_PLACE}\s+){{0,3}})?\b(?:{'|'.join(map(re.escape, OCCUPATIONS))})\b(?:\s+(?:at|in|of|with|for)\s+{_PLACE}(?:\s+{_PLACE}){{0,4}}?\s+(?:{'|'.join(INSTITUTIONS)}))?",
    re.I,
)


_OCCUPIED = re.compile("|".join(map(re.escape, OCCUPATIONS)), re.I)


@F.pandas_udf(StringType())
def without_occupations(texts: pd.Series) -> pd.Series:
    """The texts with a mark for each victim's occupation; null stays null."""

    def one(text):
        if text is None or not _OCCUPIED.search(text):
            return text
        parts, at = [], 0
        for begin, end in occupation_spans(text):
            parts += [text[at:begin], OCCUPATION_MARK]
            at = end
        return "".join([*parts, text[at:]])

    return texts.map(one)
