"""Traces of persons in Indian languages: native scripts, ages written in them, and romanised words that survive in English prose."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from casewright.functions.text import bound

#: The Unicode block of each script.
SCRIPTS = {
    "devanagari": ("ऀ", "ॿ"), "bengali": ("ঀ", "৿"), "gurmukhi": ("਀", "੿"), "gujarati": ("઀", "૿"), "oriya": ("଀", "୿"),
    "tamil": ("஀", "௿"), "telugu": ("ఀ", "౿"), "kannada": ("ಀ", "೿"), "malayalam": ("ഀ", "ൿ"),
}
#: Each language's digits zero and nine, and its words for years of age.
AGE_WORDS = {
    "hindi": ("०९", ("साल", "वर्ष", "बरस", "वर्षीय", "वर्षीया")),
    "telugu": ("౦౯", ("ఏళ్ల", "ఏళ్ళ", "ఏళ్లు", "సంవత్సరాల", "సంవత్సరాలు")),
    "tamil": ("௦௯", ("வயது", "வயதான", "ஆண்டு")),
    "bengali": ("০৯", ("বছর", "বছরের", "বয়স", "বয়সী")),
    "malayalam": ("൦൯", ("വയസ്സ്", "വയസ്", "വർഷം")),
    "kannada": ("೦೯", ("ವರ್ಷ", "ವಯಸ್ಸು", "ವರ್ಷದ")),
    "gujarati": ("૦૯", ("વર્ષ", "વર્ષની", "વરસ")),
    "punjabi": ("੦੯", ("ਸਾਲ", "ਵਰ੍ਹੇ")),
    "odia": ("୦୯", ("ବର୍ଷ", "ବର୍ଷର")),
}
#: Romanised words of kinship that are no English words.
KINSHIP = (
    "chacha", "chachi", "chacha ji", "taya", "tayi", "phupha", "phupa", "phuphi", "phua", "mausa", "mausi", "mama ji", "jija", "jiju", "bhabhi", "devar", "devrani", "nanad", "jethani", "mausera", "chachera", "mamera", "fufera",
    "mama garu", "pinni", "babai", "peddananna", "chinnanna", "bavagaru", "menamama", "menatha", "chithappa", "periyappa", "athimber", "mavshi", "jamai",
)
#: Words of kinship that English has too, by the language that makes them plain.
KINSHIP_OF = {
    "hindi": ("mama", "mami", "bua", "dada", "dadi", "nana", "nani", "didi", "tau"), "marathi": ("mama", "mami", "kaka", "kaki", "dada", "tai", "atya"), "telugu": ("anna", "akka", "amma", "nanna", "tammudu", "chellelu", "mama"),
    "tamil": ("anna", "akka", "mama", "appa", "amma", "thambi"), "bengali": ("dada", "didi", "mama", "mami", "kaka", "kaki", "pisi"), "kannada": ("anna", "akka", "mama", "appa", "amma", "thatha"),
    "malayalam": ("chettan", "chechi", "amma", "appan", "mama"), "gujarati": ("kaka", "kaki", "mama", "mami", "fua", "fai", "dada", "dadi"), "punjabi": ("chacha", "taya", "mama", "bhua", "veer", "bhaji"),
    "odia": ("mama", "mami", "kaka", "kaki", "bhai", "nana"), "assamese": ("mama", "mami", "kaka", "khura", "pehi", "mahi"),
}
#: Titles of local offices.
OFFICES = (
    "sarpanch", "up-sarpanch", "upsarpanch", "sarpanchni", "patwari", "patwary", "gram pradhan", "pradhan", "mukhiya", "gram panchayat", "gram sabha", "gram sevak", "lambardar", "kotwal", "talati", "tehsildar", "naib tehsildar", "numberdar",
    "zilla parishad", "panchayat samiti",
)
#: Words for places smaller than a district.
PLACES = ("gaon", "thanda", "tanda", "basti", "basthi", "palli", "wadi", "vadi", "tola", "tolla", "mohalla", "muhalla", "purwa", "kheda", "khera", "dhani", "majra", "mauza", "tanr")
MARK = "[redacted]"
_RUN = "[" + "".join(f"{a}-{b}" for a, b in SCRIPTS.values()) + "]+"


def whole(terms) -> str:
    """A pattern for any of ``terms`` as whole words, longer ones first; case doesn't matter."""
    return r"(?i)(?<![\p{L}\p{N}_])(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + r")(?![\p{L}\p{N}_])"


def age_pattern(language: str) -> str:
    (zero, nine), words = AGE_WORDS[language]
    return f"[0-9{zero}-{nine}]{{1,2}}\\s*(?:{'|'.join(words)})"


def _named(conditions: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()]))


def scripts(text: Column) -> Column:
    """The scripts that the text has characters of, in fixed order; none for null."""
    return _named({n: text.rlike(f"[{a}-{b}]") for n, (a, b) in SCRIPTS.items()})


def native_hits(text: Column) -> Column:
    """``native_age:language`` and ``native_script:script`` for what the text has, in fixed order; none for null.

    Every age in a native script has characters of one, so a text without any needs no closer look.
    """
    return bound(text, lambda t: F.when(F.coalesce(t.rlike(_RUN), F.lit(False)), _native(t)).otherwise(F.array().cast("array<string>")))


def _native(text: Column) -> Column:
    return _named({f"native_age:{n}": text.rlike(age_pattern(n)) for n in AGE_WORDS} | {f"native_script:{n}": text.rlike(f"[{a}-{b}]") for n, (a, b) in SCRIPTS.items()})


def romanized_hits(text: Column, languages: tuple[str, ...] = ()) -> Column:
    """Names of the romanised traces in a text; ``languages`` adds the words that only these languages make plain."""
    own = {"romanized_kinship_relation": text.rlike(whole(KINSHIP)), "local_office_title": text.rlike(whole(OFFICES)), "subdistrict_geography": text.rlike(whole(PLACES))}
    return _named(own | {f"romanized_kinship_relation:{n}": text.rlike(whole(KINSHIP_OF[n])) for n in languages if n in KINSHIP_OF})


def hits(text: Column, languages: tuple[str, ...] = ()) -> Column:
    """All traces, romanised ones first."""
    return F.concat(romanized_hits(text, languages), native_hits(text))


def scrub_native(text: Column) -> Column:
    """The text with a mark for each age in a native script and for each run of native characters."""

    def each(t: Column) -> Column:
        out = t
        for n in AGE_WORDS:
            out = F.regexp_replace(out, age_pattern(n), MARK)
        return F.when(t.rlike(_RUN), F.regexp_replace(out, _RUN, MARK)).otherwise(t)

    return bound(text, each)


def scrub(text: Column) -> Column:
    """Prose with a mark for each romanised trace too; twice is as good as once."""
    for terms in (KINSHIP, OFFICES, PLACES):
        text = F.regexp_replace(text, whole(terms), MARK)
    return scrub_native(text)
