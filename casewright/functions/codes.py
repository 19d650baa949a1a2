"""Codes as column expressions: states, districts, offence sections, severity, provenance, URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from casewright.functions.text import bound

#: State codes in their official order.
STATES = (
    "AP", "AR", "AS", "BR", "CT", "GA", "GJ", "HR", "HP", "JH", "KA", "KL", "MP", "MH", "MN", "ML", "MZ", "NL", "OD", "PB", "RJ", "SK", "TN", "TG", "TR", "UP", "UT", "WB", "DL", "JK", "LA", "PY", "CH",
    "AN", "DN", "LD",
)
#: The states' names, in the same order.
STATE_NAMES = [
    "Andhra Pradesh", "Arunachal Pradesh", "Assam", "Bihar", "Chhattisgarh", "Goa", "Gujarat", "Haryana", "Himachal Pradesh", "Jharkhand", "Karnataka", "Kerala", "Madhya Pradesh", "Maharashtra", "Manipur", "Meghalaya", "Mizoram", "Nagaland",
    "Odisha", "Punjab", "Rajasthan", "Sikkim", "Tamil Nadu", "Telangana", "Tripura", "Uttar Pradesh", "Uttarakhand", "West Bengal", "Delhi", "Jammu & Kashmir", "Ladakh", "Puducherry", "Chandigarh", "Andaman & Nicobar", "Dadra & Nagar Haveli and Daman & Diu", "Lakshadweep",
]
#: Other codes in use for a state.
STATE_ALIASES = {"TS": "TG", "TL": "TG", "CG": "CT", "OR": "OD", "UK": "UT", "UA": "UT", "PD": "PY", "DD": "DN"}
#: Renamed districts.
DISTRICT_ALIASES = {
    "gurgaon": "Gurugram", "bangalore": "Bengaluru", "allahabad": "Prayagraj", "gauhati": "Guwahati", "calcutta": "Kolkata", "bombay": "Mumbai", "madras": "Chennai",
    "mysore": "Mysuru", "belgaum": "Belagavi", "gulbarga": "Kalaburagi", "mangalore": "Mangaluru", "pondicherry": "Puducherry", "poona": "Pune", "new delhi district": "New Delhi",
}
#: Severity rules, most severe first (label, aggravated, section texts).
SEVERITY = [
    ("Gang rape of a minor", True, ["BNS 70(2)", "BNS 70 (2)"]),
    ("Gang rape", True, ["BNS 70(1)", "BNS 70 (1)", "BNS 70", "IPC 376D", "376D"]),
    ("Rape resulting in death or persistent vegetative state", True, ["BNS 66", "IPC 376A"]),
    ("Aggravated penetrative assault on a child", True, ["POCSO 6", "POCSO S.6", "POCSO SECTION 6"]),
    ("Rape of a minor", True, ["BNS 65", "IPC 376(3)", "IPC 376AB"]),
    ("Penetrative assault on a child", True, ["POCSO 4", "POCSO S.4", "POCSO SECTION 4"]),
    ("Sexual assault of a child", False, ["POCSO 8", "POCSO 10", "POCSO 12"]),
    ("Rape", False, ["BNS 64", "IPC 376", "IPC 375", "SECTION 376", "SECTION 375"]),
    ("Acid attack", True, ["BNS 124", "IPC 326A", "326A"]),
    ("Assault to outrage modesty", False, ["BNS 74", "BNS 351", "IPC 354", "SECTION 354"]),
    ("Stalking", False, ["BNS 78", "IPC 354D", "354D"]),
    ("Voyeurism", False, ["BNS 77", "IPC 354C", "354C"]),
    ("Sexual harassment", False, ["BNS 75", "IPC 509", "SECTION 509"]),
    ("Child sexual offence", False, ["POCSO"]),
]
REPEAT_SECTIONS = ["BNS 71", "IPC 376E", "376E", "POCSO 6(2)"]
#: Publishers and URL parts that tell a source's type.
OFFICIAL = ["ecourts", "njdg", "high court", "supreme court", "district court", "sessions court", "sessions judge", "tribunal"]
LEGAL_PRESS = ["livelaw", "bar and bench", "bar & bench", "barandbench", "scc online", "scobserver"]
LIVE_BLOG = ["live-updates", "live-update", "live-blog", "liveblog", "/live/", "-live-news", "live-news", "as-it-happened"]
PRESS_RELEASE = ["pib.gov.in", "press-release", "pressrelease", "press-information-bureau", "/pib/"]
TIERS = {"court": 1, "legal_press": 2, "news_article": 3, "press_release": 3, "live_blog": 4}
#: Words of a URL that would identify a victim.
SLUG_WORDS = (
    r"\d{1,2}\s?(?:year|yr)s?\s?old|\d{1,2}\s?yo|(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen)\s?(?:year|yr)s?\s?old"
    r"|toddler|infant|teenager|teenaged|schoolgirl|schoolboy|girls?|boys?|woman|women|lady|father|stepfather|uncle|brother|cousin|grandfather|neighbour|neighbor|teacher|tutor|guardian|relatives?|husband|maternal|paternal|caretaker|caregiver|warden|principal|priest"
    r"|school|college|hostel|orphanage|madrasa|convent|tuition|anganwadi|creche"
)


def lookup(values: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def normalize_state(code: Column) -> Column:
    c = F.upper(F.trim(code))
    return F.coalesce(lookup(STATE_ALIASES, c), c)


def state_name(code: Column) -> Column:
    """The state's name; an unknown code stands for itself."""
    c = normalize_state(code)
    return F.coalesce(lookup(dict(zip(STATES, STATE_NAMES, strict=True)), c), c)


def canonical_district(name: Column) -> Column:
    c = F.trim(F.regexp_replace(name, r"\s+", " "))
    return F.coalesce(lookup(DISTRICT_ALIASES, F.lower(c)), c)


def any_of(text: Column, parts: list[str]) -> Column:
    """Whether the lower-cased text contains one of ``parts``."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike("|".join(map(re.escape, parts)))


def parse_section(raw: Column) -> Column:
    """struct(act, section, suffix) of one written section; nulls where there is none."""
    t = F.trim(F.regexp_replace(F.upper(raw), r"\s+", " "))
    act = F.when(t.rlike(r"\bPOCSO\b|PROTECTION OF CHILDREN"), "POCSO").when(t.rlike(r"\bBNS\b|BHARATIYA NYAYA SANHITA"), "BNS").when(t.rlike(r"\bBNSS\b|BHARATIYA NAGARIK SURAKSHA"), "BNSS")
    act = act.when(t.rlike(r"\bIPC\b|INDIAN PENAL CODE"), "IPC").when(t.rlike(r"\bCRPC\b|CODE OF CRIMINAL PROCEDURE"), "CRPC")
    number = r"\b(\d{1,4}[A-Z]{0,3})((?:\s*\([^)]{1,4}\))*)"
    found = F.nullif(F.regexp_extract(t, number, 1), F.lit(""))
    return F.struct(act.alias("act"), found.alias("section"), F.regexp_replace(F.regexp_extract(t, number, 2), r"\s+", "").alias("suffix"))


def canonical_section(raw: Column) -> Column:
    """The section as rules know it; null for text that names neither an act nor a section, or only a year."""
    p = parse_section(raw)
    act, section, suffix = p["act"], p["section"], p["suffix"]
    year = section.rlike(r"^(1[89]\d{2}|20\d{2})$") & (suffix == "")
    return F.when(section.isNull(), act).when(~year, F.concat(F.when(act.isNotNull(), F.concat(act, F.lit(" "))).otherwise(""), section, suffix))


def normalize_sections(sections: Column) -> Column:
    """struct(canonical, unparsed): distinct in the order of first appearance."""
    tidy = lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))
    junk = F.filter(sections, lambda s: canonical_section(s).isNull())
    return F.struct(F.array_distinct(F.filter(F.transform(sections, canonical_section), lambda s: s.isNotNull())).alias("canonical"), F.array_distinct(F.filter(F.transform(junk, tidy), lambda s: s != "")).alias("unparsed"))


def haystack(sections: Column) -> Column:
    return F.array_join(F.transform(sections, lambda s: F.trim(F.regexp_replace(F.upper(s), r"\s+", " "))), " | ")


def _needle(parts: list[str]) -> str:
    return "(?:" + "|".join(map(re.escape, sorted(parts, key=len, reverse=True))) + ")(?![A-Z0-9])"


def severity_rule(sections: Column) -> Column:
    """struct(label, aggravated) of the first matching rule, null without one; the rules are gone through once."""

    def first(h: Column) -> Column:
        out = None
        for label, aggravated, parts in SEVERITY:
            hit, value = h.rlike(_needle(parts)), F.struct(F.lit(label).alias("label"), F.lit(aggravated).alias("aggravated"))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out

    return bound(haystack(sections), first)


def severity(sections: Column, what: str = "label") -> Column:
    """The first matching rule's label, or with "aggravated" its flag (false without a rule)."""
    rule = severity_rule(sections)
    return rule["label"] if what == "label" else F.coalesce(rule["aggravated"], F.lit(False))


def severity_code(sections: Column) -> Column:
    """The first matching rule's label as a code: lower case, words joined by underscores; null without a rule."""
    return F.regexp_replace(F.lower(severity(sections)), r"[^a-z]+", "_")


def is_repeat(sections: Column) -> Column:
    return haystack(sections).rlike(_needle(REPEAT_SECTIONS))


def source_type(url: Column, publisher: Column) -> Column:
    both = F.concat_ws(" ", url, publisher)
    return F.when(any_of(publisher, OFFICIAL), "court").when(any_of(publisher, LEGAL_PRESS), "legal_press").when(any_of(both, LIVE_BLOG), "live_blog").when(any_of(both, PRESS_RELEASE), "press_release").otherwise("news_article")


def source_tier(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv]), kind), F.lit(3))


def identifying_slug(url: Column) -> Column:
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return F.regexp_replace(path, r"[/\-_.]+", " ").rlike(rf"(?i)\b(?:{SLUG_WORDS})\b")


def safe_http_url(url: Column) -> Column:
    return F.when(F.lower(F.trim(url)).rlike(r"^https?://"), url).otherwise("#")


def qualifying_section(section: Column) -> Column:
    """A section that counts as in scope: any POCSO, BNS 63 to 79, or one of five IPC numbers (first three digits)."""
    t = F.upper(section)
    n = F.regexp_extract(t, r"(\d{1,3})", 1).try_cast("int")
    return t.contains("POCSO") | (t.contains("BNS") & n.between(63, 79)) | (t.contains("IPC") & n.isin(354, 375, 376, 377, 509))
