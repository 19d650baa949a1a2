"""Payloads of sources to rows, as column expressions: what is malformed gives no rows and never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.text import strip_html

#: Public fields of a court's case, and their labels.
CASE_FIELDS = {"cnr": "CNR", "case_number": "Case", "court": "Court", "police_station": "Police station", "fir_number": "FIR", "district": "District", "state": "State", "sections": "Sections", "status": "Status", "next_hearing": "Next hearing"}
#: Headings of a submission's form, and their fields.
FORM_HEADINGS = {"Public source URL": "url", "State / UT": "state", "District": "district", "Reported month (YYYY-MM) or date (YYYY-MM-DD)": "incident_date"}
_HIT_FIELDS = ("title", "headline", "docsource", "publishdate")


def _field(of: Column, name: str) -> Column:
    return F.try_variant_get(of, f"$.{name}", "string")


def _elements(of: Column) -> Column:
    return F.coalesce(F.try_variant_get(of, "$", "array<variant>"), F.array().cast("array<variant>"))


def search_hits(rows: DataFrame, payload: str) -> DataFrame:
    """``rows`` without ``payload`` but with (tid, title, headline, docsource, publishdate) for each hit with an id.

    Missing fields are empty strings. Payloads that are null, no JSON or without a list of docs give no rows.
    """
    docs = F.try_variant_get(F.try_parse_json(payload), "$.docs", "array<variant>")
    hits = rows.withColumn("_hit", F.explode(docs)).drop(payload).withColumn("tid", _field(F.col("_hit"), "tid"))
    return hits.where("tid <> ''").withColumns({c: F.coalesce(_field(F.col("_hit"), c), F.lit("")) for c in _HIT_FIELDS}).drop("_hit")


def case_text(case: Column) -> Column:
    """A case object's public fields as one line: ``label: value`` joined by ``. ``, lists joined by commas."""
    parts = []
    for name, label in CASE_FIELDS.items():
        value = F.coalesce(F.array_join(F.try_variant_get(case, f"$.{name}", "array<string>"), ", "), _field(case, name))
        parts.append(F.when(value != "", F.concat(F.lit(f"{label}: "), value)))
    return F.concat_ws(". ", *parts)


def court_cases(rows: DataFrame, payload: str) -> DataFrame:
    """``rows`` without ``payload`` but with (url, text) for each case of a list, or of an object's list ``cases``.

    Cases without a URL (``url``, else ``case_url``) or without a public field are left out.
    """
    whole = F.try_parse_json(payload)
    listed = F.coalesce(F.try_variant_get(whole, "$.cases", "array<variant>"), _elements(whole))
    one = rows.withColumn("_case", F.explode(listed)).drop(payload)
    url = F.coalesce(F.nullif(_field(F.col("_case"), "url"), F.lit("")), _field(F.col("_case"), "case_url"))
    return one.withColumns({"url": url, "text": case_text(F.col("_case"))}).drop("_case").where("url <> '' and text <> ''")


def judgment_text(body: Column, court: Column, title: Column, date: Column, most: int = 40_000) -> Column:
    """A judgment's header and its text without markup, at most ``most`` characters; empty without a text."""
    text = F.coalesce(strip_html(body, 2**31 - 1), F.lit(""))
    labelled = [F.when(F.trim(c) != "", F.concat(F.lit(f"{label}: "), F.trim(c))) for label, c in (("Court", court), ("Title", title), ("Date", date))]
    return F.when(text == "", "").otherwise(F.substring(F.concat_ws(". ", *labelled, text), 1, most))


def publisher(court: Column, otherwise: str) -> Column:
    """The court itself, where it is named."""
    return F.coalesce(F.nullif(F.trim(court), F.lit("")), F.lit(otherwise))


def form_fields(body: Column) -> Column:
    """A map of the form's fields from its ``###`` headings; unanswered and unknown ones are left out."""
    heading = r"(?m)^###[ \t]+(.+?)[ \t]*$"
    names = F.regexp_extract_all(body, F.lit(heading), 1)
    values = F.transform(F.slice(F.split(body, heading), 2, 1 << 20), lambda v: F.regexp_replace(v, r"\A\s+|\s+\z", ""))
    known = F.create_map(*[F.lit(x) for pair in FORM_HEADINGS.items() for x in pair])
    pairs = F.transform(F.arrays_zip(names.alias("k"), values.alias("v")), lambda p: F.struct(known[F.trim(p["k"])].alias("k"), p["v"].alias("v")))
    kept = F.filter(pairs, lambda p: p["k"].isNotNull() & (p["v"] != "") & (p["v"] != "_No response_"))
    # of a heading that comes twice the last counts
    return F.aggregate(kept, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))


def submissions(issues: DataFrame, number: str = "number", body: str = "body") -> DataFrame:
    """(url, state, district, incident_date, issue_number) of the issues whose URL field holds a URL."""
    rows = issues.select(F.col(number).alias("n"), form_fields(F.col(body)).alias("f"))
    got = rows.select(F.regexp_extract(F.coalesce(F.col("f")["url"], F.lit("")), r"https?://[^\s)]+", 0).alias("url"), *[F.coalesce(F.col("f")[c], F.lit("")).alias(c) for c in ("state", "district", "incident_date")], F.coalesce("n", F.lit(0)).cast("int").alias("issue_number"))
    return got.where("url <> ''")
