"""What may be published of a case with a minor: fixed sentences from coded facts, and dates by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import codes
from casewright.functions.text import bound

#: What a category is called.
CATEGORIES = {"rape": "Rape", "pocso": "Child sexual offence", "sexual_assault": "Sexual assault", "acid_attack": "Acid attack", "harassment": "Sexual harassment", "other": "Sexual offence"}
#: What a status says.
STATUSES = {
    "FIR_FILED": "An FIR has been filed", "CHARGESHEETED": "A chargesheet has been filed", "UNDER_TRIAL": "The case is under trial", "CONVICTED": "The accused was convicted", "ACQUITTED": "The accused was acquitted",
    "APPEAL_PENDING": "An appeal is pending", "CLOSED": "The case is closed", "QUASHED": "The case was quashed", "UNKNOWN": "The case status is not yet known",
}
#: What institutions did, in the order told.
ACTIONS = {
    "chargesheet_filed": "Police have filed a chargesheet.", "bail_granted": "Bail was granted.", "bail_denied": "Bail was denied.", "sit_formed": "A special investigation team was formed.",
    "suspension_ordered": "An official was suspended over the case.", "convicted": "The accused was convicted.", "acquitted": "The accused was acquitted.", "appeal_filed": "An appeal was filed.",
}
#: Fixed value: the sentence that every summary ends with.
WITHHELD = "Identifying details are withheld by law (POCSO s.23)."
NUMBERS = (
    "One", "Two", "Three", "Four", "Five", "Six", "Seven", "Eight", "Nine", "Ten",
)


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def _year(date: Column) -> Column:
    return F.coalesce(F.regexp_extract(date, r"^(\d{4})", 1), F.lit(""))


def _titled(what: Column, district: Column, state: Column, date: Column) -> Column:
    where = F.coalesce(F.nullif(_text(district), F.lit("")), codes.state_name(state), F.lit(""))
    year = _year(date)
    return F.substring(F.concat_ws(" ", what, F.when(where != "", F.concat(F.lit("— "), where)), F.when(year != "", F.concat(F.lit("("), year, F.lit(")")))), 1, 90)


def category_label(category: Column) -> Column:
    return F.coalesce(codes.lookup(CATEGORIES, F.lower(category)), F.lit("Sexual offence"))


def offence_phrase(sections: Column, category: Column) -> Column:
    """The offence by its charges, else by its category; it always says that a minor is involved."""
    phrase = F.coalesce(codes.severity(sections), category_label(category))
    return bound(phrase, lambda p: F.when(F.lower(p).rlike("child|minor"), p).otherwise(F.concat(p, F.lit(" involving a minor"))))


def plain_title(category: Column, district: Column, state: Column, date: Column) -> Column:
    """A title for a case without a minor that has none of its own."""
    return _titled(F.concat(category_label(category), F.lit(" case")), district, state, date)


#: The coded facts of a case and their types.
FACTS = {"accused_count": "int", "institutional_actions": "array<string>", "repeat_offence": "boolean", "weapon_or_threat": "boolean", "sentence_years": "int"}


def summary(offence: Column) -> Column:
    """``offence`` told with the columns state, district, incident_reported_date, sections, category, status, accused_count,
    institutional_actions, repeat_offence, weapon_or_threat, sentence_years: sentences of the coded facts if two or
    more are known, else a flat one."""
    offence = F.concat(F.lower(F.substring(offence, 1, 1)), F.substring(offence, 2, 1000))
    district, state, year = _text(F.col("district")), F.coalesce(codes.state_name(F.col("state")), F.lit("")), _year(F.col("incident_reported_date"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    did = lambda a: yes(F.array_contains("institutional_actions", a))
    count, years = F.when(F.col("accused_count") >= 1, F.col("accused_count")), F.when(F.col("sentence_years") >= 0, F.col("sentence_years"))
    arrested, weapon, repeat = did("arrest_made"), yes(F.col("weapon_or_threat")), yes(F.col("repeat_offence"))
    acted = arrested | yes(F.arrays_overlap("institutional_actions", F.array(*map(F.lit, ACTIONS))))
    known = sum((c.cast("int") for c in (acted, repeat, weapon, years.isNotNull())), count.isNotNull().cast("int"))
    people = F.concat(F.coalesce(F.get(F.array(*map(F.lit, NUMBERS)), count - 1), count.cast("string")), F.when(count == 1, " person was ").otherwise(" people were "))
    where = F.when(district == "", "").otherwise(F.concat(F.lit(" in "), district))
    lead = (
        F.when(arrested & count.isNotNull(), F.concat(people, F.lit("arrested"), where, F.lit(" for the "), offence, F.lit(".")))
        .when(arrested, F.concat(F.lit("An arrest was made"), where, F.lit(" for the "), offence, F.lit(".")))
        .when(count.isNotNull(), F.concat(people, F.lit("accused of the "), offence, where, F.lit(".")))
        .otherwise(F.concat(F.lit("A case of "), offence, where, F.lit(" was recorded.")))
    )
    term = F.concat(F.lit("The court imposed a sentence of "), years.cast("string"), F.when(years == 1, " year.").otherwise(" years."))
    told = F.concat_ws(" ", lead, F.when(weapon, "A weapon or threat was involved."), F.when(repeat, "The accused is recorded as a repeat offender."), *[F.when(did(a), s) for a, s in ACTIONS.items()], term, F.lit(WITHHELD))
    place = F.concat_ws(", ", F.nullif(district, F.lit("")), F.nullif(state, F.lit("")))
    phrase = F.coalesce(codes.lookup(STATUSES, F.upper(F.col("status"))), F.lit(STATUSES["UNKNOWN"]))
    flat = F.concat(F.lit("A case of "), offence, F.when(place == "", "").otherwise(F.concat(F.lit(" in "), place)), F.when(year == "", "").otherwise(F.concat(F.lit(" ("), year, F.lit(")"))), F.lit(". "), phrase, F.lit(". "), F.lit(WITHHELD))
    return F.when(known >= 2, told).otherwise(flat)


def history_by_month(history: Column, sources: Column) -> Column:
    """The timeline with dates cut to months, but for those that a court's source gives."""
    court = lambda e: F.coalesce(F.get(sources, e["source"])["source_type"] == "court", F.lit(False))
    return F.transform(history, lambda e: F.when(court(e), e).otherwise(e.withField("date", F.substring(e["date"], 1, 7))))


def project(cases: DataFrame) -> DataFrame:
    """``cases`` with what must not be told of a minor taken out; other cases stay as they are.

    Of the columns it may touch, those that ``cases`` lacks are not added, but for title and summary; coded facts that
    it lacks count as unknown. Twice is as good as once.
    """
    lacking = {n: F.lit(None).cast(t) for n, t in FACTS.items() if n not in cases.columns}
    minor = F.coalesce(F.col("minor_involved"), F.lit(True))
    kept = lambda c: F.col(c) if c in cases.columns else F.lit(None).cast("string")
    # the rules of severity are costly, so that their result is a column that title and summary share
    rows = cases.withColumns({**lacking, "_offence": offence_phrase(F.col("sections"), F.col("category"))})
    title = _titled(F.col("_offence"), F.col("district"), F.col("state"), F.col("incident_reported_date"))
    out = {"title": F.when(minor, title).otherwise(kept("title")), "summary": F.when(minor, summary(F.col("_offence"))).otherwise(kept("summary")), "incident_reported_date": F.when(minor, F.substring("incident_reported_date", 1, 7)).otherwise(F.col("incident_reported_date"))}
    for name in ("verification_note", "accused", "accused_name", "days_since_reported", "next_hearing"):
        if name in cases.columns:
            out[name] = F.when(~minor, F.col(name))
    if {"status_history", "sources"} <= set(cases.columns):
        out["status_history"] = F.when(minor, history_by_month(F.col("status_history"), F.col("sources"))).otherwise(F.col("status_history"))
    return rows.withColumns(out).drop("_offence", *lacking)
