"""Publication gates: reasons are arrays, so that they add up in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import codes, dates

STATUSES = ["FIR_FILED", "CHARGESHEETED", "UNDER_TRIAL", "CONVICTED", "ACQUITTED", "APPEAL_PENDING", "CLOSED", "QUASHED", "UNKNOWN"]


def reasons(**conditions: Column) -> Column:
    """The names of the conditions that hold, in the order given."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()]))


def hold_reasons(least: float = 0.85) -> Column:
    """Why a case can't be published by itself: columns minor_involved, category, sections, accused_name, source_type, confidence."""
    pocso = F.exists("sections", lambda s: F.upper(s).contains("POCSO"))
    pocso = F.coalesce(pocso, F.lit(False)) | F.coalesce(F.lower(F.trim("category")) == "pocso", F.lit(False))
    flagged, durable = F.coalesce("minor_involved", F.lit(False)), F.coalesce(F.col("source_type").isin("court", "news_article", "press_release"), F.lit(False))
    return reasons(minor_involved=flagged, pocso_minor_mismatch=pocso & ~flagged, named_accused=F.col("accused_name").isNotNull(), live_blog_only=~durable, confidence_below_auto=F.coalesce("confidence", F.lit(0.0)) < least)


def review_reason(least: float = 0.8) -> Column:
    """The first reason to keep a case from deduplication, null if there is none."""
    out_of_scope = (F.size("sections") > 0) & ~F.exists("sections", codes.qualifying_section)
    return F.when(out_of_scope, "scope_review").when(F.coalesce("confidence", F.lit(0.0)) < least, "low_confidence")


def jurisdiction_reason() -> Column:
    return F.when(F.coalesce(F.trim("state"), F.lit("")) == "", "no_jurisdiction").when(~codes.normalize_state(F.col("state")).isin(*codes.STATES), "unknown_state")


def schema_violations() -> Column:
    """Names of the fields that break the record's schema, its conditions for minors included."""
    d = F.col("incident_reported_date")
    return reasons(state=F.col("state").isNull() | ~F.col("state").rlike("^[A-Z]{2}$"), district=F.col("district").isNull() | (F.length("district") == 0), status=F.col("status").isNull() | ~F.col("status").isin(STATUSES), confidence=F.col("confidence").isNull() | ~F.col("confidence").between(0, 1), date=d.isNull() | ~d.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), minor_date=F.col("minor_involved") & ~d.rlike(r"^\d{4}-\d{2}$"), minor_accused=F.col("minor_involved") & F.col("accused_name").isNotNull(), day_date=~F.col("minor_involved") & ~d.rlike(r"^\d{4}-\d{2}-\d{2}$"))


def in_scope(cases: DataFrame, states: list[str] | None, lookback: int | None, run_date: str) -> DataFrame:
    """Cases of the states asked for, reported on a valid day no later than the run and no earlier than the lookback."""
    day = dates.reported_date(F.col("incident_reported_date"))
    if states is not None:
        cases = cases.where(F.col("state").isin(states))
    if lookback is not None:
        cases = cases.where(day.between(F.date_sub(F.lit(run_date).cast("date"), lookback), F.lit(run_date).cast("date")))
    return cases


def withheld_accused() -> Column:
    """The accused's name, but only where a court and a case number stand for it."""
    return F.when(F.col("court").isNotNull() & F.col("cnr").isNotNull(), F.col("accused_name"))
