"""Which records may be published without a human, and why the others wait: columns over whole records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import codes, persons, text
from casewright.operators.gates import jurisdiction_reason, reasons
from casewright.records.schema import listed

#: Sources that a permanent claim may rest on.
DURABLE = ("court", "news_article", "press_release")
#: Confidence from which a record is published by itself, and below which it is reviewed.
AUTO, REVIEW = 0.85, 0.8


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def confidence() -> Column:
    """A record's confidence; none told is none."""
    return F.coalesce("confidence", F.lit(0.0))


def pocso_signal() -> Column:
    """Whether the category or a section says that a child is involved, whatever the flag says."""
    return _sure(F.lower(F.trim("category")) == "pocso") | F.exists(listed("offence_sections"), lambda s: _sure(F.upper(s).contains("POCSO")))


def minor() -> Column:
    """Whether a record counts as a minor's: told so, not told, or by a signal."""
    return F.coalesce("minor_involved", F.lit(True)) | pocso_signal()


def court_record() -> Column:
    """Whether a source's publisher is an official one."""
    return F.exists(listed("sources"), lambda s: codes.any_of(s["publisher"], codes.OFFICIAL))


def court_source() -> Column:
    return F.exists(listed("sources"), lambda s: _sure(s["source_type"] == "court"))


def tier() -> Column:
    """The best tier among a record's sources, 3 without any."""
    return F.coalesce(F.array_min(F.transform(listed("sources"), lambda s: codes.source_tier(s["source_type"]))), F.lit(3))


def hold_reasons(least: float = AUTO) -> Column:
    """Why a record isn't published by itself, in fixed order; empty if it may be."""
    flagged = _sure(F.col("minor_involved"))
    named = F.exists(listed("accused"), lambda a: _sure(a["name_public_court_record"] != ""))
    durable = F.exists(listed("sources"), lambda s: _sure(s["source_type"].isin(*DURABLE)))
    return reasons(minor_involved=flagged, pocso_minor_mismatch=~flagged & pocso_signal(), named_accused=named, live_blog_only=~durable, confidence_below_auto=confidence() < least)


def verified_hold_reasons(least: float = AUTO) -> Column:
    """Why a verified record is held all the same: as before, but a minor's alone doesn't hold it."""
    return F.array_remove(hold_reasons(least), "minor_involved")


def age_detail() -> Column:
    """Whether the summary tells an age."""
    return F.size(persons.age_hits(F.coalesce("summary", F.lit("")))) > 0


def identity_detail() -> Column:
    """Whether a record that isn't a minor's tells an age or a relationship in title, summary or a section."""
    texts = F.concat(F.array("title", "summary"), listed("offence_sections"))
    told = F.exists(F.transform(texts, lambda t: F.coalesce(t, F.lit(""))), lambda t: (F.size(persons.age_hits(t)) > 0) | (F.size(persons.relations(t)) > 0))
    return ~_sure(F.col("minor_involved")) & told


def out_of_scope() -> Column:
    """Whether sections are told and none of them counts."""
    sections = listed("offence_sections")
    return (F.size(sections) > 0) & ~F.exists(sections, lambda s: _sure(codes.qualifying_section(s)))


def review_reason(least: float = REVIEW) -> Column:
    """The first reason to keep a record from resolution, null if there is none."""
    return F.when(age_detail(), "age_detail_present").when(identity_detail(), "identity_detail_present").when(out_of_scope(), "scope_review").when(confidence() < least, "low_confidence")


def unreadable(live: Column | None = None) -> Column:
    """Whether a new record's summary breaks a rule of style; minors' are fixed sentences, and ``live`` ones stay."""
    bad = ~_sure(F.col("minor_involved")) & (F.size(text.readability_violations(F.coalesce("summary", F.lit("")))) > 0)
    return bad if live is None else bad & ~_sure(live)


def split_unreadable(rows: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, diverted with reason): records whose id is in ``live`` (id) are never diverted."""
    marked = rows.join(live.select("id").distinct().withColumn("_live", F.lit(True)), "id", "left").withColumn("_bad", unreadable(F.col("_live")))
    return marked.where("not _bad").select(rows.columns), marked.where("_bad").select(*rows.columns, F.lit("unreadable_summary").alias("reason"))


def split_jurisdiction(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of known states, the others with reason)."""
    marked = rows.withColumn("reason", jurisdiction_reason())
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def approved(rows: DataFrame, urls: DataFrame) -> DataFrame:
    """``rows`` with _approved: whether one of a record's sources has an approved ``urls`` (url), compared as written but for blanks around."""
    keyed = rows.withColumn("_n", F.monotonically_increasing_id())
    hits = keyed.select("_n", F.explode(F.transform(listed("sources"), lambda s: F.trim(s["url"]))).alias("url")).join(urls.select(F.trim("url").alias("url")).where("url <> ''").distinct(), "url", "left_semi").select("_n").distinct()
    return keyed.join(hits.withColumn("_approved", F.lit(True)), "_n", "left").withColumn("_approved", _sure(F.col("_approved"))).drop("_n")


def fact_count() -> Column:
    """How many of the five coded facts of the case are known: a count, what institutions did, a repeat, a weapon, a sentence."""
    known = [F.col("accused_count") >= 1, F.exists(listed("institutional_actions"), lambda a: _sure(a != "")), F.col("repeat_offence"), F.col("weapon_or_threat"), F.col("sentence_years") >= 0]
    return sum((_sure(c).cast("int") for c in known[1:]), _sure(known[0]).cast("int"))


def reextract_reasons(thin: int = 12, facts: int = 2) -> Column:
    """Why a published record should be extracted anew, in fixed order: sections that are none, no usable section, a
    minor's record from a court with too few facts, a summary of too few words."""
    sections = codes.normalize_sections(listed("offence_sections"))
    flagged = _sure(F.col("minor_involved"))
    words = F.size(F.filter(F.split(F.coalesce("summary", F.lit("")), r"\s+"), lambda w: w != ""))
    return reasons(
        unparsed_sections=F.size(sections["unparsed"]) > 0,
        no_usable_section=(F.size(listed("offence_sections")) > 0) & (F.size(sections["canonical"]) == 0),
        few_facts=flagged & court_source() & (fact_count() < facts),
        thin_summary=~flagged & (words < thin),
    )
