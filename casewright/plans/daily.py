"""A daily run: what it may cover, where each case goes, and the tables that it leaves."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from casewright.functions import codes, minors
from casewright.operators import aggregates, gates, identity
from casewright.operators.durability import durable

_YES = ("1", "true", "yes")


@dataclass(frozen=True)
class RunConfig:
    """What a run covers. ``states`` None means all, which has to be said."""

    run_date: str
    states: frozenset[str] | None
    lookback: int | None = None
    approved_only: bool = False
    refresh: bool = False

    @classmethod
    def of(cls, settings: Mapping[str, str], run_date: str, refresh: bool = False) -> RunConfig:
        """From named settings; a run whose states are not told is refused, a lookback that is no number counts as none."""
        raw = settings.get("LAUNCH_STATES", "").strip().upper()
        states = frozenset(s.strip() for s in raw.split(",") if s.strip())
        if not states:
            raise ValueError("LAUNCH_STATES must be ALL or a list of state codes")
        days = settings.get("LAUNCH_LOOKBACK_DAYS", "").strip()
        return cls(run_date, None if raw == "ALL" else states, int(days) if days.removeprefix("-").isdigit() else None, settings.get("PUBLISH_APPROVED_ONLY", "").strip().lower() in _YES, refresh)


def tidied(cases: DataFrame) -> DataFrame:
    """Canonical codes, names withheld where no court stands for them, and minors projected; twice is as good as once."""
    sections = F.transform("sections", lambda s: F.coalesce(codes.canonical_section(s), s))
    pocso = F.exists("sections", lambda s: F.upper(s).contains("POCSO"))
    rows = cases.withColumns({"state": codes.normalize_state(F.col("state")), "district": codes.canonical_district(F.col("district")), "sections": F.array_distinct(sections), "accused_name": gates.withheld_accused(), "minor_involved": F.coalesce("minor_involved", F.lit(True)) | F.coalesce(pocso, F.lit(False))})
    return minors.project(rows.withColumn("source_type", codes.source_type(F.col("url"), F.col("publisher"))))


def routed(cases: DataFrame, config: RunConfig, approved: DataFrame | None = None) -> DataFrame:
    """``cases``, tidied, with route (out_of_scope, quarantined, review, held or published) and reasons.

    ``approved`` (url) names cases that are published whatever holds them; it is joined, so it may be of any size.
    The first step that stops a case decides; no case is dropped.
    """
    # the date as it was reported decides about the scope, not the month that a minor's case keeps of it
    rows = tidied(cases.withColumn("_reported", F.col("incident_reported_date")))
    day = F.coalesce(F.col("_reported"), F.lit(""))
    date = F.when(F.length(day) == 7, F.concat(day, F.lit("-01"))).otherwise(day).try_cast("date")
    run = F.lit(config.run_date).cast("date")
    outside = F.lit(False) if config.states is None else ~F.coalesce(F.col("state").isin(*config.states), F.lit(False))
    if config.lookback is not None:
        outside = outside | (F.length(day) < 7) | ~F.coalesce(date.between(F.date_sub(run, config.lookback), run), F.lit(False))
    if approved is not None:
        rows = rows.join(approved.select("url").distinct().withColumn("_approved", F.lit(True)), "url", "left")
    else:
        rows = rows.withColumn("_approved", F.lit(None).cast("boolean"))
    ok = F.coalesce("_approved", F.lit(False))
    place, review, holds, broken = gates.jurisdiction_reason(), gates.review_reason(), gates.hold_reasons(), gates.schema_violations()
    only = F.when(F.lit(config.approved_only), F.array(F.lit("not_approved"))).otherwise(F.array().cast("array<string>"))
    step = lambda name, why: F.struct(F.lit(name).alias("route"), why.alias("reasons"))
    fate = (
        F.when(place.isNotNull(), step("quarantined", F.array(place)))
        .when(outside, step("out_of_scope", F.array().cast("array<string>")))
        .when(F.size(broken) > 0, step("quarantined", broken))
        .when(review.isNotNull(), step("review", F.array(review)))
        .when(~ok & (F.size(F.concat(holds, only)) > 0), step("held", F.concat(holds, only)))
        .otherwise(step("published", F.array().cast("array<string>")))
    )
    return rows.withColumn("_fate", fate).withColumns({"route": F.col("_fate.route"), "reasons": F.col("_fate.reasons")}).drop("_fate", "_approved", "_reported")


def daily(cases: DataFrame, prior: DataFrame, config: RunConfig, approved: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a run: published (with ids), held, review, quarantined, and report (route, reason, n).

    ``prior``: (cnr, id, year, state, serial) of all ids ever given. A refresh publishes only cases whose court number
    has an id already.
    """
    rows = durable(routed(cases, config, approved))  # each table below is read from it
    of = lambda route: rows.where(F.col("route") == route)
    published = of("published")
    if config.refresh:
        published = published.join(prior.where("cnr is not null").select("cnr").distinct(), "cnr", "left_semi")
    ids = identity.mint(published, prior, config.run_date)
    report = rows.select("route", F.explode_outer("reasons").alias("reason")).groupBy("route", "reason").agg(F.count("*").alias("n"))
    return {"published": published.join(ids.select("ord", "id", "minted"), "ord"), "held": of("held"), "review": of("review"), "quarantined": of("quarantined"), "report": report}


def summary(published: DataFrame, config: RunConfig) -> dict[str, DataFrame]:
    """The aggregates that go with the published cases."""
    return {
        "statuses": aggregates.counts(published, "status"), "states": aggregates.counts(published, "state"), "trend": aggregates.monthly_trend(published, config.run_date), "severity": aggregates.severity_summary(published),
        "jurisdictions": aggregates.jurisdiction_scorecard(published, config.run_date), "longest_pending": aggregates.top_pending(published, config.run_date), "coverage": aggregates.coverage(published, codes.STATES), "trackability": aggregates.trackability(published),
    }


def report_lines(report: DataFrame) -> list[str]:
    """The report as lines of Markdown; a row for each route and reason, so few whatever the run."""
    return [f"* {r['route']}{': ' + r['reason'] if r['reason'] else ''} — {r['n']}" for r in report.orderBy("route", "reason").collect()]
