"""A run over whole records, from candidates to the tables that it leaves; every step is a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from casewright.operators import aggregates
from casewright.operators.durability import durable
from casewright.plans.daily import RunConfig
from casewright.records import gates, health, ids, resolve, sanitize, state, validate, views
from casewright.records.schema import NAMES, RECORD


@dataclass
class Memory:
    """What earlier runs left; what is None is empty. existing and staged are records (ord, ..), queue (ord, ..) too."""

    existing: DataFrame | None = None
    queue: DataFrame | None = None
    staged: DataFrame | None = None
    marks: DataFrame | None = None
    corrections: DataFrame | None = None
    approved: DataFrame | None = None
    ledger: DataFrame | None = None


def scoped(rows: DataFrame, config: RunConfig) -> tuple[DataFrame, DataFrame]:
    """(records in the run's states and window, the others). With a window, a date without a day is outside."""
    inside = F.lit(True)
    if config.states is not None:
        inside = F.coalesce(F.upper("state").isin(*config.states), F.lit(False))
    if config.lookback is not None:
        day, run = F.when(F.col("incident_reported_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("incident_reported_date")).try_cast("date"), F.lit(config.run_date).cast("date")
        inside = inside & F.coalesce(day.between(F.date_sub(run, config.lookback), run), F.lit(False))
    return rows.where(inside), rows.where(~inside)


def run(candidates: DataFrame, config: RunConfig, memory: Memory | None = None, outcomes: DataFrame | None = None, docs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a run: published, held, review, out_of_window, collisions, changes, marks, last_checked, feed, coverage, merge_review,
    counters, ledger (if ``outcomes`` are given: url, outcome) and health (if ``docs`` are: url, publisher).

    ``candidates``: (ord, *record), freshly extracted. They are made canonical and sanitised, go through scope, join what
    earlier runs left, and are resolved together with it. What is published is final: sanitised again after merging,
    corrected, valid, held back by no gate or approved by a human, and has its permanent id. A refresh publishes only
    what has an id or an anchor of a record on the site already, and keeps the reviewed text.
    """
    memory = memory or Memory()
    spark = candidates.sparkSession
    none = spark.createDataFrame([], "ord long").select("ord", *[F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD])
    existing = none if memory.existing is None else memory.existing.select("ord", *NAMES)
    fresh = sanitize.canonical_place(sanitize.finalize_with(candidates, "ord"))
    inside, outside = scoped(fresh, config)
    older = [existing] + [m.select("ord", *NAMES) for m in (memory.queue, memory.staged) if m is not None]
    every = durable(state.in_order(*older, inside))
    merged, review = resolve.dedupe(every)
    merged = sanitize.finalize_with(merged.select("ord", *NAMES), "ord")
    known, lost = gates.split_jurisdiction(merged)
    readable, unreadable = gates.split_unreadable(known, existing)
    if memory.corrections is not None:
        readable, _ = state.apply_corrections(readable, memory.corrections)
        readable = sanitize.finalize_with(readable, "ord")
    if config.refresh:
        keys = existing.select(F.explode(resolve.anchor_keys()).alias("key")).distinct()
        anchored = readable.select("ord", F.explode(resolve.anchor_keys()).alias("key")).join(keys, "key", "left_semi").select("ord")
        live = readable.join(existing.select("id").where("id is not null").distinct(), "id", "left_semi").select("ord")
        readable = state.preserve_narrative(readable.join(anchored.union(live).distinct(), "ord", "left_semi"), existing).drop("narrative_held")
    readable = durable(readable)
    gated = readable.withColumn("reasons", gates.hold_reasons())
    gated = gated.withColumn("_approved", F.lit(False)) if memory.approved is None else gates.approved(gated, memory.approved)
    if config.approved_only:
        gated = gated.withColumn("reasons", F.concat("reasons", F.array(F.lit("not_approved"))))
    ready = gated.where("_approved or size(reasons) = 0").drop("reasons", "_approved")
    held = gated.where("not _approved and size(reasons) > 0").drop("_approved")
    given = ids.minted(ready, existing, config.run_date, memory.marks, held)
    stamped = durable(ids.stamped(ready.drop("id").join(given.select("ord", "id"), "ord").select("ord", *NAMES), existing, config.run_date))
    kept, collisions = ids.resolve_collisions(stamped)
    published, broken = validate.split_valid(kept)
    published = durable(published)
    why = lambda df, reason: df.select("ord", *NAMES, reason.alias("reason"))
    review = why(review, F.col("reason")).unionByName(why(lost, F.col("reason"))).unionByName(why(unreadable, F.col("reason"))).unionByName(why(broken, F.concat(F.lit("invalid: "), F.array_join("reasons", ", ")))).unionByName(why(collisions, F.lit("id_collision")))
    marks = spark.createDataFrame([], "year string, state string, serial int") if memory.marks is None else memory.marks
    tables = {
        "published": published.select("ord", *NAMES), "held": held, "review": review, "out_of_window": outside, "collisions": collisions.select("ord", *NAMES), "changes": ids.change_counts(published), "marks": ids.high_water(marks, published),
        "last_checked": state.last_checked(published, config.run_date), "feed": views.feed(published), "merge_review": resolve.candidate_clusters(published), "counters": health.report_counters(published, held, review),
        "statuses": aggregates.counts(published, "status"), "states": aggregates.counts(published, "state"), "trend": aggregates.monthly_trend(published, config.run_date),
    }
    if outcomes is not None:
        ledger = spark.createDataFrame([], state.LEDGER) if memory.ledger is None else memory.ledger
        tables["ledger_outcomes"] = state.fates(outcomes, published, existing, review, held, ledger)
        if docs is not None:
            tables["health"] = health.pipeline_health(docs, outcomes, docs.limit(0), published, held, review)
    return tables


def orphan_free(tables: dict[str, DataFrame]) -> DataFrame:
    """(id) of the feed without a published record: empty in any sound run."""
    return views.orphans(tables["feed"], tables["published"])
