"""What a run did, in numbers: each publisher's funnel, coverage by state, counters and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.functions import codes, dates
from casewright.records.resolve import anchor_keys
from casewright.records.schema import listed

#: The counters of a publisher, in the order of the report.
COUNTERS = ("documents", "prefilter_skipped", "extracted", "out_of_scope", "failed", "published", "needs_review", "quarantined")


def publishers(rows: DataFrame, *keep: str) -> DataFrame:
    """(publisher, *keep): each record's different publishers."""
    return rows.select(*keep, F.explode(F.array_distinct(F.filter(F.transform(listed("sources"), lambda s: s["publisher"]), lambda p: p != ""))).alias("publisher"))


def pipeline_health(docs: DataFrame, outcomes: DataFrame, skipped: DataFrame, published: DataFrame, held: DataFrame, review: DataFrame) -> DataFrame:
    """(publisher, *COUNTERS, prefilter_pass_rate, quarantine_reasons): a row for each publisher of a document or record.

    ``docs`` (url, publisher), ``outcomes`` (url, outcome) and ``skipped`` (url); review has reason. Of documents with
    one URL the publisher that sorts first counts for the outcome. The pass rate is null without documents.
    """
    one = lambda rows, name: rows.select("publisher", F.lit(name).alias("counter"), F.lit(None).cast("string").alias("reason"))
    kind = F.when(F.col("outcome").isin("out_of_scope", "not_a_case"), "out_of_scope").when(F.col("outcome").isin("extracted", "failed"), F.col("outcome"))
    first = docs.groupBy("url").agg(F.min("publisher").alias("publisher"))
    parts = [
        one(docs, "documents"),
        one(docs.join(skipped.select("url").distinct(), "url", "left_semi"), "prefilter_skipped"),
        outcomes.join(first, "url").select("publisher", kind.alias("counter"), F.lit(None).cast("string").alias("reason")).where("counter is not null"),
        one(publishers(published), "published"),
        one(publishers(held), "needs_review"),
        publishers(review, "reason").select("publisher", F.lit("quarantined").alias("counter"), F.coalesce("reason", F.lit("unspecified")).alias("reason")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    counted = every.groupBy("publisher", "counter", "reason").agg(F.count("*").alias("n"))
    sums = [F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("n"))), F.lit(0)).alias(c) for c in COUNTERS]
    reasons = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n")))))
    rate = F.when(F.col("documents") > 0, F.bround((F.col("documents") - F.col("prefilter_skipped")) / F.col("documents"), 3))
    return counted.groupBy("publisher").agg(*sums, reasons.alias("quarantine_reasons")).withColumn("prefilter_pass_rate", rate)


def court_prefilter(stats: DataFrame) -> DataFrame:
    """(source, listed, qualifying, fetched): what each court or search source let through, by source; ``stats`` may have several rows for one."""
    return stats.groupBy("source").agg(*[F.sum(c).alias(c) for c in ("listed", "qualifying", "fetched")])


def coverage(rows: DataFrame, configs: DataFrame, states: list[str] = codes.STATES) -> DataFrame:
    """(state, active_sources, records, declared_gap): every state, a gap being one with neither a source nor a record.

    ``configs``: (state, enabled), national sources among them.
    """
    spark = rows.sparkSession
    code = F.upper(F.trim("state"))
    active = configs.where("enabled").groupBy(code.alias("s")).agg(F.count("*").alias("a"))
    seen = rows.where(code != "").groupBy(code.alias("t")).agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(s,) for s in sorted(states)], "state string")
    got = every.join(F.broadcast(active), F.col("state") == F.col("s"), "left").join(F.broadcast(seen), F.col("state") == F.col("t"), "left")
    a, n = F.coalesce("a", F.lit(0)), F.coalesce("n", F.lit(0))
    return got.select("state", a.alias("active_sources"), n.alias("records"), ((a == 0) & (n == 0)).alias("declared_gap"))


def coverage_totals(rows: DataFrame, configs: DataFrame, states: list[str] = codes.STATES) -> DataFrame:
    """One row: total, court_anchored, rate, states_covered, states_total, national_sources."""
    anchored = F.count_if(F.size(anchor_keys()) > 0)
    own = rows.agg(F.count("*").alias("total"), anchored.alias("court_anchored"), F.coalesce(F.try_divide(anchored, F.count("*")), F.lit(0.0)).alias("rate"))
    told = coverage(rows, configs, states).agg(F.count_if(~F.col("declared_gap")).alias("states_covered"), F.count("*").alias("states_total"))
    national = configs.where("enabled").agg(F.count_if(F.upper(F.trim(F.coalesce("state", F.lit("")))).isin("NATIONAL", "")).alias("national_sources"))
    one = lambda df: df.withColumn("_k", F.lit(0))
    return one(own).join(one(told), "_k").join(one(national), "_k").drop("_k").withColumn("rate", F.bround("rate", 4))


def scale(prior: DataFrame, new: int, total: int, run_date: str, days: int = 120) -> DataFrame:
    """(day, n, week, total): the days' new records, kept from run to run; ``prior`` (day, n) is what the last run left."""
    spark = prior.sparkSession
    today = spark.createDataFrame([(run_date, int(new))], "day string, n long")
    known = prior.select(F.col("day").cast("string").alias("day"), F.col("n").cast("long").alias("n")).union(today).groupBy("day").agg(F.sum("n").alias("n"))
    spine = dates.day_spine(spark, run_date, days).select(F.col("day").cast("string").alias("day"))
    rows = spine.join(known, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))
    week = rows.where(F.col("day") > F.date_sub(F.lit(run_date).cast("date"), 7).cast("string")).agg(F.sum("n").alias("week"))
    return rows.withColumn("_k", F.lit(0)).join(week.withColumn("_k", F.lit(0)), "_k").select("day", "n", "week", F.lit(int(total)).cast("long").alias("total"))


def report_counters(published: DataFrame, held: DataFrame, review: DataFrame) -> DataFrame:
    """(table, key, n): published by state and by source, held and reviewed by reason. A source counts with each of its rows."""
    parts = [
        published.select(F.lit("state").alias("table"), F.coalesce("state", F.lit("")).alias("key")),
        published.select(F.lit("source").alias("table"), F.explode(F.transform(listed("sources"), lambda s: F.coalesce(s["publisher"], F.lit("")))).alias("key")),
        held.select(F.lit("held").alias("table"), F.explode("reasons").alias("key")),
        review.select(F.lit("review").alias("table"), F.col("reason").alias("key")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("table", "key").agg(F.count("*").alias("n"))


def health_lines(health: DataFrame, prefilter: DataFrame | None = None) -> list[str]:
    """The funnel as lines of a Markdown table; a row for each publisher."""
    rows = health.orderBy("publisher").collect()
    if not rows:
        return []
    out = ["| Source | Docs | Pre-filtered | Pass% | Extracted | Out-of-scope | Failed | Published | Held | Quarantined |", "|---|--:|--:|--:|--:|--:|--:|--:|--:|--:|"]
    for r in rows:
        rate = "—" if r["prefilter_pass_rate"] is None else f"{round(r['prefilter_pass_rate'] * 100)}%"
        out.append(f"| {r['publisher']} | {r['documents']} | {r['prefilter_skipped']} | {rate} | " + " | ".join(str(r[c]) for c in COUNTERS[2:]) + " |")
    if prefilter is not None and (own := prefilter.orderBy("source").collect()):
        out += ["", "| Source | Listed | Qualifying | Fetched |", "|---|--:|--:|--:|"]
        out += [f"| {r['source']} | {r['listed']} | {r['qualifying']} | {r['fetched']} |" for r in own]
    return out


def journey(stages: dict[str, DataFrame], key: str, value: str) -> list[str]:
    """One record's way through a run's ``stages``, each the record's JSON as it was there or that it wasn't there."""
    out = []
    for k, (name, rows) in enumerate(stages.items(), 1):
        got = rows.where(F.col(key) == value).select(F.to_json(F.struct("*")).alias("j")).limit(1).collect()
        out += [f"--- {k}. {name} ---", got[0]["j"] if got else "(not here)"]
    return out
