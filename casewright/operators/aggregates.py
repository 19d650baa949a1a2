"""Published aggregates over case records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.functions import codes, dates

ACTIVE = ["FIR_FILED", "CHARGESHEETED", "UNDER_TRIAL", "APPEAL_PENDING"]


def counts(cases: DataFrame, column: str) -> DataFrame:
    """(column, n); a missing value counts as UNKNOWN."""
    return cases.groupBy(F.coalesce(column, F.lit("UNKNOWN")).alias(column)).agg(F.count("*").alias("n"))


def monthly_trend(cases: DataFrame, run_date: str, months: int = 24) -> DataFrame:
    """(month, n) for the last months, zero where there is nothing; bare years don't count."""
    seen = cases.where(F.length("incident_reported_date") >= 7).groupBy(F.substring("incident_reported_date", 1, 7).alias("m")).agg(F.count("*").alias("n"))
    spine = dates.month_spine(cases.sparkSession, run_date, months)
    return spine.join(seen, F.col("month") == F.col("m"), "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


def jurisdiction_scorecard(cases: DataFrame, run_date: str, most: int = 120) -> DataFrame:
    """A row for each state and district: totals, share under trial, outcomes, pendency (of active cases that a court number stands for, without a minor)."""
    days = F.when(~F.col("minor_involved") & F.col("status").isin(ACTIVE) & F.col("cnr").isNotNull(), dates.days_since(F.col("incident_reported_date"), run_date))
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    rows = cases.withColumn("days", days).groupBy("state", "district").agg(
        F.count("*").alias("total"), n("UNDER_TRIAL").alias("under_trial"), n("CONVICTED").alias("convictions"), n("ACQUITTED", "QUASHED").alias("acquittals"), n("FIR_FILED").alias("pre_chargesheet"),
        F.median("days").cast("int").alias("median_pending"), F.max(F.struct("days", "ord")).alias("longest"),
    )
    pct = F.bround(F.lit(100.0) * F.col("under_trial") / F.col("total"), 0).cast("int")
    longest = F.when(F.col("longest.days").isNotNull(), F.col("longest.ord"))
    return rows.withColumns({"under_trial_pct": pct, "longest_days": F.col("longest.days"), "longest_ord": longest}).drop("longest").orderBy(F.desc("total"), "state", "district").limit(most)


def top_pending(cases: DataFrame, run_date: str, k: int = 10) -> DataFrame:
    """The ``k`` anchored, active cases without a minor that have waited longest."""
    rows = cases.where(F.col("status").isin(ACTIVE) & ~F.col("minor_involved") & F.col("cnr").isNotNull()).select("ord", "state", "district", dates.days_since(F.col("incident_reported_date"), run_date).alias("days"))
    return rows.where("days is not null").orderBy(F.desc("days"), "ord").limit(k)


def severity_summary(cases: DataFrame) -> DataFrame:
    """(label, n, aggravated): cases by the rule that their sections match; cases that match none don't count."""
    rows = cases.select(codes.severity_rule(F.col("sections")).alias("rule"))
    return rows.where("rule is not null").groupBy("rule").agg(F.count("*").alias("n")).select("rule.label", "n", F.when(F.col("rule.aggravated"), F.col("n")).otherwise(0).alias("aggravated"))


def coverage(cases: DataFrame, states: list[str]) -> DataFrame:
    """Every state, with its records and whether it has any."""
    every = cases.sparkSession.createDataFrame([(s,) for s in states], "code string")
    seen = cases.groupBy("state").agg(F.count("*").alias("records"))
    return every.join(seen, F.col("code") == F.col("state"), "left").select(F.col("code").alias("state"), F.coalesce("records", F.lit(0)).alias("records"), F.col("records").isNull().alias("gap"))


def trackability(cases: DataFrame) -> DataFrame:
    anchored = F.count_if(F.col("cnr").isNotNull())
    return cases.agg(F.count("*").alias("total"), anchored.alias("anchored"), F.bround(anchored / F.count("*"), 4).alias("rate"))


def ingestion_scale(events: DataFrame, run_date: str, days: int = 120) -> DataFrame:
    """(day, n, week, total): events of each day, of the seven days up to it, and of all days so far."""
    from pyspark.sql import Window

    seen = events.groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    rows = dates.day_spine(events.sparkSession, run_date, days).join(seen, F.col("day") == F.col("d"), "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.orderBy("day")  # one row a day of a spine of fixed length
    return rows.select("day", "n", F.sum("n").over(w.rowsBetween(-6, 0)).alias("week"), F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"))


def source_funnel(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each source how many documents came, were extracted, were published, and the share that passed."""
    rows = docs.select("doc_id", "source").join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("documents"), F.count("quality").alias("extracted"), F.count_if(F.col("quality") == 1).alias("published"))
    return rows.withColumn("pass_rate", F.bround(F.col("published") / F.col("documents"), 3))


def stalled(cases: DataFrame) -> DataFrame:
    """The share that has got no further than its first report, in whole percent, halves up."""
    return cases.agg(F.floor(F.lit(100.0) * F.count_if(F.col("status") == "FIR_FILED") / F.count("*") + 0.5).cast("long").alias("pct"), F.count_if(F.col("status").isin(ACTIVE)).alias("active"), F.count("*").alias("total"))
