"""Reader's views: filters, search, sorting, facets, feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.functions import dates
from casewright.operators.aggregates import ACTIVE


def explore(cases: DataFrame, run_date: str, *, state=None, district=None, status=None, activity=None, year=None, minor=None, q=None, sort="pending", limit=None) -> DataFrame:
    """All given conditions hold; ``q`` is searched in five columns; ties go by ord."""
    rows = cases.withColumn("days", dates.days_since(F.col("incident_reported_date"), run_date))
    for column, value in (("state", state), ("district", district), ("status", status), ("minor_involved", minor)):
        rows = rows if value is None else rows.where(F.col(column) == value)
    if activity:
        rows = rows.where(F.col("status").isin(ACTIVE) if activity == "active" else F.col("status").isin("CONVICTED", "ACQUITTED", "QUASHED", "CLOSED"))
    if year:
        rows = rows.where(F.substring("incident_reported_date", 1, 4) == str(year))
    if q:
        rows = rows.where(F.lower(F.concat_ws(" ", "district", "status", "court", "section_1", "section_2")).contains(q.lower()))
    key = {"pending": F.coalesce("days", F.lit(0)).desc(), "recent": F.col("incident_reported_date").desc(), "oldest": F.col("incident_reported_date").asc()}[sort]
    rows = rows.orderBy(key, "ord")
    return rows if limit is None else rows.limit(limit)


def facets(cases: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) for all columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]))
    return cases.select(pairs.alias("f")).select("f.*").where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def feed(cases: DataFrame, k: int = 50) -> DataFrame:
    return cases.select("ord", "state", "district", "status", "incident_reported_date").orderBy(F.desc("incident_reported_date"), F.desc("ord")).limit(k)


def offenders(cases: DataFrame) -> DataFrame:
    """Named accused of cases without a minor: how many cases, the latest date."""
    rows = cases.where(~F.col("minor_involved") & F.col("accused_name").isNotNull())
    return rows.groupBy("accused_name").agg(F.count("*").alias("n"), F.max("incident_reported_date").alias("latest"), F.count_if(F.col("status") == "CONVICTED").alias("convictions"))


def state_grid(cases: DataFrame, states: list[str]) -> DataFrame:
    """(state, n, intensity) for every one of ``states`` and every other that has cases; 0.25 to 1 by the greatest count, 0 without cases."""
    known = cases.sparkSession.createDataFrame([(s,) for s in states], "code string")
    rows = known.join(cases.groupBy("state").agg(F.count("*").alias("c")), F.col("code") == F.col("state"), "full").select(F.coalesce("code", "state").alias("state"), F.coalesce("c", F.lit(0)).alias("n")).where("state is not null")
    top = F.max("n").over(Window.partitionBy(F.lit(0)))  # a row for each state: few, whatever the cases
    return rows.select("state", "n", F.when(F.col("n") > 0, F.round(0.25 + 0.75 * F.col("n") / top, 3)).otherwise(0.0).alias("intensity"))


def heat_strip(trend: DataFrame) -> DataFrame:
    """(months, total, most, peak) of a trend (month, n); of equal months the first is the peak. One row."""
    return trend.agg(F.count("*").alias("months"), F.sum("n").alias("total"), F.max("n").alias("most"), F.min_by("month", F.struct(-F.col("n"), F.col("month"))).alias("peak"))


def timeline(history: Column, status: Column, date: Column) -> Column:
    """The history by date (equal dates stay in order); without one, the present status."""
    placed = F.transform(history, lambda e, k: F.struct(e["date"].alias("date"), k.alias("k"), e["status"].alias("status")))
    sorted_ = F.transform(F.array_sort(placed), lambda e: F.struct(e["status"].alias("status"), e["date"].alias("date")))
    return F.when(F.coalesce(F.size(history), F.lit(0)) > 0, sorted_).otherwise(F.array(F.struct(status.alias("status"), date.alias("date"))))


def display_date(text: Column) -> Column:
    """The date in the precision that it has: 2001, Aug 2001 or Aug 2, 2001; other text as it is, a dash for none."""
    day, month = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date")), F.when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01")).try_cast("date"))
    return F.coalesce(F.date_format(day, "MMM d, yyyy"), F.date_format(month, "MMM yyyy"), F.nullif(text, F.lit("")), F.lit("—"))


def recency(text: Column, run_date: str) -> Column:
    """How long ago a day is, in days, weeks, months or years; empty for dates without a day and for future ones."""
    n = F.datediff(F.lit(run_date).cast("date"), dates.strict_day(text))
    ago = lambda k, unit: F.concat(k.cast("string"), F.when(k == 1, f" {unit} ago").otherwise(f" {unit}s ago"))
    near = lambda d: F.floor(n / d + 0.5).cast("int")
    told = F.when(n < 0, "").when(n == 0, "today").when(n == 1, "yesterday").when(n < 7, ago(n, "day")).when(n < 45, F.when(near(7) == 1, "last week").otherwise(ago(near(7), "week")))
    told = told.when(n < 365, F.when(near(30) == 1, "last month").otherwise(ago(near(30), "month"))).when(near(365) == 1, "last year").otherwise(ago(near(365), "year"))
    return F.when(n.isNull(), "").otherwise(told)


def source_domain(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")), r"^www\.", "")


def body_and_footnote(summary: Column, footnote: str) -> Column:
    """struct(body, footnote): a summary without the fixed sentence that ends it, and that sentence."""
    ends = F.endswith(summary, F.lit(footnote))
    return F.struct(F.when(ends, F.rtrim(F.substring(summary, F.lit(1), F.length(summary) - len(footnote)))).otherwise(summary).alias("body"), F.when(ends, footnote).otherwise("").alias("footnote"))
