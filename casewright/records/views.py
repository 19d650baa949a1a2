"""What a reader sees of published records: the feed, filters, sorters, markers, legends and notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import codes, minors
from casewright.operators.aggregates import ACTIVE
from casewright.records import gates
from casewright.records.schema import ID, id_part, listed

CLOSED = ("CONVICTED", "ACQUITTED", "QUASHED", "CLOSED")
#: Statuses of which it is true that there is no verdict yet.
BEFORE_VERDICT = ("FIR_FILED", "CHARGESHEETED", "UNDER_TRIAL")
#: Fixed value: hours after which what is shown counts as stale.
STALE = 48


def feed(rows: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` latest records by date and id, with the columns that a card shows."""
    flag = lambda n: F.coalesce(n, F.lit(False)).alias(n)
    first = F.coalesce(F.get(F.col("sources"), F.lit(0))["publisher"], F.lit("")).alias("publisher")
    latest = rows.orderBy(F.desc(F.coalesce("incident_reported_date", F.lit(""))), F.desc(F.coalesce("id", F.lit("")))).limit(k)
    return latest.select("id", "title", "summary", "state", "district", "category", "status", listed("offence_sections").alias("offence_sections"), "incident_reported_date", "days_since_reported", flag("minor_involved"), first, flag("verified"), "first_published", "last_status_change", gates.tier().alias("source_tier"), "traced_to_court")


def explore(rows: DataFrame, *, state=None, district=None, status=None, activity=None, year=None, minor=None, q="", sort="pending", order="ord") -> DataFrame:
    """The records that meet all conditions given, all of them, sorted; equal ones stay in ``order``.

    ``q`` is searched, whatever its case, in summary, district, court number, sections and court.
    """
    for column, value in (("state", state), ("district", district), ("status", status)):
        rows = rows if not value else rows.where(F.col(column) == value)
    if activity:
        rows = rows.where(F.col("status").isin(*(ACTIVE if activity == "active" else CLOSED)))
    if year:
        rows = rows.where(F.substring("incident_reported_date", 1, 4) == str(year))
    if minor is not None:
        rows = rows.where(F.coalesce("minor_involved", F.lit(False)) == minor)
    if q.strip():
        text = lambda n: F.coalesce(n, F.lit(""))
        rows = rows.where(F.lower(F.concat_ws(" ", text("summary"), text("district"), text("cnr"), F.array_join(listed("offence_sections"), " "), text("court.name"))).contains(q.strip().lower()))
    date = F.coalesce("incident_reported_date", F.lit(""))
    keys = {"recent": date.desc(), "oldest": date.asc()}
    return rows.orderBy(keys.get(sort, F.coalesce("days_since_reported", F.lit(0)).desc()), order)


def state_of(record_id: Column) -> Column:
    """The state that an id was minted in, null for what is no id."""
    return id_part(2, record_id)


def find(rows: DataFrame, record_id: str) -> DataFrame:
    """The record of that id, read from its state's records alone; none for what is no id."""
    import re

    known = re.match(ID, record_id or "")
    return rows.where(F.lit(False)) if known is None else rows.where((F.col("state") == known[2]) & (F.col("id") == record_id))


def tracing() -> Column:
    """How far a record is traced: struct(marker, since). traced with the day, legal_press or media; null for a record that a court always told."""
    marker = F.when(F.col("traced_to_court").isNotNull(), "traced").when(gates.court_source(), None).when(gates.tier() <= 2, "legal_press").otherwise("media")
    return F.when(marker.isNotNull(), F.struct(marker.alias("marker"), F.col("traced_to_court").alias("since")))


def ticker() -> Column:
    """struct(days, label, no_verdict) of an active case that isn't a minor's, null for others: the days are without
    justice where a court, its name or number stands for the case, else since it was first reported."""
    said = lambda c: F.coalesce(c != "", F.lit(False))
    anchored = gates.court_source() | said(F.col("court.name")) | said(F.col("cnr"))
    shown = ~F.coalesce("minor_involved", F.lit(False)) & F.col("status").isin(*ACTIVE) & F.col("days_since_reported").isNotNull()
    return F.when(shown, F.struct(F.col("days_since_reported").alias("days"), F.when(anchored, "days_without_justice").otherwise("days_since_reported").alias("label"), (anchored & F.col("status").isin(*BEFORE_VERDICT)).alias("no_verdict")))


def split_sources() -> Column:
    """struct(clean, flagged): the sources whose URL tells no more than it should, and those behind a fold; both in order."""
    bad = lambda s: F.coalesce(s["url_carries_identifying_slug"], F.lit(False))
    return F.struct(F.filter(listed("sources"), lambda s: ~bad(s)).alias("clean"), F.filter(listed("sources"), bad).alias("flagged"))


def accused_lines() -> Column:
    """struct(label, name, status) of each accused, a withheld name being null; none for a minor's record."""
    own = F.transform(listed("accused"), lambda a: F.struct(a["label"].alias("label"), F.nullif(a["name_public_court_record"], F.lit("")).alias("name"), a["status"].alias("status")))
    return F.when(F.coalesce("minor_involved", F.lit(False)), F.slice(own, 1, 0)).otherwise(own)


def legend(counts: DataFrame) -> DataFrame:
    """(status, label, n, share) of (status, n): statuses that have cases, with their share of all, which a ring shows."""
    total = counts.agg(F.sum("n").alias("_t")).withColumn("_k", F.lit(0))
    label = F.coalesce(codes.lookup(minors.STATUSES, F.col("status")), F.col("status"))
    return counts.where("n > 0").withColumn("_k", F.lit(0)).join(total, "_k").select("status", label.alias("label"), "n", (F.col("n") / F.col("_t")).alias("share"))


def scorecard_sorted(cards: DataFrame, key: str, descending: bool = True, order: tuple[str, ...] = ("state", "district")) -> DataFrame:
    """The cards by one column, those without a value last in both directions, equal ones by place."""
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    return cards.orderBy(first, *order)


def no_local_source(cards: DataFrame, coverage: DataFrame) -> DataFrame:
    """The cards with no_local_source: whether their state has no source of its own; a state that isn't covered has none."""
    active = coverage.select("state", F.col("active_sources").alias("_a"))
    return cards.join(F.broadcast(active), "state", "left").withColumn("no_local_source", F.coalesce("_a", F.lit(0)) == 0).drop("_a")


def state_picker(counts: DataFrame) -> DataFrame:
    """(state, name, n): states by their cases, most first, then by name."""
    return counts.select("state", codes.state_name(F.col("state")).alias("name"), "n").orderBy(F.desc("n"), "name")


def hours_since(timestamp: Column, now: str) -> Column:
    """Hours from a timestamp to ``now``, with fractions; null for what is no timestamp."""
    return (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(timestamp.try_cast("timestamp"))) / 3600


def stale(timestamp: Column, now: str, hours: int = STALE) -> Column:
    """Whether what was generated then is stale; what has no time is."""
    return F.coalesce(hours_since(timestamp, now) > hours, F.lit(True))


def live_counter(date: Column, now: str) -> Column:
    """struct(days, hours, minutes) since the start of the reported day, null for a date without a day."""
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), date).try_cast("timestamp"))
    part = lambda size, of: F.floor(seconds % of / size).cast("int") if of else F.floor(seconds / size).cast("int")
    return F.when(seconds >= 0, F.struct(part(86400, 0).alias("days"), part(3600, 86400).alias("hours"), part(60, 3600).alias("minutes")))


def orphans(feed_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """(id) of the feed that no published record has."""
    return feed_rows.select("id").distinct().join(rows.select("id"), "id", "left_anti")


def missing_states(cards: DataFrame, states: list[str] = codes.STATES) -> DataFrame:
    """(state) of the known states that no card is of."""
    every = cards.sparkSession.createDataFrame([(s,) for s in states], "state string")
    return every.join(cards.select("state").distinct(), "state", "left_anti")


def court_first(docs: DataFrame, order: str = "ord") -> DataFrame:
    """Documents in the order in which they are worked on: those of official publishers first, equal ones as they came."""
    return docs.orderBy(F.when(codes.any_of(F.col("publisher"), codes.OFFICIAL), 0).otherwise(1), order)
