"""A record against the schema's rules, and the checks that all records pass before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import minors, multilingual, text
from casewright.operators.gates import STATUSES, reasons
from casewright.records.schema import ID, listed

#: Closed lists of the schema.
CATEGORIES = ("sexual_assault", "rape", "pocso", "acid_attack", "harassment", "other")
ACTIONS = ("arrest_made", "chargesheet_filed", "bail_granted", "bail_denied", "sit_formed", "suspension_ordered", "convicted", "acquitted", "appeal_filed")
SOURCE_TYPES = ("court", "legal_press", "news_article", "live_blog", "press_release")
PROVENANCES = ("source_url", "wayback", "first_published")
#: Outcomes that a ledger may hold.
OUTCOMES = ("published", "rejected", "out_of_scope", "not_a_case", "out_of_window", "staged_pending", "failed", "failed_permanent")
_DAY = r"^\d{4}-\d{2}-\d{2}$"
#: A link, or a bare domain.
_URL = r"(?i)https?://|www\.|\b[\w-]+\.(?:com|in|org|net|gov|io)\b"


def violations() -> Column:
    """Names of the rules of the schema that a record breaks, in the schema's order; empty if it conforms.

    A field that a record needs is named where it is null; any other null is fine. ``minor_*`` and ``adult_*`` are the
    rules that hold for records with and without a minor.
    """
    date, minor = F.col("incident_reported_date"), F.coalesce("minor_involved", F.lit(False))
    any_ = lambda name, test: F.exists(listed(name), lambda x: F.coalesce(test(x), F.lit(True)))
    status = lambda c: ~c.isin(*STATUSES)
    lacks = lambda n: F.col(n).isNull()
    day = lambda n: ~F.col(n).rlike(_DAY)
    rules = {
        "id": lacks("id") | ~F.col("id").rlike(ID),
        "state": lacks("state") | ~F.col("state").rlike("^[A-Z]{2}$"),
        "district": lacks("district"),
        "incident_reported_date": ~date.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"),
        "category": lacks("category") | ~F.col("category").isin(*CATEGORIES),
        "minor_involved": lacks("minor_involved"),
        "status": lacks("status") | status(F.col("status")),
        "accused_count": F.col("accused_count") < 1,
        "institutional_actions": any_("institutional_actions", lambda a: ~a.isin(*ACTIONS)),
        "sentence_years": F.col("sentence_years") < 0,
        "status_history": any_("status_history", lambda e: status(e["status"]) | ~e["date"].rlike(r"^\d{4}-\d{2}(-\d{2})?$") | (e["source"] < 0)),
        "accused": any_("accused", lambda a: a["label"].isNull() | status(a["status"])),
        "days_since_reported": F.col("days_since_reported") < 0,
        "title": lacks("title") | (F.length("title") < 1) | (F.length("title") > 90),
        "summary": F.length("summary") > 400,
        "sources": F.size(listed("sources")) < 1,
        "source_fields": any_("sources", lambda s: s["url"].isNull() | s["publisher"].isNull() | ~s["retrieved"].rlike(_DAY)),
        "source_type": F.exists(listed("sources"), lambda s: F.coalesce(~s["source_type"].isin(*SOURCE_TYPES), F.lit(False))),
        "confidence": lacks("confidence") | ~F.col("confidence").between(0, 1),
        "first_published": lacks("first_published") | day("first_published"),
        "last_status_change": day("last_status_change"),
        "verification_note": F.length("verification_note") > 300,
        "traced_to_court": day("traced_to_court"),
        "incident_date_provenance": ~F.col("incident_date_provenance").isin(*PROVENANCES),
        "minor_accused": minor & F.col("accused").isNotNull(),
        "minor_date": minor & ~date.rlike(r"^\d{4}(-\d{2})?$"),
        "minor_title": minor & ~F.col("title").rlike("[Cc]hild|[Mm]inor"),
        "minor_summary": minor & ~F.col("summary").endswith(minors.WITHHELD),
        "minor_hearing": minor & F.col("court.next_hearing").isNotNull(),
        "adult_date": ~minor & ~date.rlike(_DAY),
        "adult_history": ~minor & any_("status_history", lambda e: ~e["date"].rlike(_DAY)),
    }
    return reasons(**rules)


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that conform, the others with the rules that they break as reasons)."""
    marked = rows.withColumn("reasons", violations())
    return marked.where("size(reasons) = 0").drop("reasons"), marked.where("size(reasons) > 0")


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """(id, n) of ids that more than one record has."""
    return rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def assert_ready(rows: DataFrame, most: int = 20) -> None:
    """Fails, naming some of them, if an id repeats or a record breaks a rule; nothing may be written after that."""
    found = [f"id {r['id']} given {r['n']} times" for r in duplicate_ids(rows).orderBy("id").limit(most).collect()]
    found += [f"{r['id']}: {', '.join(r['reasons'])}" for r in split_valid(rows)[1].select("id", "reasons").orderBy("id").limit(most).collect()]
    if found:
        raise ValueError("records can't be written: " + "; ".join(found))


def url_shaped(value: Column) -> Column:
    """Whether a string looks like a link or a bare domain; false for null."""
    return F.coalesce(value.rlike(_URL), F.lit(False))


def ledger_violations() -> Column:
    """Names of the rules that an entry of the ledger (url_hash, outcome, attempts, first_seen, last_seen) breaks.

    Keys are hashes, outcomes come from a closed list, days are days, and nothing in it looks like a URL.
    """
    return reasons(
        url_hash=F.col("url_hash").isNull() | ~F.col("url_hash").rlike("^[0-9a-f]{64}$"),
        outcome=F.col("outcome").isNull() | ~F.col("outcome").isin(*OUTCOMES),
        attempts=F.col("attempts") < 0,
        first_seen=F.col("first_seen").isNull() | ~F.col("first_seen").rlike(_DAY),
        last_seen=F.col("last_seen").isNull() | ~F.col("last_seen").rlike(_DAY),
        url=F.exists(F.array(*[F.col(c).cast("string") for c in ("url_hash", "outcome", "first_seen", "last_seen")]), url_shaped),
    )


def tree_findings(rows: DataFrame) -> DataFrame:
    """(id, path, reason): what the written records hold that they may not: unreadable prose, native script, romanised traces."""
    prose = lambda n: F.coalesce(F.col(n), F.lit(""))
    told = lambda path, hits: F.transform(hits, lambda h: F.struct(F.lit(path).alias("path"), h.alias("reason")))
    minor = F.coalesce("minor_involved", F.lit(False))
    style = F.when(~minor, text.readability_violations(prose("summary"))).otherwise(F.array().cast("array<string>"))
    found = F.concat(told("summary", style), *[told(n, multilingual.hits(prose(n))) for n in ("title", "summary")])
    return rows.select("id", F.explode(found).alias("f")).select("id", "f.path", "f.reason")
