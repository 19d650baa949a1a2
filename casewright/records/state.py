"""What a run remembers for the next one: processed documents, money, corrections, and records that wait."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright.operators import guards
from casewright.records import sanitize
from casewright.records.resolve import anchor_keys, combine
from casewright.records.schema import NAMES, RECORD, listed

#: Outcomes after which a document is not looked at again, and how often a failing one is tried.
SETTLED = ("published", "rejected", "out_of_scope", "not_a_case", "out_of_window")
ATTEMPTS = 3
LEDGER = "url_hash string, outcome string, attempts int, first_seen string, last_seen string"


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)


def to_process(docs: DataFrame, ledger: DataFrame, attempts: int = ATTEMPTS) -> DataFrame:
    """``docs`` (url, ..) that are new, failed less than ``attempts`` times, or are not settled yet."""
    done = F.col("outcome").isin(*SETTLED, "failed_permanent") | (F.col("outcome") == "failed") & (F.col("attempts") >= attempts)
    return docs.withColumn("_h", url_hash(F.col("url"))).join(ledger.where(done).select(F.col("url_hash").alias("_h")), "_h", "left_anti").select(docs.columns)


def pending(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """``docs`` with _pending: whether the document's record was written but has not been seen on the site. A URL may have several entries."""
    known = ledger.where("outcome = 'staged_pending'").select(F.col("url_hash").alias("_h")).distinct().withColumn("_pending", F.lit(True))
    return docs.withColumn("_h", url_hash(F.col("url"))).join(known, "_h", "left").withColumn("_pending", F.coalesce("_pending", F.lit(False))).select(*docs.columns, "_pending")


def confirm_published(ledger: DataFrame, urls: DataFrame, run_date: str) -> DataFrame:
    """The ledger with pending entries settled whose document is among ``urls`` (url) of the records on the site."""
    seen = urls.select(url_hash(F.col("url")).alias("url_hash")).distinct().withColumn("_seen", F.lit(True))
    hit = F.coalesce("_seen", F.lit(False)) & (F.col("outcome") == "staged_pending")
    return ledger.join(seen, "url_hash", "left").select("url_hash", F.when(hit, "published").otherwise(F.col("outcome")).alias("outcome"), "attempts", "first_seen", F.when(hit, F.lit(run_date)).otherwise(F.col("last_seen")).alias("last_seen"))


def record_urls(rows: DataFrame) -> DataFrame:
    """(url) of all sources of records, each once."""
    return rows.select(F.explode(listed("sources")).alias("s")).select("s.url").where("url is not null").distinct()


def load_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The state table at ``path``, empty where nothing was ever written there; anything else that fails is an error."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, LEDGER)


def load_spend(spark: SparkSession, path: str) -> DataFrame:
    """(month, usd): what was spent in each month."""
    return load_table(spark, path, "month string, usd double")


def load_records(spark: SparkSession, path: str) -> DataFrame:
    """(ord, *record) of the table of records at ``path``, a queue or the published ones, in a fixed order; empty where there is none."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECORD)
    return load_table(spark, path, f"ord long, {kinds}")


def load_approved(spark: SparkSession, path: str) -> DataFrame:
    """(url): the source URLs that a human has approved, as written; empty ones don't count."""
    return load_table(spark, path, "url string").select(F.trim("url").alias("url")).where("url <> ''").distinct()


def load_corrections(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, quarantine, overrides) from the JSON files under ``path``; a file that is none, or names no record, is
    left out, and of files for one record the last by name counts."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("n"), F.col("value").alias("v"))
    told = files.select("n", F.from_json("v", "record_id string, quarantine boolean, overrides string").alias("c")).where("c.record_id <> ''")
    return told.groupBy("c.record_id").agg(F.max(F.struct("n", "c"))["c"].alias("c")).select("record_id", "c.quarantine", "c.overrides")


def source_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with source_text: the text of the first of a record's sources that ``docs`` (url, text) has one of, else empty."""
    keyed = rows.withColumn("_n", F.monotonically_increasing_id())
    cited = keyed.select("_n", F.posexplode(F.transform(listed("sources"), lambda s: s["url"])).alias("place", "url"))
    known = docs.where("text <> ''").groupBy("url").agg(F.min("text").alias("text"))
    first = cited.join(known, "url").groupBy("_n").agg(F.min(F.struct("place", "text"))["text"].alias("_t"))
    return keyed.join(first, "_n", "left").select(*rows.columns, F.coalesce("_t", F.lit("")).alias("source_text"))


def with_verdicts(rows: DataFrame, verdicts: DataFrame, key: str = "ord") -> DataFrame:
    """``rows`` (key, *record) with verified, verification_note, the second source that a verifier found, and incomplete.

    ``verdicts``: (key, verdict) as ``operators.models.verdict`` gives it. A record without a parsed verdict is unverified
    and incomplete: it is held, not declined. A second source is added only to a verified record that hasn't its URL; it
    is dated by first publication, else by the first source that has a date.
    """
    joined = rows.join(verdicts.select(key, F.col("verdict").alias("_v")), key, "left")
    parsed = F.coalesce("_v.parsed", F.lit(False))
    yes = parsed & F.coalesce("_v.verified", F.lit(False))
    dated = F.get(F.filter(F.transform(listed("sources"), lambda s: F.trim(s["retrieved"])), lambda d: d != ""), F.lit(0))
    kind = RECORD["sources"].dataType.elementType
    second = F.struct(F.trim("_v.second_url").alias("url"), F.col("_v.second_publisher").alias("publisher"), F.coalesce(F.nullif("first_published", F.lit("")), dated, F.lit("")).alias("retrieved"), F.lit("news_article").alias("source_type"), F.lit(None).cast("boolean").alias("url_carries_identifying_slug"), F.lit(None).cast("string").alias("archive_url")).cast(kind)
    new = yes & F.coalesce(F.trim("_v.second_url") != "", F.lit(False)) & ~F.coalesce(F.array_contains(F.transform(listed("sources"), lambda s: s["url"]), F.trim("_v.second_url")), F.lit(False))
    note = F.when(parsed & (F.col("_v.note") != ""), F.col("_v.note")).otherwise(F.col("verification_note"))
    return joined.withColumn("_sources", F.when(new, F.array_append(listed("sources"), second)).otherwise(F.col("sources"))).withColumns({"verified": yes, "verification_note": note, "incomplete": ~parsed}).drop("sources", "_v").withColumnRenamed("_sources", "sources").select(*rows.columns, "incomplete")


def month_of(run_date: Column) -> Column:
    return F.substring(run_date, 1, 7)


def month_to_date(spend: DataFrame, run_date: str) -> float:
    """What the run's month has cost so far, 0 without an entry."""
    return float(spend.where(F.col("month") == run_date[:7]).agg(F.coalesce(F.sum("usd"), F.lit(0.0))).first()[0])


def record_spend(spend: DataFrame, costs: DataFrame) -> DataFrame:
    """The months' totals with ``costs`` (run_date, usd) added, to six places; a negative cost counts as none."""
    new = costs.select(month_of(F.col("run_date")).alias("month"), F.greatest(F.lit(0.0), F.col("usd").cast("double")).alias("usd"))
    return spend.select("month", "usd").union(new).groupBy("month").agg(F.round(F.sum("usd"), 6).alias("usd"))


def apply_corrections(rows: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with the overrides of their corrections, records that a correction quarantines).

    ``corrections``: (record_id, quarantine, overrides), one for an id at most; overrides is a record's JSON or null. A
    field that is forbidden, the id and the minor's flag are never set. A record with an override is marked as
    corrected and sanitised again by whoever writes it.
    """
    may = [n for n in NAMES if guards.may_override(n)]
    told = corrections.select(F.col("record_id").alias("_id"), F.coalesce("quarantine", F.lit(False)).alias("_out"), F.from_json("overrides", RECORD).alias("_o"))
    joined = rows.join(told, F.col("id") == F.col("_id"), "left")
    some = F.coalesce(F.greatest(*[F.col(f"_o.{n}").isNotNull() for n in may]), F.lit(False))
    fixed = {n: F.coalesce(F.col(f"_o.{n}"), F.col(n)) for n in may if n in rows.columns}
    out = joined.withColumns({**fixed, "corrected": F.when(some, F.lit(True)).otherwise(F.coalesce(fixed["corrected"], F.col("corrected")))})
    gone = F.coalesce("_out", F.lit(False))
    return out.where(~gone).select(rows.columns), joined.where(gone).select(rows.columns)


def held_queue(rows: DataFrame) -> DataFrame:
    """(reasons, *record) of the records that wait for a human, as they may be written: minors coerced, then sanitised."""
    return _queue(rows, "reasons")


def review_queue(rows: DataFrame) -> DataFrame:
    """(reason, *record) of the records that were diverted, as they may be written."""
    return _queue(rows, "reason")


def _queue(rows: DataFrame, why: str) -> DataFrame:
    told = sanitize.sanitize(sanitize.coerce_minor(rows.select(F.col(why).alias("_why"), *NAMES)))
    return told.select(F.col("_why").alias(why), *NAMES)


def carried(existing: DataFrame, queue: DataFrame | None = None, staged: DataFrame | None = None) -> DataFrame:
    """All records that go through resolution again, in this order: what is on the site, what waits, what was staged;
    a staged or waiting record whose id is there already is merged into that one."""
    out = existing.select(NAMES)
    for more in (queue, staged):
        if more is not None:
            out = combine(out, more.select(NAMES))
    return out


def in_order(*parts: DataFrame) -> DataFrame:
    """(ord, *record): the parts one after the other, each by its own ``ord``; ord is counted anew and keeps that order."""
    both = None
    for k, part in enumerate(parts):
        one = part.select((F.lit(k).cast("long") * F.lit(1 << 40) + F.col("ord")).alias("ord"), *NAMES)
        both = one if both is None else both.unionByName(one)
    return both


def with_carryover(rows: DataFrame, carryover: DataFrame) -> DataFrame:
    """``rows`` with carried: whether a carried-over record has the same id or one of the same source URLs."""
    ids = carryover.where("id <> ''").select("id").distinct().withColumn("_i", F.lit(True))
    keyed = rows.withColumn("_n", F.monotonically_increasing_id())
    hit = keyed.select("_n", F.explode(F.transform(listed("sources"), lambda s: s["url"])).alias("url")).join(record_urls(carryover), "url", "left_semi").select("_n").distinct().withColumn("_u", F.lit(True))
    return keyed.join(ids, "id", "left").join(hit, "_n", "left").select(*rows.columns, (F.coalesce("_i", F.lit(False)) | F.coalesce("_u", F.lit(False))).alias("carried"))


def preserve_narrative(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Refreshed records with the title and summary that were reviewed, and narrative_held: whether that changed one.

    The reviewed record is that of the same id, else the first (by ``ord``) with the first of the anchors that one has.
    Minors' sentences are made from codes and stay as they are.
    """
    old = existing.select("ord", "id", "title", "summary", anchor_keys().alias("keys"))
    by_id = old.where("id <> ''").groupBy("id").agg(F.max(F.struct("ord", "title", "summary")).alias("_a"))
    by_key = old.select("ord", "title", "summary", F.explode("keys").alias("key")).groupBy("key").agg(F.min(F.struct("ord", "title", "summary")).alias("o"))
    keyed = rows.withColumn("_n", F.monotonically_increasing_id())
    found = keyed.select("_n", F.posexplode(anchor_keys()).alias("place", "key")).join(by_key, "key").groupBy("_n").agg(F.min(F.struct("place", "o"))["o"].alias("_b"))
    both = keyed.join(by_id, "id", "left").join(found, "_n", "left").withColumn("_p", F.coalesce("_a", "_b"))
    minor = F.coalesce("minor_involved", F.lit(False))
    text = {n: F.when(~minor, F.coalesce(F.nullif(F.col(f"_p.{n}"), F.lit("")), F.col(n))).otherwise(F.col(n)) for n in ("title", "summary")}
    held = ~text["title"].eqNullSafe(F.col("title")) | ~text["summary"].eqNullSafe(F.col("summary"))
    return both.withColumn("narrative_held", held).withColumns(text).select(*rows.columns, "narrative_held")


def last_checked(rows: DataFrame, run_date: str) -> DataFrame:
    """(id, last_checked): every record that this run looked at."""
    return rows.where("id is not null").select("id", F.lit(run_date).alias("last_checked")).distinct()


def fates(docs: DataFrame, published: DataFrame, existing: DataFrame, review: DataFrame, held: DataFrame, ledger: DataFrame) -> DataFrame:
    """(url, outcome) for the ledger of ``docs`` (url, outcome); documents that are not settled are left out.

    A document whose record waits for a human is never settled, nor is a failure of one that is pending. An extracted
    document is published if its URL is on the site already, pending if this run wrote it, else out of the window.
    URLs of records are sanitised, so documents' are compared in that form too.
    """
    form = docs.select("url", "outcome", sanitize.clean(F.col("url")).alias("_c"))
    waits = record_urls(review).union(record_urls(held)).distinct()
    rows = pending(form, ledger).where("not (outcome = 'failed' and _pending)")
    for name, urls in (("_wait", waits), ("_live", record_urls(existing)), ("_made", record_urls(published))):
        rows = rows.join(urls.select(F.col("url").alias("_c"), F.lit(True).alias(name)), "_c", "left")
    told = F.when(F.col("outcome") != "extracted", F.col("outcome")).when(F.col("_live"), "published").when(F.col("_made"), "staged_pending").otherwise("out_of_window")
    return rows.where("_wait is null").select("url", told.alias("outcome"))
