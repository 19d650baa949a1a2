"""Tables of a run, written as a whole or not at all: gates first, then a staging folder, then renames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.functions import dates
from casewright.operators import aggregates
from casewright.operators.durability import durable
from casewright.operators.guards import scan_json
from casewright.records.resolve import anchor_keys
from casewright.records.sanitize import clean
from casewright.records.schema import NAMES, from_json, listed, to_json
from casewright.records.validate import assert_ready
from casewright.sources.shards import parted

#: Fixed value: bytes that the summary may have, since a page loads it whole.
SUMMARY_BYTES = 50 * 1024


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def assert_no_pii(rows: DataFrame, most: int = 5) -> None:
    """Fails, naming some, if the JSON of a record that is to be written holds a forbidden field or a trace of a person."""
    found = scan_json(rows.select("id", to_json().alias("j")), "j").limit(most).collect()
    if found:
        raise ValueError("personal data in records to be written: " + "; ".join(f"{r['id']}: {r['path']} ({r['reason']})" for r in found))


def assert_small(summary: DataFrame, most: int = SUMMARY_BYTES) -> None:
    """Fails if the summary's rows are larger as JSON than a page may load."""
    size = summary.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"the summary has {size} bytes, {most} are allowed")


def write_tables(tables: dict[str, DataFrame], path: str, records: DataFrame | None = None, summary: DataFrame | None = None) -> list[str]:
    """Writes each table as Parquet under ``path``, replacing the one that is there; the names written.

    ``records`` and ``summary`` pass their gates before anything is written. All tables are written to a staging folder
    beside ``path`` first; only when every one is complete are they renamed into place, so a run that fails leaves what
    was there, and one that is lost between two renames is mended by running it again. A table may be read from the
    place that it replaces.
    """
    if records is not None:
        assert_ready(records)
        assert_no_pii(records)
    if summary is not None:
        assert_small(summary)
    spark = next(iter(tables.values())).sparkSession
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{staged}/{name}")
    fs, root = _fs(spark, path)
    fs.mkdirs(root)
    for name in tables:
        _, old = _fs(spark, f"{path}/{name}")
        _, new = _fs(spark, f"{staged}/{name}")
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise OSError(f"{staged}/{name} could not be renamed")
    fs.delete(_fs(spark, staged)[1], True)
    return sorted(tables)


def tables_written(spark: SparkSession, path: str) -> list[str]:
    """The names of the tables under ``path``, ascending; none where nothing was written."""
    fs, root = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()) if fs.exists(root) else []


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A report's or log's few lines as one text file, replaced whole."""
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(("\n".join(lines) + "\n").encode())
    out.close()


def log_lines(lines: list[str], spark: SparkSession) -> list[str]:
    """Lines of a log without personal data, in order; logs never carry it either."""
    rows = spark.createDataFrame(list(enumerate(lines)), "k int, line string")
    return [r["line"] for r in rows.select("k", clean(F.col("line")).alias("line")).orderBy("k").collect()]


def summary(rows: DataFrame, run_date: str, scale: DataFrame | None = None) -> DataFrame:
    """One row: what the landing page loads of the published ``rows`` (ord, *record); its lists are bounded.

    total, status_counts, state_counts, severity_counts, aggravated_total, monthly_trend, top_longest_pending,
    jurisdictions and, if ``scale`` (day, n, week, total) is given, its days. Pendency needs an anchor to ask again with.
    """
    anchor = F.when(F.size(anchor_keys()) > 0, F.lit("anchored"))
    flat = durable(rows.select("ord", "id", "state", "district", "status", F.coalesce("minor_involved", F.lit(False)).alias("minor_involved"), "incident_reported_date", listed("offence_sections").alias("sections"), anchor.alias("cnr")))
    one = lambda df, name, *columns: df.agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name)).withColumn("_k", F.lit(0))
    named = flat.select("ord", "id")
    rule = aggregates.severity_summary(flat)
    parts = [
        one(aggregates.counts(flat, "status"), "status_counts", "status", "n"),
        one(aggregates.counts(flat, "state"), "state_counts", "state", "n"),
        one(rule, "severity_counts", "label", "n"),
        rule.agg(F.coalesce(F.sum("aggravated"), F.lit(0)).alias("aggravated_total")).withColumn("_k", F.lit(0)),
        one(aggregates.monthly_trend(flat, run_date), "monthly_trend", "month", "n"),
        one(aggregates.top_pending(flat, run_date).join(named, "ord"), "top_longest_pending", (-F.col("days")).alias("rank"), "ord", "id", "state", "district", "days"),
        one(aggregates.jurisdiction_scorecard(flat, run_date).drop("longest_ord"), "jurisdictions", (-F.col("total")).alias("rank"), "state", "district", "total", "under_trial", "under_trial_pct", "convictions", "acquittals", "pre_chargesheet", "median_pending", "longest_days"),
    ]
    if scale is not None:
        parts.append(one(scale, "daily", "day", "n"))
    out = flat.agg(F.count("*").alias("total")).withColumns({"_k": F.lit(0), "generated_at": F.lit(f"{run_date}T00:00:00Z")})
    for part in parts:
        out = out.join(part, "_k")
    return out.drop("_k")


def write_records(rows: DataFrame, path: str, run_date: str, most: int = 500 * 1024) -> DataFrame:
    """Writes the records (ord, *record) as lines of JSON under ``path`` and gives the manifest (year, state, part, records, bytes).

    Files hold one year and state, latest records first, equal dates in order, and at most ``most`` bytes or one record.
    The gates come first: ids are unique, records valid and free of personal data. What was under ``path`` goes when the
    new files are complete, so nothing stale stays.
    """
    assert_ready(rows)
    assert_no_pii(rows)
    lines = rows.select("ord", "incident_reported_date", to_json().alias("value"), dates.year_of(F.coalesce("incident_reported_date", F.lit("")), run_date).alias("_year"), F.coalesce("state", F.lit("UNKNOWN")).alias("_state")).withColumn("_size", F.octet_length("value") + 1)
    dealt = durable(parted(lines, ["_year", "_state", F.desc("incident_reported_date"), "ord"], most))
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    dealt.sortWithinPartitions("_year", "_state", "_part", F.desc("incident_reported_date"), "ord").select("_year", "_state", "_part", "value").write.partitionBy("_year", "_state", "_part").text(staged)
    fs, old = _fs(rows.sparkSession, path)
    fs.delete(old, True)
    if not fs.rename(_fs(rows.sparkSession, staged)[1], old):
        raise OSError(f"{staged} could not be renamed")
    return dealt.groupBy(F.col("_year").alias("year"), F.col("_state").alias("state"), F.col("_part").alias("part")).agg(F.count("*").alias("records"), F.sum("_size").cast("long").alias("bytes"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record..) of all files under ``path``; a line that is no record is an error, never a gap."""
    got = spark.read.text(path + "/*/*/*").select(from_json(F.col("value")).alias("r"), "value")
    broken = F.raise_error(F.concat(F.lit("no record: "), F.substring("value", 1, 80)))
    return got.select(F.when(F.col("r.id").isNull(), broken.cast("string")).otherwise(F.col("r.id")).alias("_id"), "r").select(F.col("_id").alias("id"), *[F.col(f"r.{n}").alias(n) for n in NAMES[1:]])


def env_lines(counts: dict[str, object]) -> list[str]:
    """Counters as NAME=value lines that a shell can read: names in capitals, values without anything a shell would run."""
    return [f"{''.join(c if c.isalnum() else '_' for c in name).upper()}={''.join(c for c in str(value) if c.isalnum() or c in '._-')}" for name, value in counts.items()]
