"""The list of sources, by state, as rows, and which of them a run reads."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Kinds of source whose records have a status that can be asked for again.
COURTS = ("ecourts", "indiankanoon", "hc_judgments")
SCHEMA = "state string, type string, publisher string, enabled boolean, url string, endpoints array<string>, queries array<string>, courts array<struct<court: string, listing_url: string, base_url: string>>"


def _entries(data: Any) -> Iterator[tuple[str, Mapping]]:
    """A file's entries with their state: the old form is one list; the present one has national sources and lists by state."""
    if not isinstance(data, Mapping):
        return
    if "sources" in data:
        blocks = {"national": data["sources"]}
    else:
        blocks = {"national": data.get("national")} | {str(s).strip().upper(): own for s, own in (data.get("states") or {}).items()}
    for state, own in blocks.items():
        yield from ((state, e) for e in own or () if isinstance(e, Mapping))


def parse(text: str) -> Any:
    """A source file's content: JSON, or YAML where its parser is installed; None if it is neither."""
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError:
        return None
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError:
        return None


def configs(spark: SparkSession, data: Any) -> DataFrame:
    """The sources of a parsed file as rows; an absent flag is off, absent lists are empty. A list has few rows, whatever the corpus."""
    told = lambda e, n: [str(x).strip() for x in e.get(n) or () if str(x).strip()]
    rows = []
    for state, e in _entries(data):
        courts = [tuple(str(c.get(n, "")).strip() for n in ("court", "listing_url", "base_url")) for c in e.get("courts") or () if isinstance(c, Mapping)]
        rows.append((str(e.get("state", state)), str(e.get("type", "")), str(e.get("publisher", "")), bool(e.get("enabled")), str(e.get("url", "")).strip(), told(e, "endpoints"), told(e, "queries"), [c for c in courts if c[1]]))
    return spark.createDataFrame(rows, SCHEMA)


def load_configs(spark: SparkSession, path: str) -> DataFrame:
    """The sources of the file at ``path``, which any reader of Spark can open; empty where there is none or it can't be read."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], SCHEMA)
    return configs(spark, parse(spark.read.text(path, wholetext=True).first()[0]))


def readable(rows: DataFrame, courts_only: bool = False) -> DataFrame:
    """The enabled sources that have something to read: an endpoint, a query, a court's listing or a feed's URL.

    ``courts_only`` (a refresh) leaves the media out.
    """
    has = (
        F.when(F.col("type") == "ecourts", True)
        .when(F.col("type") == "indiankanoon", F.size("queries") > 0)
        .when(F.col("type") == "hc_judgments", F.size("courts") > 0)
        .when(F.col("type") == "rss", F.col("url") != "")
        .otherwise(False)
    )
    got = rows.where(F.col("enabled") & has)
    return got.where(F.col("type").isin(*COURTS)) if courts_only else got


def requests(rows: DataFrame) -> DataFrame:
    """(state, type, publisher, url, query, base_url): one for each address that a run asks of the readable sources."""
    of = lambda kind: rows.where(F.col("type") == kind)
    none = F.lit(None).cast("string")
    told = lambda df, url, query=none, base=none, publisher=None: df.select("state", "type", (publisher if publisher is not None else F.col("publisher")).alias("publisher"), url.alias("url"), query.alias("query"), base.alias("base_url"))
    listing = of("hc_judgments").withColumn("c", F.explode("courts"))
    parts = [
        told(of("rss"), F.col("url")),
        told(of("ecourts").withColumn("e", F.explode("endpoints")), F.col("e")),
        told(of("indiankanoon").withColumn("q", F.explode("queries")), F.col("url"), F.col("q")),
        told(listing, F.col("c.listing_url"), base=F.col("c.base_url"), publisher=F.col("c.court")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_submissions(spark: SparkSession, path: str) -> DataFrame:
    """(url, state, district, incident_date, issue_number) of the JSON file of readers' leads; empty where there is none.

    A lead without an http(s) URL is left out.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    schema = "url string, state string, district string, incident_date string, issue_number int"
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path).where(F.lower("url").rlike("^https?://"))
