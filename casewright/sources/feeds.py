"""Feeds and listings: RSS and Atom entries, and the PDF links of a page, as rows."""

from __future__ import annotations

from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

_ITEM = "array<struct<title: string, link: string, description: string>>"
_ENTRY = "array<struct<title: string, link: array<struct<_href: string>>, summary: string, content: string>>"
FEED = f"channel struct<item: {_ITEM}>, item {_ITEM}, entry {_ENTRY}"


def _tidy(text: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"\s+", " ")), F.lit(""))


def feed_entries(rows: DataFrame, payload: str) -> DataFrame:
    """``rows`` without ``payload`` but with (url, text) for each entry of an RSS or Atom feed.

    Entries without a link, or with neither title nor summary, are left out; what is null or no XML gives no rows.
    """
    xml = F.from_xml(F.col(payload), FEED, {"mode": "PERMISSIVE", "ignoreNamespace": "true"})
    none = F.array().cast("array<struct<t: string, u: string, s: string>>")
    of_item = lambda e: F.struct(_tidy(e["title"]).alias("t"), F.coalesce(F.trim(e["link"]), F.lit("")).alias("u"), _tidy(e["description"]).alias("s"))
    summary = lambda e: F.coalesce(F.nullif(_tidy(e["summary"]), F.lit("")), _tidy(e["content"]))
    of_entry = lambda e: F.struct(_tidy(e["title"]).alias("t"), F.coalesce(F.get(e["link"], F.lit(0))["_href"], F.lit("")).alias("u"), summary(e).alias("s"))
    x = F.col("_xml")
    every = F.concat(*(F.coalesce(F.transform(part, f), none) for part, f in ((x["channel"]["item"], of_item), (x["item"], of_item), (x["entry"], of_entry))))
    one = rows.withColumn("_xml", xml).withColumn("_e", F.explode(every)).drop(payload, "_xml").where("_e.u <> '' and (_e.t <> '' or _e.s <> '')")
    text = F.regexp_replace(F.concat(F.col("_e.t"), F.lit(". "), F.col("_e.s")), r"^[. ]+|[. ]+$", "")
    return one.withColumns({"url": F.col("_e.u"), "text": text}).drop("_e")


@F.pandas_udf(ArrayType(StringType()))
def _joined(links: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([[urljoin(b or "", unescape(u)) for u in us] if us is not None else [] for us, b in zip(links, base, strict=True)])


def pdf_urls(html: Column, base: Column) -> Column:
    """The page's links to PDF files, absolute, each once, in page order; of a link to several the first counts."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)href\s*=\s*["']([^"']+)["']"""), 1)
    first = F.transform(links, lambda u: F.regexp_extract(F.trim(u), r"(?i)^(.*?\.pdf(?:\?[^,\s]*)?)", 1))
    return F.array_distinct(_joined(F.filter(first, lambda u: u != ""), base))


def capped(rows: DataFrame, group: str, order: list[str], each: int, all_: int) -> DataFrame:
    """The first ``each`` rows of each group, and of those the first ``all_``: the bounds of polite fetching."""
    got = rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= each).drop("_n")
    return got.orderBy(group, *order).limit(all_)


def fetch_funnel(rows: DataFrame, group: str, fetched: Column, text: Column, relevant: Column, alarm: int = 10) -> DataFrame:
    """(group, listed, fetched, with_text, qualifying, broken): a group is broken if over ``alarm`` files came and all were empty."""
    own = F.coalesce(fetched, F.lit(False))
    full = own & (F.coalesce(text, F.lit("")) != "")
    got = rows.groupBy(group).agg(F.count("*").alias("listed"), F.count_if(own).alias("fetched"), F.count_if(full).alias("with_text"), F.count_if(full & F.coalesce(relevant, F.lit(False))).alias("qualifying"))
    return got.withColumn("broken", (F.col("fetched") > alarm) & (F.col("with_text") == 0))
