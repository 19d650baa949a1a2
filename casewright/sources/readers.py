"""Each kind of source from its fetched pages to documents (url, publisher, fetched_at, text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from casewright.functions import relevance, text
from casewright.sources import feeds, fetch, parsers, payloads

#: How many files of a court, of all courts, and judgments of a search are fetched in a run.
EACH_COURT, ALL_COURTS, SEARCH = 40, 60, 100
DOCUMENT = ["url", "publisher", "fetched_at", "text"]
Fetch = Callable[[DataFrame], DataFrame]


def _pages(requests: DataFrame, kind: str, get: Fetch) -> DataFrame:
    """The requests of one kind with the body of their page, as text; those without one are left out."""
    own = requests.where(F.col("type") == kind)
    got = get(own.select("url").distinct()).where("outcome = 'fetched'").select("url", fetch.body_text(F.col("body")).alias("page"))
    return own.join(got, "url").drop("type", "state")


def media(requests: DataFrame, get: Fetch, fetched_at: str, bodies: bool = False) -> DataFrame:
    """The entries of feeds; with ``bodies`` the article's own text follows the feed's where it can be had."""
    pages = _pages(requests, "rss", get).select("publisher", "page")
    docs = feeds.feed_entries(pages, "page").select("url", "publisher", F.lit(fetched_at).alias("fetched_at"), "text")
    if not bodies:
        return docs
    got = get(docs.select("url").distinct()).where("outcome = 'fetched'").select("url", text.strip_html(fetch.body_text(F.col("body"))).alias("body"))
    return payloads.with_body(docs, got).select(DOCUMENT)


def court_records(requests: DataFrame, get: Fetch, fetched_at: str) -> DataFrame:
    """The cases of the courts' own interfaces."""
    pages = _pages(requests, "ecourts", get).select("publisher", "page")
    return parsers.court_cases(pages, "page").select("url", "publisher", F.lit(fetched_at).alias("fetched_at"), "text")


def judgments(requests: DataFrame, get: Fetch, fetched_at: str, convert: Callable[[bytes | None], str] = fetch.pdftotext, each: int = EACH_COURT, all_: int = ALL_COURTS) -> tuple[DataFrame, DataFrame]:
    """(documents, funnel) of the courts' listings: their PDF links, the first ``each`` of a court and ``all_`` in all, whose
    text names a statute. The funnel (publisher, listed, fetched, with_text, qualifying, broken) counts what went where."""
    pages = _pages(requests, "hc_judgments", get)
    links = pages.select("publisher", F.posexplode(feeds.pdf_urls(F.col("page"), F.coalesce(F.nullif("base_url", F.lit("")), F.col("url")))).alias("place", "pdf"))
    taken = feeds.capped(links, "publisher", ["place"], each, all_)
    files = fetch.pdf_text(get(taken.select(F.col("pdf").alias("url")).distinct()).where("outcome = 'fetched'").select(F.col("url").alias("pdf"), "body"), convert=convert)
    told = links.join(taken.withColumn("_taken", F.lit(True)).select("publisher", "pdf", "_taken"), ["publisher", "pdf"], "left").join(files.withColumn("_got", F.lit(True)), "pdf", "left")
    good = text.statute_hit(F.col("text"))
    funnel = feeds.fetch_funnel(told, "publisher", F.col("_taken") & F.col("_got"), F.col("text"), good)
    docs = told.where(F.coalesce(F.col("_taken") & good, F.lit(False))).select(F.col("pdf").alias("url"), "publisher", F.lit(fetched_at).alias("fetched_at"), "text")
    return docs, funnel


def searched(requests: DataFrame, search: Fetch, read: Fetch, fetched_at: str, most: int = SEARCH) -> tuple[DataFrame, DataFrame]:
    """(documents, funnel) of a search service: hits that name a statute or an offence, the first ``most`` of them read.

    ``search`` takes (query) and gives (query, page); ``read`` takes (tid) and gives (tid, page). The funnel is one row
    (source, hits, qualifying, fetched).
    """
    own = requests.where(F.col("type") == "indiankanoon").select("publisher", "query").distinct()
    hits = parsers.search_hits(search(own.select("query")).join(own, "query"), "page").withColumn("_ok", relevance.hit_qualifies(F.col("title"), F.col("headline")))
    first = hits.where("_ok").dropDuplicates(["tid"]).orderBy("query", "tid").limit(most)
    pages = read(first.select("tid"))
    docs = first.join(pages, "tid").withColumn("text", parsers.judgment_text(F.col("page"), F.col("docsource"), F.col("title"), F.col("publishdate"))).where("text <> ''")
    told = hits.agg(F.count("*").alias("hits"), F.count_if("_ok").alias("qualifying")).withColumn("_k", F.lit(0)).join(docs.agg(F.count("*").alias("fetched")).withColumn("_k", F.lit(0)), "_k").select(F.lit("search").alias("source"), "hits", "qualifying", "fetched")
    return docs.select(F.concat(F.lit("https://search.example/doc/"), "tid", F.lit("/")).alias("url"), F.coalesce(F.nullif(F.trim("docsource"), F.lit("")), "publisher").alias("publisher"), F.lit(fetched_at).alias("fetched_at"), "text"), told


def submitted(leads: DataFrame, get: Fetch, fetched_at: str) -> DataFrame:
    """The pages that readers have named (``leads``: url), as documents; a page that can't be had gives none."""
    got = get(leads.select("url").where("url <> ''").distinct()).where("outcome = 'fetched'")
    host = F.coalesce(F.try_parse_url(F.col("url"), F.lit("HOST")), F.lit(""))
    return got.select("url", F.regexp_replace(host, "^www[.]", "").alias("publisher"), F.lit(fetched_at).alias("fetched_at"), text.strip_html(fetch.body_text(F.col("body"))).alias("text")).where("text <> ''")


def all_documents(*parts: DataFrame) -> DataFrame:
    """The documents of all sources, each URL once: the first source that has it gives it."""
    every = None
    for k, part in enumerate(parts):
        one = part.select(*DOCUMENT, F.lit(k).alias("_k"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("url").agg(F.min(F.struct("_k", "publisher", "fetched_at", "text")).alias("d")).select("url", "d.publisher", "d.fetched_at", "d.text")
