"""Polite fetching: one task for a host, with its robots rules, its pace, waits that double, and validators."""

from __future__ import annotations

import subprocess
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from typing import Protocol
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

#: Seconds between requests to a host; tries after the first; the first wait and the longest one.
PACE, RETRIES, BASE, LONGEST = 2.0, 5, 1.0, 60.0
#: Fixed value: seconds that the text of one file may take.
PDF_SECONDS = 20
FETCHED = "url string, outcome string, status int, body binary, etag string, last_modified string"


@dataclass
class Answer:
    """What a transport gives for a request."""

    status: int
    body: bytes = b""
    headers: Mapping[str, str] = field(default_factory=dict)


class Transport(Protocol):
    """Sends one request; a failure of the connection is an OSError."""

    def get(self, url: str, headers: Mapping[str, str]) -> Answer: ...


def retry_after(value: str, now: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> float | None:
    """Seconds that a Retry-After header asks for, in either of its forms; None for what is neither or already past."""
    value = value.strip()
    if value.isdigit():
        return float(value)
    try:
        when = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    when = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
    seconds = (when - now()).total_seconds()
    return seconds if seconds > 0 else None


class PoliteClient:
    """Asks as robots.txt allows and no faster than the pace; 429, 5xx and broken connections are tried again."""

    def __init__(self, transport: Transport, agent: str, pace: float = PACE, retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.agent, self.pace, self.retries, self.sleep, self.clock = transport, agent, pace, retries, sleep, clock
        self._last: dict[str, float] = {}
        self._rules: dict[str, RobotFileParser | None] = {}

    def _allowed(self, url: str) -> bool:
        parts = urlsplit(url)
        if parts.netloc not in self._rules:
            rules = None
            try:
                got = self.transport.get(f"{parts.scheme}://{parts.netloc}/robots.txt", {"User-Agent": self.agent})
                if got.status == 200:
                    rules = RobotFileParser()
                    rules.parse(got.body.decode("utf-8", "replace").splitlines())
            except OSError:
                pass
            self._last[parts.netloc], self._rules[parts.netloc] = self.clock(), rules
        rules = self._rules[parts.netloc]
        return rules is None or rules.can_fetch(self.agent, url)

    def get(self, url: str, etag: str | None = None, modified: str | None = None) -> Answer | None:
        """The answer, or None where robots.txt forbids to ask. The last failure is raised, or its answer given."""
        if not self._allowed(url):
            return None
        host = urlsplit(url).netloc
        headers = {"User-Agent": self.agent} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": modified} if modified else {})
        for n in range(self.retries + 1):
            if host in self._last and (wait := self.pace - (self.clock() - self._last[host])) > 0:
                self.sleep(wait)
            self._last[host] = self.clock()
            asked = None
            try:
                got = self.transport.get(url, headers)
                if got.status != 429 and not 500 <= got.status < 600:
                    return got
                asked = retry_after(got.headers.get("Retry-After", ""))
            except OSError:
                if n == self.retries:
                    raise
                got = None
            if n < self.retries:
                self.sleep(min(BASE * 2.0**n if asked is None else asked, LONGEST))
        return got


def fetched(rows: DataFrame, make_transport: Callable[[], Transport], agent: str, url: str = "url", **how) -> DataFrame:
    """(url, outcome, status, body, etag, last_modified) for each different URL of ``rows``.

    ``rows`` may have etag and last_modified of an earlier answer. outcome is fetched, unchanged (304), refused (robots),
    http_error or failed; one URL's failure is a row and never stops the others. All of a host's URLs are asked in one
    task, so that its pace holds over the whole cluster; bodies stay in memory and go only where the caller sends them.
    """
    old = [F.max(n).alias(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in ("etag", "last_modified")]
    asked = rows.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(*(old if "etag" in rows.columns and "last_modified" in rows.columns else [F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified")]))
    host = F.coalesce(F.try_parse_url(F.col("url"), F.lit("HOST")), F.lit(""))
    dealt = asked.withColumn("_host", host).repartition("_host").sortWithinPartitions("_host", "url")

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = PoliteClient(make_transport(), agent, **how)
        for batch in batches:
            out = [_one(client, *row) for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["url", "outcome", "status", "body", "etag", "last_modified"])

    return dealt.select("url", "etag", "last_modified").mapInArrow(each, FETCHED)


def _one(client: PoliteClient, url: str, etag: str | None, modified: str | None) -> tuple:
    try:
        got = client.get(url, etag, modified)
    except OSError:
        return url, "failed", None, None, None, None
    if got is None:
        return url, "refused", None, None, None, None
    if got.status == 304:
        return url, "unchanged", 304, None, etag, modified
    if got.status != 200:
        return url, "http_error", got.status, None, None, None
    return url, "fetched", 200, got.body, got.headers.get("ETag"), got.headers.get("Last-Modified")


def body_text(body: Column) -> Column:
    """A fetched body as text; bytes that are no UTF-8 become marks."""
    return F.make_valid_utf8(body.cast("string"))


def pdftotext(blob: bytes | None, run: Callable[..., subprocess.CompletedProcess] = subprocess.run) -> str:
    """The text of a PDF, piped through the tool so that it never touches a disk; empty if that can't be had."""
    if not blob:
        return ""
    try:
        got = run(["pdftotext", "-", "-"], input=blob, capture_output=True, timeout=PDF_SECONDS)
    except (OSError, subprocess.SubprocessError):
        return ""
    out = got.stdout or b""
    return "" if got.returncode != 0 and not out else out.decode("utf-8", "replace")


def pdf_text(rows: DataFrame, body: str = "body", text: str = "text", convert: Callable[[bytes | None], str] = pdftotext) -> DataFrame:
    """``rows`` with the column ``text`` of the PDF in ``body``, which is dropped."""
    names = [c for c in rows.columns if c != body]
    schema = rows.select(*names).schema.add(text, StringType())

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [convert(x) for x in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*names, text])

    return rows.select(*names, body).mapInArrow(each, schema)
