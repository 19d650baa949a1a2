"""Sources: the list of them, polite fetching with a transport made for the test, and each kind's documents."""

import subprocess
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from casewright.sources import fetch, readers, registry

FILE = """{"national": [{"type": "rss", "publisher": "N", "url": "https://n.example/feed", "enabled": true}, {"type": "rss", "url": "", "enabled": true}, 7],
 "states": {"ka": [{"type": "hc_judgments", "enabled": true, "courts": [{"court": "High Court of K", "listing_url": "https://k.example/list", "base_url": "https://k.example/"}, {"court": "none"}]}], "DL": [], "MH": [{"type": "indiankanoon", "publisher": "S", "queries": ["q1", " "], "enabled": true}, {"type": "ecourts", "endpoints": ["https://e.example/api"], "enabled": true}, {"type": "rss", "url": "https://off.example/", "enabled": false}]}}"""
FEED = "<rss><channel><item><title>Man held</title><link>https://n.example/1</link><description>for &lt;b&gt;rape&lt;/b&gt;</description></item></channel></rss>"
PAGES = {
    "https://n.example/robots.txt": (404, b""),
    "https://n.example/feed": (200, FEED.encode()),
    "https://n.example/1": (200, b"<html><p>The whole story</p></html>"),
    "https://k.example/robots.txt": (200, b"User-agent: *\nDisallow: /secret"),
    "https://k.example/list": (200, b'<a href="/a.pdf">a</a><a href="b.pdf">b</a><a href="/secret/c.pdf">c</a>'),
    "https://k.example/a.pdf": (200, b"charged u/s 376"),
    "https://k.example/b.pdf": (200, b"a civil suit"),
    "https://e.example/api": (200, b'{"cases": [{"url": "https://e.example/c1", "cnr": "K1"}]}'),
}


def get(rows):
    pages = PAGES

    class Canned:  # made here, so that it travels to the workers with its pages
        def get(self, url, headers):
            if url not in pages:
                raise OSError("no route")
            return fetch.Answer(*pages[url], {"ETag": "e1"})

    return fetch.fetched(rows, Canned, "tester", pace=0.0, retries=1, sleep=lambda _: None)


def test_registry(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text(FILE)
    rows = registry.load_configs(spark, str(path))
    assert rows.count() == 6 and registry.load_configs(spark, str(tmp_path / "none")).count() == 0
    assert sorted((r["state"], r["type"]) for r in registry.readable(rows).collect()) == [("KA", "hc_judgments"), ("MH", "ecourts"), ("MH", "indiankanoon"), ("national", "rss")]
    assert {r["type"] for r in registry.readable(rows, courts_only=True).collect()} == {"hc_judgments", "ecourts", "indiankanoon"}
    assert registry.configs(spark, {"sources": [{"type": "rss", "url": "u", "enabled": True}]}).first()["state"] == "national"
    asked = {(r["type"], r["url"], r["query"]) for r in registry.requests(registry.readable(rows)).collect()}
    assert ("indiankanoon", "", "q1") in asked and ("hc_judgments", "https://k.example/list", None) in asked and len(asked) == 4


def test_documents_of_every_kind(spark):
    requests = registry.requests(registry.readable(registry.configs(spark, registry.parse(FILE))))
    feed = readers.media(requests, get, "2001-01-01")
    assert [tuple(r) for r in feed.collect()] == [("https://n.example/1", "N", "2001-01-01", "Man held. for rape")]
    assert readers.media(requests, get, "2001-01-01", bodies=True).first()["text"] == "Man held. for rape The whole story"
    assert [(r["url"], r["text"]) for r in readers.court_records(requests, get, "d").collect()] == [("https://e.example/c1", "CNR: K1")]
    docs, funnel = readers.judgments(requests, get, "d", convert=lambda b: (b or b"").decode())
    assert [(r["url"], r["publisher"]) for r in docs.collect()] == [("https://k.example/a.pdf", "High Court of K")]
    assert tuple(funnel.first())[1:5] == (3, 2, 2, 1)
    hits = lambda q: q.withColumn("page", F.lit('{"docs": [{"tid": 5, "title": "a case of rape", "docsource": "High Court"}, {"tid": 6, "title": "a lease"}]}'))
    found, told = readers.searched(requests, hits, lambda t: t.withColumn("page", F.lit("<p>Judgment</p>")), "d")
    assert [r["publisher"] for r in found.collect()] == ["High Court"] and tuple(told.first()) == ("search", 2, 1, 1)
    leads = spark.createDataFrame([("https://n.example/1",), ("https://gone.example/x",), ("",)], "url string")
    sent = readers.submitted(leads, get, "d")
    assert [tuple(r) for r in sent.collect()] == [("https://n.example/1", "n.example", "d", "The whole story")]
    every = readers.all_documents(feed, sent).collect()
    assert [(r["url"], r["publisher"]) for r in every] == [("https://n.example/1", "N")]


def test_fetched(spark):
    urls = spark.createDataFrame([("https://n.example/feed",), ("https://n.example/feed",), ("https://k.example/secret/c.pdf",), ("https://gone.example/x",), ("https://n.example/none",), (None,)], "url string")
    got = {r["url"]: (r["outcome"], r["etag"]) for r in get(urls).collect()}
    assert got == {"https://n.example/feed": ("fetched", "e1"), "https://k.example/secret/c.pdf": ("refused", None), "https://gone.example/x": ("failed", None), "https://n.example/none": ("failed", None)}


def test_polite_client():
    class Busy:
        def __init__(self):
            self.asked, self.now = [], 0.0

        def get(self, url, headers):
            self.asked.append((url, self.now, headers.get("If-None-Match")))
            if url.endswith("robots.txt"):
                raise OSError
            answers = {"/busy": fetch.Answer(429, headers={"Retry-After": "7"}), "/down": fetch.Answer(503), "/same": fetch.Answer(304)}
            return answers.get(url[url.rindex("/") :], fetch.Answer(200, b"x"))

    host, waits = Busy(), []

    def sleep(s):
        waits.append(s)
        host.now += s

    client = fetch.PoliteClient(host, "a", retries=2, sleep=sleep, clock=lambda: host.now)
    assert client.get("https://h.example/ok").status == 200 and client.get("https://h.example/ok").status == 200
    assert waits == [2.0, 2.0]  # after robots.txt, then between requests
    waits.clear()
    assert client.get("https://h.example/busy").status == 429 and [w for w in waits if w == 7.0] == [7.0, 7.0]
    waits.clear()
    assert client.get("https://h.example/down").status == 503 and waits == [2.0, 1.0, 1.0, 2.0]
    assert client.get("https://h.example/same", etag="v").status == 304 and host.asked[-1][2] == "v"
    at = datetime(2001, 1, 1, tzinfo=timezone.utc)
    assert fetch.retry_after("Mon, 01 Jan 2001 00:01:00 GMT", lambda: at) == 60 and fetch.retry_after("Mon, 01 Jan 2000 00:01:00 GMT", lambda: at) is None and fetch.retry_after("soon") is None


@pytest.mark.parametrize(("run", "want"), [(lambda *a, **k: subprocess.CompletedProcess(a, 0, b"text \xff"), "text �"), (lambda *a, **k: subprocess.CompletedProcess(a, 1, b""), "")])
def test_pdftotext(run, want):
    assert fetch.pdftotext(b"%PDF", run) == want and fetch.pdftotext(None, run) == ""

    def missing(*a, **k):
        raise FileNotFoundError

    assert fetch.pdftotext(b"%PDF", missing) == ""
