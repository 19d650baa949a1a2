"""Persons in texts, minors, merging, model stages and views, on small made cases."""

from pyspark.sql import functions as F

from casewright.functions import minors, persons
from casewright.operators import models, resolve, views
from casewright.sources import feeds


def one(spark, **columns):
    return spark.range(1).select(*[F.expr(c).alias(n) for n, c in columns.items()])


def test_whose_occupation(spark):
    spans = lambda t: [t[a:b] for a, b in persons.occupation_spans(t)]
    assert spans("Nurse raped in Pune") == ["Nurse"]
    assert spans("driver held after techie molested") == ["techie"]
    assert spans("A tutor was jailed") == [] == spans("the accused, a tutor,")
    assert spans("") == []
    rows = spark.createDataFrame([(None,), ("",), ("maid",)], "t string")
    assert [r[0] for r in rows.select(persons.without_occupations(F.col("t"))).collect()] == [None, "", persons.OCCUPATION_MARK]


def test_minor_projection_twice_is_once_and_keeps_court_days(spark):
    rows = one(
        spark, minor_involved="true", sections="array('BNS 64')", category="'rape'", district="' Pune '", state="'MH'", incident_reported_date="'2020-03-04'", status="'CONVICTED'", accused_count="cast(null as int)", institutional_actions="cast(null as array<string>)",
        repeat_offence="cast(null as boolean)", weapon_or_threat="true", sentence_years="cast(null as int)", title="'x'", accused_name="'y'", sources="array(named_struct('url', 'u', 'source_type', 'court'))",
        status_history="array(named_struct('status', 'FIR_FILED', 'date', '2020-03-04', 'source', 0), named_struct('status', 'CLOSED', 'date', '2020-03-05', 'source', 7))",
    )
    once = minors.project(rows)
    got = once.first()
    assert got["title"] == "Rape involving a minor — Pune (2020)"
    assert got["summary"] == f"A case of rape involving a minor in Pune, Maharashtra (2020). The accused was convicted. {minors.WITHHELD}"
    assert [h["date"] for h in got["status_history"]] == ["2020-03-04", "2020-03"]
    assert got["accused_name"] is None and got["incident_reported_date"] == "2020-03"
    assert minors.project(once).first() == got
    other = minors.project(rows.withColumn("minor_involved", F.lit(False))).first()
    assert (other["title"], other["summary"], other["accused_name"]) == ("x", None, "y")
    blank = minors.project(rows.withColumns({c: F.lit(None).cast(t) for c, t in rows.dtypes})).first()
    assert blank["title"] == "Sexual offence involving a minor"


def test_merge_of_sources_history_and_accused(spark):
    rows = one(
        spark, sa="array(named_struct('url', 'a', 'p', 1), named_struct('url', 'b', 'p', 2))", sb="array(named_struct('url', 'b', 'p', 3), named_struct('url', 'c', 'p', 4))",
        ha="array(named_struct('status', 'X', 'date', 'd', 'source', 1))", hb="array(named_struct('status', 'X', 'date', 'd', 'source', 0), named_struct('status', 'Y', 'date', 'e', 'source', 1), named_struct('status', 'Z', 'date', 'f', 'source', 9))",
        aa="array(named_struct('label', 'A1', 'name', '', 'status', 'CHARGESHEETED'))", ab="array(named_struct('label', 'A1', 'name', 'N', 'status', 'FIR_FILED'), named_struct('label', 'A2', 'name', cast(null as string), 'status', 'CLOSED'))",
    )
    c = F.col
    got = rows.select(resolve.merged_sources(c("sa"), c("sb")).alias("s"), resolve.merged_history(c("ha"), c("hb"), c("sa"), c("sb")).alias("h"), resolve.merged_accused(c("aa"), c("ab")).alias("a")).first()
    assert [tuple(s) for s in got["s"]] == [("a", 1), ("b", 2), ("c", 4)]
    assert [tuple(h) for h in got["h"]] == [("X", "d", 1), ("Y", "e", 2)]
    assert [tuple(a) for a in got["a"]] == [("A1", "N", "CHARGESHEETED"), ("A2", None, "CLOSED")]


def client_type():
    """A class of its own, which workers get by value since they don't have this module."""

    class Client:
        def __init__(self, bad):
            self.bad = bad

        def generate(self, prompt):
            if self.bad:
                raise TimeoutError("busy")
            return prompt.upper(), len(prompt)

    return Client


def test_clients_in_order_and_a_broken_one_is_left(spark):
    Client = client_type()
    docs = spark.createDataFrame([(f"u{k}", f"t{k}") for k in range(20)], "url string, t string").coalesce(1)
    ask = lambda make: models.answers(docs, make, F.col("t"), retries=1, sleep=lambda s: None).collect()
    got = ask(lambda: [Client(True), Client(False)])
    assert {r["outcome"] for r in got} == {"answered"} and got[3]["answer"] == "T3"
    lost = ask(lambda: [Client(True)])
    assert [r["error"] for r in lost[4:6]] == ["TimeoutError: busy", "no client left"] and {r["outcome"] for r in lost} == {"failed"}
    waits = []
    try:
        models.ask(Client(True), "x", retries=3, longest=3.0, sleep=waits.append)
    except TimeoutError:
        assert waits == [1.0, 2.0, 3.0]


def test_first_object_and_verdict(spark):
    assert models.first_object('x {"a": "}", "b": {"c": 1}} {"d": 2}') == '{"a": "}", "b": {"c": 1}}'
    assert models.first_object('{"a": ') is None is models.first_object(None)
    texts = [None, "", "[1]", '{"verified": 1}', '```json\n{"verified": true, "second_source": {"url": "javascript:x"}}\n```', '{"verified": true, "second_source": {"url": " HTTP://e.example "}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(models.verdict(F.col("t")).alias("v")).collect()
    assert [r["v"]["parsed"] for r in rows] == [False, False, False, True, True, True]
    assert [r["v"]["verified"] for r in rows] == [False, False, False, False, True, True]
    assert [r["v"]["second_url"] for r in rows] == [None, None, None, None, None, "HTTP://e.example"]


def test_running_sum_crosses_bands(spark):
    got = models.running_sum(spark.range(100).where("id % 3 <> 0"), "id", F.col("id"), "s", band=7).orderBy("id").collect()
    total = 0
    for r in got:
        assert r["s"] == total
        total += r["id"]


def test_feeds_that_are_broken(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<rss><chan"), (4, "text"), (5, "<rss><channel><item><title>a</title><link>l</link></item></channel></rss>")], "k int, payload string")
    assert [(r["k"], r["url"], r["text"]) for r in feeds.feed_entries(rows, "payload").collect()] == [(5, "l", "a")]
    assert one(spark, h="cast(null as string)").select(feeds.pdf_urls(F.col("h"), F.lit("https://e.example"))).first()[0] == []


def test_views(spark):
    dates = ["2001-08-02", "2001-08-01", "2001-07-30", "2001-07-26", "2001-07-01", "2001-03-01", "1999-01-01", "2001-09-01", "2001-08", "x", None]
    rows = spark.createDataFrame([(k, d) for k, d in enumerate(dates)], "k int, d string").orderBy("k")
    assert [r[0] for r in rows.select(views.recency(F.col("d"), "2001-08-02")).collect()] == ["today", "yesterday", "3 days ago", "last week", "5 weeks ago", "5 months ago", "3 years ago", "", "", "", ""]
    assert [r[0] for r in rows.select(views.display_date(F.col("d"))).collect()][-4:] == ["Sep 1, 2001", "Aug 2001", "x", "—"]
    got = one(spark, h="array(named_struct('status', 'B', 'date', '2'), named_struct('status', 'A', 'date', '1'))", e="cast(null as array<struct<status: string, date: string>>)").select(views.timeline(F.col("h"), F.lit("S"), F.lit("3")).alias("h"), views.timeline(F.col("e"), F.lit("S"), F.lit("3")).alias("e")).first()
    assert [tuple(x) for x in got["h"]] == [("A", "1"), ("B", "2")] and [tuple(x) for x in got["e"]] == [("S", "3")]
    assert one(spark, s=f"'It is so. {minors.WITHHELD}'").select(views.body_and_footnote(F.col("s"), minors.WITHHELD).alias("x")).first()["x"]["body"] == "It is so."
