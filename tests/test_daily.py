"""The daily plan, guards, transitions and answers, on made cases and the smallest tables."""

import json

import pytest
from pyspark.sql import functions as F

from casewright import catalog
from casewright.operators import guards, identity
from casewright.plans import daily
from casewright.sources import payloads
from casewright.sources.adapters import RUN_DATE

SF = "/root/testdata/sf0.001"


def test_settings():
    of = lambda **s: daily.RunConfig.of(s, RUN_DATE)
    assert of(LAUNCH_STATES=" all ").states is None
    assert of(LAUNCH_STATES="ka, TN,").states == {"KA", "TN"} and of(LAUNCH_STATES="KA", LAUNCH_LOOKBACK_DAYS="x").lookback is None
    assert of(LAUNCH_STATES="KA", LAUNCH_LOOKBACK_DAYS=" 30 ", PUBLISH_APPROVED_ONLY="Yes").approved_only
    for bad in ({}, {"LAUNCH_STATES": ","}):
        with pytest.raises(ValueError, match="LAUNCH_STATES"):
            of(**bad)


def test_daily_loses_no_case_and_refresh_adds_none(spark):
    rows = catalog.cases(spark, SF)
    config = daily.RunConfig(RUN_DATE, None)
    none = spark.createDataFrame([], "cnr string, id string, year string, state string, serial int")
    out = daily.daily(rows, none, config)
    parts = [out[k].count() for k in ("published", "held", "review", "quarantined")]
    assert sum(parts) == rows.count() and parts[0] > 0
    assert out["published"].where("id is null or minor_involved").count() == 0
    assert out["report"].where("route = 'published'").first()["n"] == parts[0]
    assert any(line.startswith("* held: ") for line in daily.report_lines(out["report"]))
    assert daily.daily(rows, none, daily.RunConfig(RUN_DATE, None, refresh=True))["published"].count() == 0
    assert daily.routed(rows, daily.RunConfig(RUN_DATE, None, approved_only=True)).where("route = 'published'").count() == 0
    assert {k: v.count() for k, v in daily.summary(out["published"], config).items()}["coverage"] == 36
    blank = rows.limit(2).withColumns({c: F.lit(None).cast(t) for c, t in rows.dtypes})
    assert [r["route"] for r in daily.routed(blank, config).collect()] == ["quarantined"] * 2
    once = daily.tidied(rows)
    assert once.exceptAll(daily.tidied(once)).count() == 0


def test_findings():
    seen = lambda v, **how: sorted(guards.findings(v, **how))
    assert seen({"a": [{"Father_Name": 1}, "x@y.example"], "primary_victim": None}) == [("a[0].Father_Name", "name"), ("a[1]", "email"), ("primary_victim", "name")]
    prose = {"title": "Nurse raped", "summary": "aged 12", "other": "nurse aged 12"}
    assert seen(prose) == [("summary", "aged_number"), ("title", "occupation")] and seen(prose, published=False) == []
    assert seen("पी") == [("<root>", "native_script")]
    deep = json.loads("[" * 900 + '"a@b.example"' + "]" * 900)
    assert len(seen(deep)) == 1
    assert guards.may_override("status") and not any(map(guards.may_override, ("ID", "minor_involved", "Victim_x", "school")))


def test_guards(spark):
    diff = spark.createDataFrame([("+++ b/a@b.example",), ("+to a@b.example",), ("-to a@b.example",), ("+fine",), (None,)], "line string")
    assert [tuple(r) for r in guards.scan_diff(diff, "line").collect()] == [("+to a@b.example", ["email"])]
    assert guards.scan_json(spark.createDataFrame([(1, None), (2, "[]")], "k int, p string"), "p").count() == 0
    fields = spark.createDataFrame([("status",), ("ID",), ("my_survivor",), ("guardian",)], "f string")
    assert [r[0] for r in guards.allowed_overrides(fields, "f").collect()] == ["status"]
    n = lambda *v: spark.createDataFrame([(x,) for x in v], "n long")
    assert [tuple(r) for r in guards.disagreements(n(3, 4), good=n(7), bad=n(6), none=n()).orderBy("part").collect()] == [("bad", 7, 6), ("none", 7, 0)]
    counts = spark.createDataFrame([(51, 0)], "p int, e int")
    with pytest.raises(Exception, match="nothing was extracted"):
        guards.silent(counts, "p", "e").collect()
    assert guards.silent(counts.withColumn("p", F.lit(50)), "p", "e").count() == 1
    assert spark.range(1).select(guards.too_large(spark.range(1), 5).alias("x")).first()["x"]


def test_transitions_marks_and_fates(spark):
    kind = "id string, status string, minor_involved boolean, status_history array<struct<status: string, date: string, source: int>>"
    now = spark.createDataFrame([("a", "CLOSED", True, []), ("b", "CLOSED", False, [("CLOSED", "2001", 0)]), ("c", "CLOSED", False, None), ("d", "X", False, None)], kind)
    prior = spark.createDataFrame([("a", "X", None, "2000-05-06"), ("b", "X", None, None), ("c", "CLOSED", None, None)], "id string, status string, last_status_change string, first_published string")
    got = {r["id"]: r["status_history"] for r in identity.with_transition(now, prior, RUN_DATE).collect()}
    assert [tuple(x) for x in got["a"]] == [("X", "2000-05", 0), ("CLOSED", "2001-08", 0)] and len(got["b"]) == 1 and got["c"] is None and got["d"] is None
    slot = "year string, state string, serial int"
    marks = identity.high_water(spark.createDataFrame([("2001", "KA", 9)], slot), spark.createDataFrame([("2001", "KA", 3), ("2001", "TN", 1)], slot))
    assert {tuple(r) for r in marks.collect()} == {("2001", "KA", 9), ("2001", "TN", 1)}
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    docs = urls("1", "2", "3", "4", "5").withColumn("outcome", F.lit("failed"))
    assert sorted(tuple(r) for r in identity.fates(docs, urls("1", "1"), urls("1", "2"), urls("3"), urls("3", "4")).collect()) == [("1", "held"), ("2", "published"), ("3", "staged_pending"), ("4", "pending"), ("5", "failed")]


def test_payloads(spark):
    rows = spark.createDataFrame([(None,), ("x",), ("[]",), ('{"archived_snapshots": {}}',), ('{"archived_snapshots": {"closest": {"available": true, "url": ""}}}',)], "p string")
    assert {r[0] for r in rows.select(payloads.snapshot_url(F.col("p"))).collect()} == {None}
    sources = spark.createDataFrame([("https://e.example/order-1",), ("https://e.example/school-girl",), (None,)], "url string")
    known = spark.createDataFrame([("https://e.example/order-1", "A"), ("https://e.example/school-girl", "B")], "url string, archive_url string")
    assert {r["archive_url"] for r in payloads.archived(sources, known).collect()} == {"A", None}
    entries = spark.createDataFrame([("u", "T"), ("v", "T")], "url string, text string")
    assert sorted(r["text"] for r in payloads.with_body(entries, spark.createDataFrame([("u", " body ")], "url string, body string"), most=6).collect()) == ["T", "T body"[:6]]
    assert entries.where("url = 'u'").select(payloads.prompt(["url"], F.col("text"))).first()[0] == 'Record: {"url":"u"}\nSource: T'
