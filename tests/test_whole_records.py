"""Whole records: merging, resolution, ids and runs against plain passes; sanitising, validation, state and sinks."""

import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casewright.operators import models
from casewright.operators import resolve as flat_resolve
from casewright.plans import whole as plan
from casewright.plans.daily import RunConfig
from casewright.plans.settings import Settings, estimate_usd, illustrative_usd, scope_label, token_cap
from casewright.record_catalog import whole
from casewright.records import gates, health, ids, resolve, sanitize, schema, sinks, state, validate, views
from casewright.records.schema import NAMES, RECORD

SF = "/root/testdata/sf0.001"
DAY = "2001-08-02"


def record(**fields):
    return {n: None for n in NAMES} | fields


def source(url="https://a.example/1", publisher="Daily", kind="news_article", retrieved="2001-01-01"):
    return {"url": url, "publisher": publisher, "retrieved": retrieved, "source_type": kind, "url_carries_identifying_slug": None, "archive_url": None}


def frame(spark, rows):
    return spark.createDataFrame([(k, *[r[n] for n in NAMES]) for k, r in enumerate(rows)], StructType([StructField("ord", LongType()), *RECORD]))


def good(**more):
    return record(**{**dict(state="KA", district="D1", category="rape", status="UNDER_TRIAL", minor_involved=False, confidence=0.9, incident_reported_date="2001-03-04", offence_sections=["BNS 64"], title="A case", summary="A case is heard in court. It goes on in the same way as before.", sources=[source()]), **more})


def test_merge_takes_the_whole_of_both():
    a = good(verified=True, verification_note="seen", status_history=[{"status": "FIR_FILED", "date": "2001-01-01", "source": 0}, {"status": "FIR_FILED", "date": "2001-01-01", "source": 7}], accused=[{"label": "A1", "name_public_court_record": None, "status": "UNDER_TRIAL"}])
    b = good(id="CW-2001-KA-000007", cnr="c1", confidence=0.5, accused=[{"label": "A1", "name_public_court_record": "N", "status": "CONVICTED"}, {"label": "A2", "name_public_court_record": None, "status": "FIR_FILED"}], status_history=[{"status": "UNDER_TRIAL", "date": "2001-02-01", "source": 1}])
    b["sources"] = [source(), source("https://court.example/2", "District Court Registry", "court")]
    b["offence_sections"], b["status"], b["minor_involved"] = ["BNS 64", "BNS 70"], "CONVICTED", True
    m = resolve.merge_records(a, b)  # the court's record leads
    assert [s["url"] for s in m["sources"]] == ["https://a.example/1", "https://court.example/2"] and m["id"] == "CW-2001-KA-000007" and m["status"] == "CONVICTED"
    assert m["confidence"] == 0.9 and m["minor_involved"] and m["verified"] and m["verification_note"] == "seen" and m["offence_sections"] == ["BNS 64", "BNS 70"]
    assert [(e["date"], e["source"]) for e in m["status_history"]] == [("2001-02-01", 1), ("2001-01-01", 0)]  # a point without a source is no one's
    assert [(x["label"], x["name_public_court_record"], x["status"]) for x in m["accused"]] == [("A1", "N", "CONVICTED"), ("A2", None, "FIR_FILED")]
    news, press = good(), good()
    news["sources"], press["sources"] = [source(publisher="Courtney News")], [source("https://b.example/2")]
    press["confidence"] = 0.95
    assert resolve.merge_records(news, press)["sources"][0]["url"] == "https://b.example/2"  # Courtney is no court


def random_records(seed, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        day = date(2001, 1, 1) + timedelta(rng.randrange(12))
        shown = rng.choice([day.isoformat()] * 4 + [day.isoformat()[:7], "2001", None])
        out.append(record(
            state="KA", district=rng.choice(["A", " a", "B", "C", "", None]), category="rape", status=rng.choice(["FIR_FILED", "UNDER_TRIAL", "CONVICTED"]), minor_involved=False, confidence=rng.choice([0.81, 0.9, 0.99]), incident_reported_date=shown,
            offence_sections=rng.choice([None, [], ["BNS 64"], ["BNS 65"], ["BNS 64", "POCSO 6"]]), court=rng.choice([None, None, {"name": "Court of Alpha", "next_hearing": None}, {"name": "Court of Alpho", "next_hearing": None}, {"name": "Bench 9", "next_hearing": None}]),
            cnr=rng.choice([None, None, None, f"k{rng.randrange(9)}", f" K{rng.randrange(9)} "]), fir_ref=rng.choice([None, None, {"station": f" PS {rng.randrange(3)}", "number": f"{rng.randrange(4)}/2001"}]), title="t", summary="s", sources=[source(f"https://a.example/{rng.randrange(n)}", rng.choice(["Daily", "High Court"]))],
        ))
    return out


def keys_of(r):
    out = [f"cnr:{r['cnr'].strip().upper()}"] if r["cnr"] else []
    fir = r["fir_ref"] or {}
    if (fir.get("station") or "").strip() and (fir.get("number") or "").strip():
        out.append(f"fir:{fir['station'].strip().lower()}|{fir['number'].strip()}|{fir['number'].strip()[-4:]}")
    return out


def plain_dedupe(rows):
    """Every record against every member of every cluster, in order."""
    clusters, doubtful = [], []
    for k, r in enumerate(rows):
        text = r["incident_reported_date"] or ""
        r = {"ord": k, "anchors": set(keys_of(r)), "district": r["district"], "day": date.fromisoformat(text) if len(text) == 10 else None, "sections": set(r["offence_sections"] or []), "court": (r["court"] or {}).get("name")}
        home, weak = None, False
        for c in clusters:
            found = {flat_resolve.strength(r, m) for m in c}
            if found & {"exact", "strong"}:
                home = c
                break
            weak = weak or "weak" in found
        if home is not None:
            home.append(r)
        elif weak:
            doubtful.append(k)
        else:
            clusters.append([r])
    return [[m["ord"] for m in c] for c in clusters], doubtful


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedupe_equals_a_plain_pass(spark, seed):
    rows = random_records(seed, 160)
    published, review = resolve.dedupe(frame(spark, rows))
    clusters, doubtful = plain_dedupe(rows)
    got = {r["ord"]: r for r in published.collect()}
    assert sorted(got) == sorted(c[0] for c in clusters) and [r["ord"] for r in review.orderBy("ord").collect()] == doubtful
    for c in clusters:
        want = rows[c[0]]
        for k in c[1:]:
            want = resolve.merge_records(want, rows[k])
        mine = got[c[0]].asDict(recursive=True)
        assert mine["members"] == len(c) and {n: mine[n] for n in NAMES} == {n: want[n] for n in NAMES}


def test_dedupe_gates(spark):
    rows = [good(), good(), good(), good(), good(), good()]
    rows[1]["summary"], rows[2]["title"], rows[3]["offence_sections"], rows[4]["confidence"], rows[5]["minor_involved"] = "The woman aged 24 said so.", "The husband of the accused", ["NI ACT 138"], None, True
    rows[5]["title"] = "The husband of the accused"
    _, review = resolve.dedupe(frame(spark, rows))
    assert {r["ord"]: r["reason"] for r in review.collect()} == {1: "age_detail_present", 2: "identity_detail_present", 3: "scope_review", 4: "low_confidence"}


def plain_mint(rows, prior, run_date):
    owner, top, out = {}, {}, []

    def own_keys(r):
        return sorted(keys_of(r)) or ["anon:" + "|".join([r["state"] or "", r["district"] or "", r["incident_reported_date"] or "", ",".join(sorted(r["offence_sections"] or [])), ((r["court"] or {}).get("name") or "").strip().lower()])]

    for r in [*prior, *[r for r in rows if r["id"]]]:
        for k in own_keys(r):
            owner.setdefault(k, r["id"])
        slot = (r["id"][3:7], r["id"][8:10])
        top[slot] = max(top.get(slot, 0), int(r["id"][11:]))
    for r in rows:
        if r["id"]:
            out.append(r["id"])
            continue
        found = next((owner[k] for k in own_keys(r) if k in owner), None)
        if found is None:
            slot = ((r["incident_reported_date"] or run_date)[:4], r["state"])
            top[slot] = top.get(slot, 0) + 1
            found = f"CW-{slot[0]}-{slot[1]}-{top[slot]:06d}"
            for k in own_keys(r):
                owner.setdefault(k, found)
        out.append(found)
    return out


@pytest.mark.parametrize("seed", [4, 5])
def test_ids_equal_a_plain_pass(spark, seed):
    rng = random.Random(seed)
    rows, prior = random_records(seed, 150), random_records(seed + 10, 30)
    for k, r in enumerate(prior):
        r["id"] = f"CW-2001-KA-{k * 3 + 1:06d}"
    for r in rows:
        r["state"] = rng.choice(["KA", "DL"])
        if rng.random() < 0.1:
            r["id"] = f"CW-2001-{r['state']}-{rng.randrange(100, 120):06d}"
    got = ids.minted(frame(spark, rows), frame(spark, prior), DAY)
    assert [r["id"] for r in got.orderBy("ord").collect()] == plain_mint(rows, prior, DAY)


def test_serials_are_never_given_twice(spark):
    marks = spark.createDataFrame([("2001", "KA", 40)], "year string, state string, serial int")
    held = frame(spark, [good(id="CW-2001-KA-000055")])
    rows = [good(), good(), good()]
    rows[1]["district"], rows[2]["district"] = "D2", "D1"
    got = [r["id"] for r in ids.minted(frame(spark, rows), held.limit(0), DAY, marks, held).orderBy("ord").collect()]
    assert got == ["CW-2001-KA-000056", "CW-2001-KA-000057", "CW-2001-KA-000056"]  # an anonymous case keeps its id
    again = frame(spark, [good(id="CW-2001-KA-000056")])
    assert ids.minted(frame(spark, rows[:1]), again, DAY).first()["id"] == "CW-2001-KA-000056"


def test_changes_between_runs(spark):
    old = good(id="CW-2001-KA-000001", first_published="2001-01-05", offence_sections=None) | {"offence_sections": ["Section 376 IPC", "POCSO Act"]}
    same = dict(old) | {"offence_sections": ["POCSO", "IPC 376"], "first_published": None}
    moved = dict(old) | {"status": "CONVICTED", "sources": [source(), source("https://c.example/9", "High Court", "court")]}
    new = good(id="CW-2001-KA-000002")
    got = {r["ord"]: r for r in ids.stamped(frame(spark, [same, new]), frame(spark, [old]), DAY).collect()}
    assert (got[0]["change"], got[0]["first_published"], got[0]["last_status_change"]) == ("rechecked", "2001-01-05", None)
    assert (got[1]["change"], got[1]["first_published"], got[1]["status_history"]) == ("new", DAY, None)
    r = ids.stamped(frame(spark, [moved]), frame(spark, [old]), DAY).first()
    assert (r["change"], r["last_status_change"], r["traced_to_court"], r["traced"]) == ("material", DAY, DAY, True)
    assert [(e["status"], e["date"]) for e in r["status_history"]] == [("UNDER_TRIAL", "2001-01-05"), ("CONVICTED", DAY)]


def test_collisions_keep_the_better_record(spark):
    rows = [good(id="x"), good(id="x", verified=True), good(id="x", cnr="c"), good(id="y")]
    kept, out = ids.resolve_collisions(frame(spark, rows))
    assert {r["ord"] for r in kept.collect()} == {1, 3} and {r["ord"] for r in out.collect()} == {0, 2}


def test_finalized_records_conform(spark):
    rows = whole(spark, SF).withColumn("id", F.concat(F.lit("CW-2001-KA-"), F.lpad(F.col("ord").cast("string"), 6, "0"))).withColumn("first_published", F.lit("2001-01-01"))
    done = sanitize.finalize(rows)
    broken = done.withColumn("r", validate.violations()).select(F.explode("r").alias("r")).groupBy("r").count().collect()
    assert {r["r"] for r in broken} <= {"category", "adult_date", "title", "summary"}  # what no rule of the sanitiser mends
    again = sanitize.finalize(done)
    assert done.exceptAll(again).count() == 0 and again.exceptAll(done).count() == 0
    found = validate.tree_findings(done).where("reason not like 'sentence%' and reason not like 'legalese%' and reason not like 'cites%'")
    assert found.count() == 0
    minors = done.where("minor_involved")
    assert minors.where("accused is not null or court.next_hearing is not null or length(incident_reported_date) > 7").count() == 0


def test_scrub_at_every_depth(spark):
    df = spark.createDataFrame([((("call 9876543210", "n"), ["a@b.example", None], {"victim_age": "3", "k": "ABCDE1234F"}, "x"))], "a struct<t: string, survivor_name: string>, b array<string>, c map<string, string>, Victim_Note string")
    got = sanitize.scrub(df)
    assert got.columns == ["a", "b", "c"] and got.schema["a"].dataType.names == ["t"]
    r = got.first()
    assert r["a"]["t"] == "call [redacted]" and r["b"] == ["[redacted]", None] and r["c"] == {"k": "[redacted]"}
    told = spark.createDataFrame([("email",), ("a survivor",), ("a@b.example",), ("fine",), (None,)], "s string").select(sanitize.contains_pii(F.col("s")).alias("p")).collect()
    assert [x["p"] for x in told] == [True, True, True, False, False]


def test_conform_is_an_allow_list(spark):
    df = spark.createDataFrame([("KA", (1, "PS"), [("u", "x")], "9")], "state string, fir_ref struct<other: int, station: string>, sources array<struct<url: string, odd: string>>, nonsense string")
    got = schema.conform(df)
    assert got.columns == NAMES and got.schema == RECORD
    r = got.first()
    assert r["fir_ref"].asDict() == {"station": "PS", "number": None} and r["sources"][0]["url"] == "u" and r["confidence"] is None
    j = frame(spark, [good(accused=[{"label": "A", "name_public_court_record": None, "status": "FIR_FILED"}])]).select(schema.to_json().alias("j"))
    assert '"name_public_court_record":null' in j.first()["j"] and '"cnr"' not in j.first()["j"]
    assert j.select(schema.from_json(F.col("j")).alias("r")).first()["r"]["district"] == "D1"


def test_gates_fail_closed(spark):
    rows = [record(), good(), good(), good()]
    rows[2]["category"], rows[3]["confidence"] = " POCSO", None
    got = [r["h"] for r in frame(spark, rows).orderBy("ord").select(gates.hold_reasons().alias("h")).collect()]
    assert got == [["live_blog_only", "confidence_below_auto"], [], ["pocso_minor_mismatch"], ["confidence_below_auto"]]
    assert [r["m"] for r in frame(spark, rows).orderBy("ord").select(gates.minor().alias("m")).collect()] == [True, False, True, False]


def test_recovered_dates(spark):
    year = lambda **m: good() | {"incident_reported_date": "2001", "sources": [source("https://a.example/x")]} | m
    rows = [year(sources=[source("https://a.example/2000/04/x"), source("https://a.example/2001-07/x")]), year(), year(first_published="2001-05-09", sources=[source("https://b.example/")]), year(first_published="2002-05-09", sources=[source("https://b.example/")])]
    seen = spark.createDataFrame([("https://a.example/x", "2001-06"), ("https://a.example/x", "2003-01")], "url string, month string")
    got = sanitize.recover_date(frame(spark, rows), seen).orderBy("ord").collect()
    assert [(r["incident_reported_date"], r["incident_date_provenance"]) for r in got] == [("2001-07", "source_url"), ("2001-06", "wayback"), ("2001-05", "first_published"), ("2001", None)]


def test_run_end_to_end(spark, tmp_path):
    base = whole(spark, SF).where("ord < 400")
    config = RunConfig(DAY, None)
    first = plan.run(base, config)
    published = first["published"]
    n = published.count()
    assert n > 0 and validate.duplicate_ids(published).count() == 0 and validate.split_valid(published)[1].count() == 0 and plan.orphan_free(first).count() == 0
    routed = {k: first[k].count() for k in ("published", "held", "review", "out_of_window")}
    assert sum(routed.values()) <= 400 and first["changes"].first()["new"] == n
    path = str(tmp_path / "tree")
    assert sinks.write_tables({k: first[k] for k in ("published", "marks", "feed", "held")}, path, published, first["statuses"]) == ["feed", "held", "marks", "published"]
    assert sinks.tables_written(spark, path) == ["feed", "held", "marks", "published"]
    memory = plan.Memory(existing=spark.read.parquet(path + "/published"), marks=spark.read.parquet(path + "/marks"))
    second = plan.run(base, config, memory)
    again = {r["id"]: r for r in second["published"].collect()}
    assert {r["id"] for r in published.collect()} <= set(again) and second["changes"].first()["new"] == 0
    assert all(r["first_published"] == again[r["id"]]["first_published"] for r in published.collect())
    with pytest.raises(ValueError, match="given 2 times"):
        sinks.write_tables({"published": published}, path, published.union(published))
    assert sinks.tables_written(spark, path) == ["feed", "held", "marks", "published"]


def test_state(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert state.load_ledger(spark, path).count() == 0
    spark.createDataFrame([("h", "failed", 2, DAY, DAY)], state.LEDGER).write.parquet(path)
    assert state.load_ledger(spark, path).first()["attempts"] == 2
    spend = state.record_spend(state.load_spend(spark, path + "-none"), spark.createDataFrame([("2001-08-02", 1.5), ("2001-08-30", -4.0), ("2001-09-01", 2.0)], "run_date string, usd double"))
    assert state.month_to_date(spend, DAY) == 1.5 and state.month_to_date(spend, "2001-10-01") == 0.0
    base, staged = frame(spark, [good(id="a"), good()]), frame(spark, [good(id="a", cnr="c9"), good(id="b")])
    got = {r["id"]: r for r in state.carried(base, staged=staged).collect()}
    assert set(got) == {"a", "b", None} and got["a"]["cnr"] == "c9"
    docs = spark.createDataFrame([("https://a.example/1", "extracted"), ("https://x.example/2", "extracted"), ("https://y.example/3", "failed"), ("https://w.example/4", "extracted")], "url string, outcome string")
    wait = frame(spark, [good() | {"sources": [source("https://w.example/4")]}])
    fates = state.fates(docs, frame(spark, [good()]), wait.limit(0), wait, wait.limit(0), spark.createDataFrame([], state.LEDGER))
    assert {r["url"][8]: r["outcome"] for r in fates.collect()} == {"a": "staged_pending", "x": "out_of_window", "y": "failed"}
    queue = state.review_queue(frame(spark, [good(minor_involved=None) | {"summary": "call 9876543210"}]).withColumn("reason", F.lit("why"))).first()
    assert queue["reason"] == "why" and queue["minor_involved"] and "9876543210" not in queue["summary"]


def test_approved_records_of_one_url_are_one(spark):
    rows = [good(), good(cnr="k"), good()]
    rows[0]["sources"], rows[1]["sources"], rows[2]["sources"] = [source(" https://a.example/1 ")], [source("https://a.example/1"), source("https://b.example/2")], [source("https://c.example/3")]
    got = resolve.merged_by_url(frame(spark, rows)).orderBy("ord").collect()
    assert [(r["ord"], r["members"], r["cnr"]) for r in got] == [(0, 2, "k"), (2, 1, None)]


def test_views(spark):
    rows = frame(spark, [good(id="CW-2001-KA-000001", days_since_reported=5), good(id="CW-2001-KA-000002", traced_to_court=DAY)])
    assert views.find(rows, "CW-2001-KA-000002").count() == 1 and views.find(rows, "nonsense").count() == 0
    t = rows.orderBy("ord").select(views.tracing().alias("t"), views.ticker().alias("d")).collect()
    assert (t[0]["t"]["marker"], t[1]["t"]["since"], t[0]["d"]["label"], t[1]["d"]) == ("media", DAY, "days_since_reported", None)
    cards = spark.createDataFrame([("A", 1), ("B", None), ("C", 3)], "state string, n int")
    order = lambda d: [r["state"] for r in views.scorecard_sorted(cards, "n", d, ("state",)).collect()]
    assert order(True) == ["C", "A", "B"] and order(False) == ["A", "C", "B"]
    live = spark.createDataFrame([("2001-08-01",), ("2001",)], "d string").select(views.live_counter(F.col("d"), "2001-08-02 01:30:00").alias("c"), views.stale(F.col("d"), "2001-08-04 00:00:01").alias("s")).collect()
    assert tuple(live[0]["c"]) == (1, 1, 30) and live[1]["c"] is None and live[0]["s"]
    assert [r["state"] for r in views.state_picker(spark.createDataFrame([("KA", 1), ("DL", 9)], "state string, n long")).collect()] == ["DL", "KA"]
    assert len(health.health_lines(spark.createDataFrame([("P", 4, 1, 1, 0, 0, 0, 0, 0, 0.75)], "publisher string, documents int, prefilter_skipped int, extracted int, out_of_scope int, failed int, published int, needs_review int, quarantined int, prefilter_pass_rate double"))) == 3
    assert health.journey({"raw": rows, "gone": rows.limit(0)}, "id", "CW-2001-KA-000001")[3] == "(not here)"


def test_settings():
    s = Settings.of({"VERIFY_MAX_USD": "x", "MODELS": "a, b", "VERIFY_ENABLED": "Yes", "DAILY_TOKEN_CAP": "7"}, {"verification": {"model": " v "}})
    assert (s.verify_usd, s.models, s.verify, s.tokens_per_day, s.verifier, s.mode, s.month_usd) == (0.5, ("a", "b"), True, 7, "v", "staged", 10.0)
    assert Settings.of({}, {"extraction": {"models": ["m", 3]}}).models == ("m",)
    assert estimate_usd(10**6, 10**6) == 2.8 and illustrative_usd(4000, 1) == estimate_usd(1400, 200)
    assert scope_label(frozenset({"KA", "DL"}), 30) == "DL,KA; last 30d" and scope_label(None, None) == "all states; no window"


def test_loading_what_a_run_remembers(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for name, text in {"a.json": '{"record_id": "r1", "quarantine": true}', "b.json": '{"record_id": "r1", "overrides": {"status": "CLOSED"}}', "c.json": "{", "d.json": '{"quarantine": true}'}.items():
        (tmp_path / "c" / name).write_text(text)
    got = state.load_corrections(spark, str(tmp_path / "c")).collect()
    assert [tuple(r) for r in got] == [("r1", None, '{"status":"CLOSED"}')]
    rows = frame(spark, [good(id="r1"), good(id="r2")])
    fixed, out = state.apply_corrections(rows, state.load_corrections(spark, str(tmp_path / "c")))
    assert out.count() == 0 and {r["id"]: (r["status"], r["corrected"]) for r in fixed.collect()} == {"r1": ("CLOSED", True), "r2": ("UNDER_TRIAL", None)}
    rows.write.parquet(str(tmp_path / "queue"))
    assert state.load_records(spark, str(tmp_path / "queue")).columns == ["ord", *NAMES] and state.load_records(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([(" https://a.example/1 ",), ("",)], "url string").write.parquet(str(tmp_path / "approved"))
    assert gates.approved(rows, state.load_approved(spark, str(tmp_path / "approved"))).where("_approved").count() == 2


def test_answers_stop_in_time(spark):
    class Client:
        def generate(self, prompt):
            return prompt.upper(), 1

    docs = spark.createDataFrame([("u1", "p"), ("u2", "p")], "url string, p string")
    assert {r["outcome"] for r in models.answers(docs, lambda: [Client()], F.col("p"), until=1.0, clock=lambda: 2.0).collect()} == {"not_asked"}
    assert {r["answer"] for r in models.answers(docs, lambda: [Client()], F.col("p"), until=3.0, clock=lambda: 2.0).collect()} == {"P"}


def test_records_are_written_as_shards(spark, tmp_path):
    rows = [good(id=f"CW-2001-KA-{k:06d}", first_published=DAY, cnr="c" if k % 2 else None) | {"incident_reported_date": f"200{k % 2}-03-0{k % 9 + 1}", "state": ("KA", "DL")[k % 3 == 0]} for k in range(1, 41)]
    rows[0]["accused"] = [{"label": "A", "name_public_court_record": None, "status": "FIR_FILED"}]
    df, path = frame(spark, rows), str(tmp_path / "tree")
    for most in (2000, 1 << 20):
        manifest = sinks.write_records(df, path, DAY, most).collect()
        assert sum(r["records"] for r in manifest) == 40 and {(r["year"], r["state"]) for r in manifest} == {(y, s) for y in ("2000", "2001") for s in ("KA", "DL")}
        assert all(r["bytes"] <= most or r["records"] == 1 for r in manifest) and (most > 2000 or len(manifest) > 4)
        back = sinks.read_records(spark, path)
        assert back.columns == NAMES and back.count() == 40 and back.exceptAll(df.select(NAMES)).count() == 0
    text = spark.read.text(path + "/*/*/*").where("value like '%CW-2001-KA-000001%'").first()["value"]
    assert '"name_public_court_record":null' in text
    s = sinks.summary(df, DAY, health.scale(spark.createDataFrame([], "day string, n long"), 3, 40, DAY)).first()
    assert s["total"] == 40 and s["status_counts"] == [("UNDER_TRIAL", 40)] and s["state_counts"][0]["n"] == 13 and len(s["monthly_trend"]) == 24 and len(s["daily"]) == 120
    pending = s["top_longest_pending"]
    assert len(pending) == 10 and pending[0]["days"] >= pending[-1]["days"] and s["jurisdictions"][0]["total"] >= s["jurisdictions"][-1]["total"]
    (tmp_path / "bad" / "a" / "b" / "c").mkdir(parents=True)
    (tmp_path / "bad" / "a" / "b" / "c" / "x.txt").write_text("{broken\n")
    with pytest.raises(Exception, match="no record"):
        sinks.read_records(spark, str(tmp_path / "bad")).collect()
    assert sinks.env_lines({"new": 3, "cost usd": "1.5; rm x"}) == ["NEW=3", "COST_USD=1.5rmx"] and token_cap(2.5) == 1_000_000


def test_pending_gives_one_row_for_a_url_with_several_entries(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "n int, url string")
    ledger = spark.createDataFrame([(u, "staged_pending", 0, DAY, DAY) for u in ("a", "a", "a")], state.LEDGER).withColumn("url_hash", state.url_hash(F.col("url_hash")))
    assert sorted(map(tuple, state.pending(docs, ledger).select("n", "_pending").collect())) == [(1, True), (2, False), (3, True), (4, False)]


@pytest.mark.parametrize("seed", range(40))
def test_fold_equals_merging_one_after_the_other(seed):
    rng = random.Random(seed)
    people = lambda: rng.choice([None, [], [{"label": rng.choice(["A", "B", "", None]), "name_public_court_record": rng.choice([None, "", "N"]), "status": rng.choice(["FIR_FILED", "CONVICTED", None])} for _ in range(rng.randrange(4))]])
    rows = random_records(seed, 30)
    for r in rows:
        r["sources"] = rng.choice([None, [], *[[source(rng.choice(["u1", "u2", "u3", "u4", "u5", None, ""]), rng.choice(["Daily", None, "High Court"])) for _ in range(rng.randrange(1, 4))] for _ in range(4)]])
        r["status_history"] = rng.choice([None, [], [{"status": rng.choice(["FIR_FILED", "CLOSED"]), "date": rng.choice(["2001-01-01", None]), "source": rng.choice([None, -1, 0, 1, 2, 3, 5])} for _ in range(rng.randrange(1, 4))]])
        r["confidence"], r["accused"] = rng.choice([None, 0.1, 0.5, 0.7, 0.9]), people()
        r["verified"], r["verification_note"], r["summary"] = rng.choice([None, False, True]), rng.choice([None, "", "n1", "n2"]), rng.choice(["", None, "s"])
    want, fold = rows[0], resolve.Fold(rows[0])
    for k, r in enumerate(rows):
        if k:
            want = resolve.merge_records(want, r)
            fold.add(r)
        assert fold.record() == want, k


def test_fold_takes_many_records_in_linear_time():
    fold, n = resolve.Fold(good()), 20_000
    began = time.process_time()
    for k in range(n):
        fold.add(good(sources=[source(f"https://a.example/{k}")]))
    assert len(fold.record()["sources"]) == n and time.process_time() - began < 20
