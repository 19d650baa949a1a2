"""The case-record queries against DuckDB on the same tables, and operators against brute force on made rows."""

import datetime
import random
from decimal import Decimal

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from casewright import catalog
from casewright.functions import codes, dates
from casewright.operators import aggregates, identity, resolve, views
from casewright.sources.adapters import RUN_DATE
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels benchmark".split()


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, (float, Decimal)):
        return round(float(x), 6)
    return x.isoformat() if isinstance(x, (datetime.date, datetime.datetime)) else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())


def test_entry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries()) >= set(catalog.QUERIES)
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize(("a", "b", "ratio"), [("", "", 100.0), ("a", "", 0.0), ("abc", "abc", 100.0), ("abcd", "acd", 600 / 7), ("ab", "ba", 50.0)])
def test_indel_ratio(a, b, ratio):
    assert resolve.indel_ratio(a, b) == pytest.approx(ratio)


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(200), f"k{random.randrange(150)}") for _ in range(220)]
    label = {n: n for n, _ in edges}
    for _ in label:
        for a, k in edges:
            for b, other in edges:
                if k == other:
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[a] == label[b] for a, k in edges for b, other in edges if k == other):
            break
    assert {r["node"]: r["component"] for r in resolve.components(spark.createDataFrame(edges, "node long, key string")).collect()} == label
    assert resolve.components(spark.createDataFrame([], "node long, key string")).count() == 0


def test_dedupe_covers_every_record_once(spark):
    rows = catalog.cases(spark, SF).where("ord < 1500")
    got = resolve.dedupe(rows).collect()
    assert sum(r["n_sources"] for r in got) == rows.count()
    assert {r["outcome"] for r in got} <= {"merged", "single", "ambiguous_match"}


def test_dedupe_equals_a_plain_greedy_pass(spark):
    rows = catalog.cases(spark, SF).withColumn("day", dates.strict_day(F.col("incident_reported_date"))).orderBy("ord").collect()
    clusters, doubtful = [], set()
    for r in rows:
        r = {"ord": r["ord"], "anchors": {f"cnr:{r['cnr']}"} if r["cnr"] else set(), "district": r["district"], "day": r["day"], "sections": set(r["sections"]), "court": r["court"]}
        found = [{resolve.strength(r, m) for m in c} for c in clusters]
        home = next((c for c, f in zip(clusters, found, strict=True) if f & {"exact", "strong"}), None)
        if home is not None:
            home.append(r)
        elif any("weak" in f for f in found):
            doubtful.add(r["ord"])
        else:
            clusters.append([r])
    got = catalog.QUERIES["dedupe_greedy"](spark, SF).collect()
    assert {r["ord"] for r in got if r["outcome"] == "ambiguous_match"} == doubtful != set()
    assert {r["ord"]: r["n_sources"] for r in got if r["outcome"] != "ambiguous_match"} == {c[0]["ord"]: len(c) for c in clusters}


def test_greedy_by_index_equals_strength():
    random.seed(16)
    for _ in range(20):
        records = [
            {"ord": k, "anchors": set(random.choices(["cnr:1", "cnr:2", "fir:1", "fir:2"], k=random.choice([0, 0, 0, 1, 2]))), "district": random.choice(["A", " a", "b", "", None]), "day": random.choice([None, datetime.date(2001, 1, random.randint(1, 30))]), "sections": set(random.choices("xyz", k=random.randint(0, 2))), "court": random.choice([None, "", "Court 1", "court 2", "Other"])}
            for k in range(60)
        ]
        clusters, doubtful = [], []
        for r in records:
            found = [{resolve.strength(r, m) for m in c} for c in clusters]
            home = next((c for c, f in zip(clusters, found, strict=True) if f & {"exact", "strong"}), None)
            if home is None and any("weak" in f for f in found):
                doubtful.append(r)
            elif home is None:
                clusters.append([r])
            else:
                home.append(r)
        assert resolve.greedy(records) == (clusters, doubtful)


def test_ids_are_unique_and_never_given_twice(spark):
    rows = catalog.cases(spark, SF)
    first = identity.mint(rows, spark.createDataFrame([], "cnr string, id string, year string, state string, serial int"), RUN_DATE)
    made = first.where("minted")
    assert made.count() == made.select("id").distinct().count() > 0
    prior = first.join(rows.select("ord", "cnr"), "ord").where("minted").select("cnr", "id", F.split("id", "-")[1].alias("year"), F.split("id", "-")[2].alias("state"), F.split("id", "-")[3].cast("int").alias("serial"))
    again = identity.mint(rows, prior, RUN_DATE)
    assert again.where("minted").join(prior, "id").count() == 0
    assert again.join(first.select("ord", F.col("id").alias("was")), "ord").join(rows.where("cnr is not null").select("ord"), "ord").where("id <> was").count() == 0


def test_nulls_and_empty_tables(spark):
    rows = catalog.cases(spark, SF)
    nothing = rows.where("false")
    blank = rows.limit(3).withColumns({c: F.lit(None).cast(t) for c, t in rows.dtypes if c != "ord"})
    assert {r["n"] for r in aggregates.counts(blank, "status").collect()} == {3}
    assert views.facets(blank, ["state", "status"]).count() == 0
    for empty in (aggregates.jurisdiction_scorecard(nothing, RUN_DATE), aggregates.top_pending(nothing, RUN_DATE), resolve.review_pairs(nothing), resolve.review_pairs(blank), views.offenders(nothing)):
        assert empty.count() == 0
    assert aggregates.monthly_trend(nothing, RUN_DATE).agg(F.sum("n")).first()[0] == 0
    assert aggregates.coverage(nothing, codes.STATES).where("gap").count() == len(codes.STATES)


def joined(pairs):
    """The smallest member of what each node is joined to."""
    top = {}

    def of(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = of(a), of(b)
        top[max(a, b)] = min(a, b)
    return {x: of(x) for x in top}


def test_review_clusters_join_what_all_pairs_join(spark):
    rng = random.Random(11)
    day = lambda: (datetime.date(2001, 1, 1) + datetime.timedelta(rng.randrange(-60, 90))).isoformat()[: rng.choice([10, 10, 10, 7])]
    rows = [(k, rng.choice(["KA", "KL"]), rng.choice(["D1", None]), rng.choice(["ADULT"] * 9 + [None]), day(), rng.choice(["c1", "c2", "c3", None]), rng.sample(["x", "y", "z", None], rng.randrange(4))) for k in range(400)]
    cases = spark.createDataFrame(rows, "ord long, state string, district string, category string, incident_reported_date string, cnr string, sections array<string>")
    want = joined(map(tuple, resolve.review_pairs(cases).collect()))
    for band in (4, 32):
        got = resolve.review_clusters(cases, band=band).collect()
        assert len(got) == len(want) and {r["ord"]: r["cluster"] for r in got} == want


def test_review_clusters_make_links_in_proportion_to_rows():
    n = 3000  # of one day and section: four and a half million pairs
    cnr = pa.chunked_array([pa.array([random.Random(k).choice(["a", "b", None]) for k in range(n)])])
    a, b = resolve.neighbour_links(np.arange(n), np.zeros(n, dtype=int), cnr, pa.chunked_array([pa.array([["x"]] * n)]), 3)
    assert len(a) <= 2 * n and set(resolve.least_reachable(n, a, b)) == {0}


def test_placements_equal_one_greedy_pass(spark):
    rng = random.Random(5)
    for bare in (False, True):
        day = lambda: rng.choice([None, *[datetime.date(2001, 1, 1) + datetime.timedelta(rng.randrange(120)) for _ in range(5)]])
        rows = [(3 * k, rng.sample(["cnr:1", "cnr:2", "fir:1", "fir:2"], rng.choice([0, 0, 0, 0, 1, 2])), rng.choice(["A", "a ", "B", "", None]), day(), rng.sample("xyz", rng.randrange(0 if bare else 1, 3)), rng.choice([None, "", "Court 1", "court 2", "Other"])) for k in range(160)]
        made = spark.createDataFrame(rows, "node long, anchors array<string>, district string, day date, sections array<string>, court string")
        clusters, doubtful = resolve.greedy([dict(zip(made.columns, r, strict=True)) for r in rows])
        want = {r["node"]: c[0]["node"] for c in clusters for r in c} | {r["node"]: None for r in doubtful}
        assert {r["node"]: r["cluster"] for r in resolve.placements(made).collect()} == want


def test_greedy_keeps_no_records():
    told = resolve.Greedy()
    assert {told.place(k, ["cnr:1"], "A", 11000 + k % 5, ["x"], "Court 1") for k in range(2000)} == {0}
    assert len(told.by_anchor) == 1 and len(told.members) == 5 and sum(len(cell[1]) for at in told.members.values() for cell in at.values()) == 5


def test_block_sets_are_those_of_the_keys(spark):
    rng = random.Random(8)
    day = lambda: rng.choice([None, *[datetime.date(2001, 1, 1) + datetime.timedelta(rng.randrange(300)) for _ in range(9)]])
    rows = [(k, rng.choice([[], [], [], [f"cnr:{rng.randrange(99)}"]]), rng.choice([*"ABCDEFG", None]), day(), rng.choice([[], *[rng.sample("uvwxyz", 1) for _ in range(9)]]), rng.choice([None, None, "Court 1"])) for k in range(150)]
    made = spark.createDataFrame(rows, "node long, anchors array<string>, district string, day date, sections array<string>, court string")
    want = {k: k for k in range(150)} | {r["node"]: r["component"] for r in resolve.components(resolve.match_blocks(made)).collect()}
    got = {r["node"]: r["component"] for r in resolve.block_sets(made.withColumn("day", F.unix_date("day"))).collect()}
    groups = lambda told: {frozenset(k for k in told if told[k] == c) for c in told.values()}
    assert groups(got) == groups(want) and 3 < len(groups(want)) < 150
