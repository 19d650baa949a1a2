"""Payload parsers on good and malformed input; shards there and back."""

import pytest
from pyspark.sql import functions as F

from casewright import catalog
from casewright.sources import parsers, shards
from casewright.sources.adapters import RUN_DATE

SF = "/root/testdata/sf0.001"


def test_search_hits(spark):
    good = '{"docs": [{"tid": 7, "title": "A", "docsource": "High Court"}, {"tid": ""}, {"title": "no id"}, 3, {"tid": "x9", "headline": "H", "publishdate": "2001-01-02"}]}'
    rows = spark.createDataFrame([(1, good), (2, "{"), (3, None), (4, "[]"), (5, '{"docs": 1}'), (6, "{}")], "q int, body string")
    got = [tuple(r) for r in parsers.search_hits(rows, "body").collect()]
    assert got == [(1, "7", "A", "", "High Court", ""), (1, "x9", "", "H", "", "2001-01-02")]


def test_court_cases(spark):
    listed = '[{"url": "u1", "cnr": "C1", "sections": ["IPC 376", "BNS 64"], "status": ""}, {"cnr": "no url"}, {"url": "u2"}, 5]'
    rows = spark.createDataFrame([(1, listed), (2, '{"cases": [{"case_url": "u3", "court": "HC", "fir_number": 12}]}'), (3, "nonsense"), (4, None)], "q int, body string")
    assert [tuple(r) for r in parsers.court_cases(rows, "body").orderBy("q").collect()] == [(1, "u1", "CNR: C1. Sections: IPC 376, BNS 64"), (2, "u3", "Court: HC. FIR: 12")]


def test_judgment_text(spark):
    rows = spark.createDataFrame([("<p>Held <b>so</b></p><script>x</script>", " HC ", None, "2001"), ("<p> </p>", "HC", "T", ""), (None, "HC", "T", "")], "b string, c string, t string, d string")
    got = rows.select(parsers.judgment_text(*[F.col(c) for c in "bctd"]).alias("x"), parsers.publisher(F.col("t"), "else").alias("p")).collect()
    assert [tuple(r) for r in got] == [("Court: HC. Date: 2001. Held so", "else"), ("", "T"), ("", "T")]


def test_submissions(spark):
    body = "### Public source URL\n\nsee (https://a.example/x) there\n\n### State / UT \nKA\n### District\n_No response_\n### Other\nx\n"
    rows = spark.createDataFrame([(3, body), (4, "### State / UT\nKA"), (5, None), (None, "### Public source URL\nhttp://b.example\n### State / UT\nTN\n### State / UT\nKL")], "number int, body string")
    assert sorted(tuple(r) for r in parsers.submissions(rows).collect()) == [("http://b.example", "KL", "", "", 0), ("https://a.example/x", "KA", "", "", 3)]


def test_shards(spark, tmp_path):
    rows = catalog.cases(spark, SF)
    at = str(tmp_path / "shards")
    shards.write_shards(rows, at, RUN_DATE, most=4096)
    back = shards.read_shards(spark, at, rows.schema)
    assert rows.exceptAll(back).count() == back.exceptAll(rows).count() == 0
    sizes = [f.stat().st_size for f in (tmp_path / "shards").rglob("*.json")]
    assert 2048 < max(sizes) <= 4096
    shards.write_shards(rows.limit(3), at, RUN_DATE, most=1)
    assert len(list((tmp_path / "shards").rglob("*.json"))) == 3
    (tmp_path / "shards" / "_year=1900" / "_state=KA").mkdir(parents=True)
    (tmp_path / "shards" / "_year=1900" / "_state=KA" / "bad.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        shards.read_shards(spark, at, rows.schema).collect()
