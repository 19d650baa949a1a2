"""Whole records made from the order tables: one portable SELECT of flat columns, and the nested records of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.functions import codes
from casewright.records.schema import conform
from casewright.sources.adapters import CASES_SQL, RUN_DATE, load

_CATEGORIES = "sexual_assault,rape,pocso,acid_attack,harassment,other,POCSO "
_TRACES = "a woman aged 24,the husband of the accused,a nurse at City hospital was raped,the sarpanch of Rampur gaon,her chacha ji,call 9876543210,mail me@site.example,the petitioner u/s 376,under section 376,नौकरी 15 साल,no trace at all,a teacher was arrested"
#: Flat columns beside those of the cases; b is a text of the benchmark table, of which there may be few.
FLAT_SQL = f"""
select c.*, b.text as body,
  split_part('{_CATEGORIES}', ',', cast(c.ord % 7 + 1 as int)) as kind,
  split_part('{_TRACES}', ',', cast(c.ord % 12 + 1 as int)) as trace,
  case when c.ord % 6 = 0 then concat('PS ', cast(c.ord % 40 as string)) end as station,
  case when c.ord % 6 = 0 then concat(cast(c.ord % 90 as string), case when c.ord % 12 = 0 then '/1999' else '' end) end as fir_number,
  case when c.ord % 4 = 1 then concat('https://second.example/', cast(c.ord % 50 as string)) end as url_2,
  case when c.ord % 8 = 1 then 'Sessions Judge Office' else 'Evening Paper' end as publisher_2,
  concat('2001-0', cast(c.ord % 8 + 1 as string), '-1', cast(c.ord % 10 as string)) as retrieved,
  case when c.ord % 9 = 4 then '2001-05-05' end as first_day,
  c.ord % 8 = 3 as was_verified,
  case when c.ord % 5 = 2 then 'FIR_FILED' end as was_status
from ({CASES_SQL}) c left join benchmark b on b.item_id = c.ord % 40"""


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat columns; the session's SQL runs the portable SELECT over the tables given as arguments."""
    sql = FLAT_SQL.replace("from orders join customer", "from {orders} join {customer}").replace("join nation on", "join {nation} on").replace("left join benchmark b", "left join {benchmark} b")
    return spark.sql(sql, **{n: load(spark, sf_dir, n) for n in ("orders", "customer", "nation", "benchmark")})


def records(rows: DataFrame) -> DataFrame:
    """(ord, *record): the nested records of flat rows, without ids."""
    no = lambda kind: F.lit(None).cast(kind)
    source = lambda url, publisher: F.when(url.isNotNull(), F.struct(url.alias("url"), publisher.alias("publisher"), F.col("retrieved"), codes.source_type(url, publisher).alias("source_type")))
    made = rows.select(
        "ord", "cnr", F.when(F.col("station").isNotNull(), F.struct("station", F.col("fir_number").alias("number"))).alias("fir_ref"), "state", "district", "incident_reported_date",
        F.array_distinct(F.array("section_1", "section_2")).alias("offence_sections"), F.col("kind").alias("category"), "minor_involved", "status",
        F.when(F.col("was_status").isNotNull(), F.array(F.struct(F.col("was_status").alias("status"), F.substring("retrieved", 1, 10).alias("date"), F.lit(0).alias("source")))).alias("status_history"),
        F.when(F.col("accused_name").isNotNull(), F.array(F.struct(F.lit("Accused 1").alias("label"), F.col("accused_name").alias("name_public_court_record"), F.lit("UNDER_TRIAL").alias("status")))).alias("accused"),
        F.when(F.col("court").isNotNull(), F.struct(F.col("court").alias("name"), F.lit("2001-09-01").alias("next_hearing"))).alias("court"),
        F.concat(F.lit("Case: "), "trace").alias("title"), F.concat_ws(" ", "trace", "body").alias("summary"), F.array_compact(F.array(source(F.col("url"), F.col("publisher")), source(F.col("url_2"), F.col("publisher_2")))).alias("sources"),
        "confidence", F.col("first_day").alias("first_published"), F.col("was_verified").alias("verified"), F.when(F.col("was_verified"), "seen in court").alias("verification_note"), no("string").alias("id"),
    )
    return conform(made, keep=("ord",))


__all__ = ["FLAT_SQL", "RUN_DATE", "flat", "records"]
