"""Case records made from the order tables: one portable SELECT that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = "2001-08-02"
_STATES = "AP,AR,AS,BR,CT,GA,GJ,HR,HP,JH,KA,KL,MP,MH,MN,ML,MZ,NL,OD,PB,RJ,SK,TN,TG,TR"
_STATUS = "FIR_FILED,CHARGESHEETED,UNDER_TRIAL,CONVICTED,ACQUITTED,APPEAL_PENDING,CLOSED,QUASHED,UNKNOWN"
_SECTIONS = "BNS 64,BNS 70(2),POCSO 6,IPC 376,IPC 354,BNS 75,POCSO 4,BNS 78,IPC 376D,BNS 124,POCSO 8,IPC 509,BNS 65,NI ACT 138"
_PUBLISHERS = "High Court Desk,LiveLaw,The Daily Post,Information Bureau,City News,District Court Registry"
_SITES = "ecourts.example/judgment,livelaw.example/news,daily.example/live-updates,pib.gov.in/release,city.example/news,court.example/order"
_SLUGS = "bail-order,school-teacher-held,court-hearing,17-year-old-case,appeal-filed"
CASES_SQL = f"""
select o_orderkey as ord,
  split_part('{_STATES}', ',', cast(n_nationkey + 1 as int)) as state,
  concat('D', lpad(cast(o_custkey % 7 as string), 2, '0')) as district,
  split_part('{_STATUS}', ',', cast(o_orderkey % 9 + 1 as int)) as status,
  o_orderkey % 4 = 0 as minor_involved,
  case when o_orderkey % 4 = 0 then substr(cast(o_orderdate as string), 1, 7) when o_orderkey % 11 = 0 then substr(cast(o_orderdate as string), 1, 4)
       else substr(cast(o_orderdate as string), 1, 10) end as incident_reported_date,
  case when o_orderkey % 5 < 2 then concat('CNR', cast(o_orderkey % 6000 as string)) end as cnr,
  split_part('{_SECTIONS}', ',', cast(o_orderkey % 14 + 1 as int)) as section_1,
  split_part('{_SECTIONS}', ',', cast(o_custkey % 14 + 1 as int)) as section_2,
  cast(70 + o_orderkey % 31 as double) / 100 as confidence,
  case when o_orderkey % 3 = 0 then concat('Court ', cast(o_custkey % 5 as string)) end as court,
  split_part('{_PUBLISHERS}', ',', cast(o_orderkey % 6 + 1 as int)) as publisher,
  concat('https://', split_part('{_SITES}', ',', cast(o_orderkey % 6 + 1 as int)), '/', substr(cast(o_orderdate as string), 1, 4), '/', substr(cast(o_orderdate as string), 6, 2), '/',
    split_part('{_SLUGS}', ',', cast(o_orderkey % 5 + 1 as int)), '-', cast(o_orderkey as string)) as url,
  case when o_orderkey % 4 = 0 then 'CHILD' else 'ADULT' end as category,
  case when o_custkey % 2 = 0 then concat('Person ', cast(o_custkey % 40 as string)) end as accused_name
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case table; the session's SQL runs the portable SELECT over the three tables given as arguments."""
    return spark.sql(CASES_SQL.replace("from orders join customer", "from {orders} join {customer}").replace("join nation on", "join {nation} on"), orders=load(spark, sf_dir, "orders"), customer=load(spark, sf_dir, "customer"), nation=load(spark, sf_dir, "nation"))
