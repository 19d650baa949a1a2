"""The queries over case records, documents, pages and events, with DuckDB's SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.functions import codes, dates, minors, persons, text
from casewright.operators import aggregates, gates, guards, identity, models, resolve, views
from casewright.plans import daily as plans
from casewright.sources import feeds, parsers, payloads
from casewright.sources.adapters import CASES_SQL, RUN_DATE, cases as _cases, load
from casewright.streaming import events as streams

QUERIES: dict = {}
ORACLES: dict = {}
CTE = f"""with cases as (select *, case when section_1 = section_2 then [section_1] else [section_1, section_2] end as sections,
  case when length(incident_reported_date) = 10 then cast(incident_reported_date as date) when length(incident_reported_date) = 7 then cast(incident_reported_date || '-01' as date) end as rday from ({CASES_SQL}))
"""
_ACTIVE = "('FIR_FILED', 'CHARGESHEETED', 'UNDER_TRIAL', 'APPEAL_PENDING')"
_DAYS = f"case when rday is not null then greatest(date_diff('day', rday, date '{RUN_DATE}'), 0) end"


def query(oracle: str | None = None, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLES[name or f.__name__] = oracle
        return f

    return register


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir).withColumn("sections", F.array_distinct(F.array("section_1", "section_2")))


@query(CTE + f"""select state, district, count(*) as total, count(*) filter (where status = 'UNDER_TRIAL') as under_trial, count(*) filter (where status = 'CONVICTED') as convictions,
  count(*) filter (where status in ('ACQUITTED', 'QUASHED')) as acquittals, count(*) filter (where status = 'FIR_FILED') as pre_chargesheet,
  cast(round_even(100.0::double * count(*) filter (where status = 'UNDER_TRIAL') / count(*), 0) as int) as under_trial_pct,
  cast(trunc(median({_DAYS}) filter (where not minor_involved and cnr is not null and status in {_ACTIVE})) as int) as median_pending,
  cast(max({_DAYS}) filter (where not minor_involved and cnr is not null and status in {_ACTIVE}) as int) as longest_days,
  max(ord) filter (where not minor_involved and cnr is not null and status in {_ACTIVE} and {_DAYS} = top) as longest_ord
  from (select *, max(case when not minor_involved and cnr is not null and status in {_ACTIVE} then {_DAYS} end) over (partition by state, district) as top from cases)
  group by state, district order by total desc, state, district limit 120""")
def jurisdiction_scorecard(spark, sf_dir):
    return aggregates.jurisdiction_scorecard(cases(spark, sf_dir), RUN_DATE)


@query(CTE + "select coalesce(status, 'UNKNOWN') as status, count(*) as n from cases group by 1")
def status_counts(spark, sf_dir):
    return aggregates.counts(cases(spark, sf_dir), "status")


@query(CTE + "select coalesce(state, 'UNKNOWN') as state, count(*) as n from cases group by 1")
def state_counts(spark, sf_dir):
    return aggregates.counts(cases(spark, sf_dir), "state")


@query(CTE + f"""select strftime(m, '%Y-%m') as month, (select count(*) from cases where length(incident_reported_date) >= 7 and incident_reported_date[1:7] = strftime(m, '%Y-%m')) as n
  from (select unnest(generate_series(date_trunc('month', date '{RUN_DATE}') - interval 23 month, date_trunc('month', date '{RUN_DATE}'), interval 1 month)) as m)""")
def monthly_trend_24(spark, sf_dir):
    return aggregates.monthly_trend(cases(spark, sf_dir), RUN_DATE)


@query(CTE + f"select ord, state, district, cast({_DAYS} as int) as days from cases where status in {_ACTIVE} and not minor_involved and cnr is not null and rday is not null order by days desc, ord limit 10")
def top_longest_pending(spark, sf_dir):
    return aggregates.top_pending(cases(spark, sf_dir), RUN_DATE)


def _sql_regex(parts):
    import re

    return "(" + "|".join(re.escape(p).replace("\\ ", " ") for p in sorted(parts, key=len, reverse=True)) + ")([^A-Z0-9]|$)"


_LABEL = "case " + " ".join(f"when regexp_matches(upper(array_to_string(sections, ' | ')), '{_sql_regex(p)}') then '{label}'" for label, _, p in codes.SEVERITY) + " end"
_AGGRAVATED = ", ".join(f"'{label}'" for label, flag, _ in codes.SEVERITY if flag)


@query(CTE + f"select label, count(*) as n, count(*) filter (where label in ({_AGGRAVATED})) as aggravated from (select {_LABEL} as label from cases) where label is not null group by label")
def severity_summary(spark, sf_dir):
    return aggregates.severity_summary(cases(spark, sf_dir))


@query(CTE + f"select ord, {_LABEL} as label, coalesce({_LABEL} in ({_AGGRAVATED}), false) as aggravated, regexp_matches(upper(array_to_string(sections, ' | ')), '{_sql_regex(codes.REPEAT_SECTIONS)}') as repeat from cases")
def severity_label(spark, sf_dir):
    s = F.col("sections")
    return cases(spark, sf_dir).select("ord", codes.severity(s).alias("label"), codes.severity(s, "aggravated").alias("aggravated"), codes.is_repeat(s).alias("repeat"))


_WRITTEN = ["section_1", "concat('  section ', lower(section_2), ' ')", "case ord % 4 when 0 then '376 (2) (i) of Indian Penal Code' when 1 then 'POCSO Act 2012' when 2 then 'unknown' else concat('u/s ', section_1) end"]


def _canonical_sql(raw: str) -> str:
    t = f"trim(regexp_replace(upper({raw}), '\\s+', ' ', 'g'))"
    act = f"case when regexp_matches({t}, '\\bPOCSO\\b|PROTECTION OF CHILDREN') then 'POCSO' when regexp_matches({t}, '\\bBNS\\b|BHARATIYA NYAYA SANHITA') then 'BNS' when regexp_matches({t}, '\\bIPC\\b|INDIAN PENAL CODE') then 'IPC' end"
    number = "\\b(\\d{1,4}[A-Z]{0,3})((?:\\s*\\([^)]{1,4}\\))*)"
    found, suffix = f"nullif(regexp_extract({t}, '{number}', 1), '')", f"regexp_replace(regexp_extract({t}, '{number}', 2), '\\s+', '', 'g')"
    return f"case when {found} is null then {act} when not (regexp_matches({found}, '^(1[89]\\d\\d|20\\d\\d)$') and {suffix} = '') then concat(coalesce({act} || ' ', ''), {found}, {suffix}) end"


_CANON_SQL = [_canonical_sql(x) for x in _WRITTEN]
_FIRST_SEEN = "list_filter(list_transform(l, lambda x, i: case when list_position(l, x) = i then x end), lambda x: x is not null)"


@query(CTE + f"""select ord, array_to_string({_FIRST_SEEN}, '|') as canonical, array_to_string(list_filter([{', '.join(f"case when c{k} is null then trim(regexp_replace({x}, '\\s+', ' ', 'g')) end" for k, x in enumerate(_WRITTEN))}], lambda x: x is not null), '|') as unparsed
  from (select *, list_filter([c0, c1, c2], lambda x: x is not null) as l from (select *, {', '.join(f'{x} as c{k}' for k, x in enumerate(_CANON_SQL))} from cases))""")
def normalize_sections(spark, sf_dir):
    s = codes.normalize_sections(F.array(*[F.expr(x) for x in _WRITTEN]))
    return cases(spark, sf_dir).select("ord", F.array_join(s["canonical"], "|").alias("canonical"), F.array_join(s["unparsed"], "|").alias("unparsed"))


@query(CTE + """select code, case code when 'TS' then 'TG' when 'TL' then 'TG' when 'CG' then 'CT' when 'OR' then 'OD' when 'UK' then 'UT' when 'UA' then 'UT' when 'PD' then 'PY' when 'DD' then 'DN' else code end as state, count(*) as n
  from (select case ord % 4 when 0 then 'TS' when 1 then 'OR' when 2 then state else 'UK' end as code from cases) group by all""")
def state_alias(spark, sf_dir):
    raw = F.expr("case ord % 4 when 0 then ' ts' when 1 then 'Or' when 2 then lower(state) else 'UK ' end")
    return cases(spark, sf_dir).select(F.upper(F.trim(raw)).alias("code"), codes.normalize_state(raw).alias("state")).groupBy("code", "state").agg(F.count("*").alias("n"))


@query(CTE + "select case ord % 3 when 0 then 'Gurugram' when 1 then 'Bengaluru' else district end as district, count(*) as n from cases group by 1")
def district_alias(spark, sf_dir):
    raw = F.expr("case ord % 3 when 0 then ' GURGAON ' when 1 then 'bangalore' else concat(' ', district) end")
    return cases(spark, sf_dir).groupBy(codes.canonical_district(raw).alias("district")).agg(F.count("*").alias("n"))


_ALL_STATES = ", ".join(f"('{s}')" for s in codes.STATES)


@query(CTE + f"select s.state, count(c.ord) as records, count(c.ord) = 0 as gap from (values {_ALL_STATES}) s(state) left join cases c on c.state = s.state group by s.state")
def coverage_by_state(spark, sf_dir):
    return aggregates.coverage(cases(spark, sf_dir), codes.STATES)


@query(CTE + "select count(*) as total, count(cnr) as anchored, round_even(count(cnr)::double / count(*), 4) as rate from cases")
def trackability(spark, sf_dir):
    return aggregates.trackability(cases(spark, sf_dir))


@query("""with d as (select cast(unnest(generate_series(date '2024-01-31' - interval 119 day, date '2024-01-31', interval 1 day)) as date) as day), c as (select d.day, count(event_id) as n from d left join events e on cast(e.ts as date) = d.day group by 1)
  select day, n, cast(sum(n) over (order by day rows between 6 preceding and current row) as bigint) as week, cast(sum(n) over (order by day) as bigint) as total from c""")
def ingestion_scale_120(spark, sf_dir):
    return aggregates.ingestion_scale(load(spark, sf_dir, "events"), "2024-01-31")


@query("select source, count(*) as documents, count(quality) as extracted, count(*) filter (where quality = 1) as published, round_even(count(*) filter (where quality = 1)::double / count(*), 3) as pass_rate from documents left join labels using (doc_id) group by source")
def source_funnel(spark, sf_dir):
    return aggregates.source_funnel(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def _any(column, parts):
    return "(" + " or ".join(f"contains(lower({column}), '{p}')" for p in parts) + ")"


_TYPE = f"case when {_any('publisher', codes.OFFICIAL)} then 'court' when {_any('publisher', codes.LEGAL_PRESS)} then 'legal_press' when {_any("url || ' ' || publisher", codes.LIVE_BLOG)} then 'live_blog' when {_any("url || ' ' || publisher", codes.PRESS_RELEASE)} then 'press_release' else 'news_article' end"
_TIER = "case {t} when 'court' then 1 when 'legal_press' then 2 when 'live_blog' then 4 else 3 end"


@query(CTE + f"select source_type, {_TIER.format(t='source_type')} as tier, count(*) as n from (select {_TYPE} as source_type from cases) group by all")
def source_tier(spark, sf_dir):
    rows = cases(spark, sf_dir).select(codes.source_type(F.col("url"), F.col("publisher")).alias("source_type"))
    return rows.groupBy("source_type", codes.source_tier(F.col("source_type")).alias("tier")).agg(F.count("*").alias("n"))


@query(CTE + f"select coalesce(cnr, 'ord:' || ord) as anchor, min({_TIER.format(t=_TYPE)}) as tier, count(*) as n from cases group by 1")
def record_tier(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumn("tier", codes.source_tier(codes.source_type(F.col("url"), F.col("publisher"))))
    return rows.groupBy(F.coalesce("cnr", F.concat(F.lit("ord:"), F.col("ord").cast("string"))).alias("anchor")).agg(F.min("tier").alias("tier"), F.count("*").alias("n"))


@query(r"""select page_id, regexp_matches(regexp_replace(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[/\-_.]+', ' ', 'g'), '(?i)\b(""" + codes.SLUG_WORDS + r""")\b') as flagged from (select page_id, concat(split_part(url, '?', 1), '/', split_part('17-year-old-held,girl_missing,court.order,school-trip,schooling,boys,order', ',', cast(page_id % 7 + 1 as int))) as u from pages)""")
def slug_flag(spark, sf_dir):
    slug = F.split_part(F.lit("17-year-old-held,girl_missing,court.order,school-trip,schooling,boys,order"), F.lit(","), (F.col("page_id") % 7 + 1).cast("int"))
    url = F.concat(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("/"), slug)
    return load(spark, sf_dir, "pages").select("page_id", codes.identifying_slug(url).alias("flagged"))


@query("select page_id, case when regexp_matches(lower(trim(url)), '^https?://') then url else '#' end as url from pages")
def safe_url(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", codes.safe_http_url(F.col("url")).alias("url"))


@query(r"""select page_id, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g')), 1, 20000) as text from pages""")
def strip_html(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("text"))


@query(r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\b\d{4}\s?\d{4}\s?\d{4}\b', '[redacted]', 'g'), '\b(?:\+?91[\-\s]?)?[6-9]\d{9}\b', '[redacted]', 'g'), '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '[redacted]', 'g'), '\b[A-Z]{5}\d{4}[A-Z]\b', '[redacted]', 'g') as text from documents """)
def redact_pii(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.redact(F.col("text")).alias("text"))


@query("select doc_id, list_filter([" + ", ".join(f"case when regexp_matches(text, '{p}') then '{n}' end" for n, p in text.PII.items()) + "], lambda x: x is not null) as hits, regexp_matches(text, '[ऀ-ൿ]') as native from documents")
def pii_hits(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.pii_hits(F.col("text")).alias("hits"), text.native_script(F.col("text")).alias("native"))


_STYLE = ["the petitioner and the Respondents", "vide order of the court", "u/s 376 and r/w", "under section", "IPC 376", "prima facie, prima FACIE", "plain"]
_STYLED = f"concat(split_part('{'|'.join(_STYLE)}', '|', cast(doc_id % {len(_STYLE)} + 1 as int)), ' ', text)"


@query(f"""with d as (select doc_id, {_STYLED} as t from documents) select doc_id, array_to_string(list_concat(list_concat(
  list_transform(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)\\b({'|'.join(sorted(text.LEGALESE, key=len, reverse=True))})\\b', 1), lambda x: lower(x)))), lambda x: concat('legalese term ', chr(39), x, chr(39))),
  case when regexp_matches(t, '(?i)\\bunder\\s+section\\b|\\bsection\\s+\\d|\\b\\d{{2,4}}[A-Za-z]?\\s*(IPC|BNS|BNSS|POCSO)\\b|\\b(IPC|BNS|BNSS|POCSO)\\s*\\d') then ['cites a statute section by number in prose'] else [] end),
  list_transform(list_filter(list_transform(regexp_split_to_array(t, '[.!?]+'), lambda s: len(list_filter(regexp_split_to_array(s, '[ \t\n\x0b\f\r]+'), lambda w: w <> ''))), lambda n: n > 25), lambda n: 'sentence exceeds 25 words (' || n || ')')), '; ') as reasons from d""")
def readability(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select("doc_id", F.expr(_STYLED).alias("t"))
    return rows.select("doc_id", F.array_join(text.readability_violations(F.col("t")), "; ").alias("reasons"))


_CHARGES = ["charged u/s 376 of the code", "the BNS Section 64 case", "a case under pocso", "a civil suit, section 9", "IPC 354A", "64 BNS", "gang-rape", "outraging her modesty", "IPC 302", "BNS 103"]
_CHARGED = f"concat(text, ' ', split_part('{'|'.join(_CHARGES)}', '|', cast(doc_id % {len(_CHARGES)} + 1 as int)))"


@query(f"with d as (select doc_id, {_CHARGED} as t from documents) select doc_id, regexp_matches(t, '(?i){'|'.join(text.STATUTES)}') as relevant from d")
def statute_filter(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.statute_hit(F.expr(_CHARGED)).alias("relevant"))


@query(CTE + f"""select ord, list_filter([case when minor_involved then 'minor_involved' end, case when (contains(section_1, 'POCSO') or contains(section_2, 'POCSO')) and not minor_involved then 'pocso_minor_mismatch' end,
  case when accused_name is not null then 'named_accused' end, case when {_TYPE} in ('live_blog', 'legal_press') then 'live_blog_only' end, case when confidence < 0.85 then 'confidence_below_auto' end], lambda x: x is not null) as reasons from cases""")
def gate_reasons(spark, sf_dir):
    return cases(spark, sf_dir).withColumn("source_type", codes.source_type(F.col("url"), F.col("publisher"))).select("ord", gates.hold_reasons().alias("reasons"))


_QUALIFIES = "(contains({s}, 'POCSO') or (contains({s}, 'BNS') and try_cast(regexp_extract({s}, '(\\d{{1,3}})', 1) as int) between 63 and 79) or (contains({s}, 'IPC') and try_cast(regexp_extract({s}, '(\\d{{1,3}})', 1) as int) in (354, 375, 376, 377, 509)))"


@query(CTE + f"select ord, case when not {_QUALIFIES.format(s='section_1')} and not {_QUALIFIES.format(s='section_2')} then 'scope_review' when confidence < 0.8 then 'low_confidence' end as reason from cases")
def review_reasons(spark, sf_dir):
    return cases(spark, sf_dir).select("ord", gates.review_reason().alias("reason"))


_RAW_STATE = "case ord % 7 when 0 then ' ' when 1 then 'XX' when 2 then lower(state) when 3 then concat(' ', state, ' ') when 4 then 'ts' when 5 then cast(null as string) else state end"


@query(CTE + f"""select ord, case when coalesce(trim(s), '') = '' then 'no_jurisdiction' when case upper(trim(s)) {' '.join(f"when '{a}' then '{b}'" for a, b in codes.STATE_ALIASES.items())} else upper(trim(s)) end not in ({', '.join(f"'{x}'" for x in codes.STATES)}) then 'unknown_state' end as reason from (select ord, {_RAW_STATE} as s from cases)""")
def jurisdiction_split(spark, sf_dir):
    return cases(spark, sf_dir).withColumn("state", F.expr(_RAW_STATE)).select("ord", gates.jurisdiction_reason().alias("reason"))


@query(CTE + "select ord, list_filter([case when minor_involved and length(incident_reported_date) <> 7 then 'minor_date' end, case when minor_involved and accused_name is not null then 'minor_accused' end, case when not minor_involved and length(incident_reported_date) <> 10 then 'day_date' end], lambda x: x is not null) as violations from cases")
def schema_split(spark, sf_dir):
    return cases(spark, sf_dir).select("ord", gates.schema_violations().alias("violations"))


@query(CTE + f"select ord from cases where state in ('AP', 'KA', 'TN') and rday between date '{RUN_DATE}' - 400 and date '{RUN_DATE}'")
def launch_scope(spark, sf_dir):
    return gates.in_scope(cases(spark, sf_dir), ["AP", "KA", "TN"], 400, RUN_DATE).select("ord")


@query(CTE + "select ord, case when court is not null and cnr is not null then accused_name end as accused_name from cases")
def withhold_names(spark, sf_dir):
    return cases(spark, sf_dir).select("ord", gates.withheld_accused().alias("accused_name"))


@query(CTE + f"select ord, district, status, incident_reported_date from cases where state = 'KA' and status in {_ACTIVE} and not minor_involved and contains(lower(concat_ws(' ', district, status, court, section_1, section_2)), 'bns')")
def explore_filter_sort(spark, sf_dir):
    return views.explore(cases(spark, sf_dir), RUN_DATE, state="KA", activity="active", minor=False, q="BNS").select("ord", "district", "status", "incident_reported_date")


@query(CTE + "select 'state' as facet, state as value, count(*) as n from cases group by all union all select 'district', district, count(*) from cases group by all union all select 'status', status, count(*) from cases group by all")
def facets(spark, sf_dir):
    return views.facets(cases(spark, sf_dir), ["state", "district", "status"])


@query(CTE + "select ord, state, district, status, incident_reported_date from cases order by incident_reported_date desc, ord desc limit 50")
def feed_recent_50(spark, sf_dir):
    return views.feed(cases(spark, sf_dir))


@query(CTE + "select accused_name, count(*) as n, max(incident_reported_date) as latest, count(*) filter (where status = 'CONVICTED') as convictions from cases where not minor_involved and accused_name is not null group by 1")
def offenders(spark, sf_dir):
    return views.offenders(cases(spark, sf_dir))


@query("select source, count(*) as ready from documents where not exists (select 1 from labels where labels.doc_id = documents.doc_id) group by source")
def ledger_ready(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "source").join(load(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("ready"))


_NEXT = "select ord, case when ord % 10 = 0 then 'CLOSED' else status end as status, court, sections from cases where ord % 7 <> 0"


def _later(rows):
    return rows.where("ord % 7 <> 0").withColumn("status", F.expr("case when ord % 10 = 0 then 'CLOSED' else status end"))


@query(CTE + f", a as (select ord, status, court, sections from cases where ord % 13 <> 0), b as ({_NEXT}) select coalesce(a.ord, b.ord) as ord, case when a.ord is null then 'new' when b.ord is null then 'gone' when a.status is not distinct from b.status and a.court is not distinct from b.court and a.sections = b.sections then 'same' else 'changed' end as change from a full join b on a.ord = b.ord")
def material_change(spark, sf_dir):
    rows = cases(spark, sf_dir)
    return identity.material_change(rows.where("ord % 13 <> 0"), _later(rows), "ord", ["status", "court", "sections"])


@query(CTE + f", b as ({_NEXT}) select coalesce(a.ord, b.ord) as ord, coalesce(b.status, a.status) as status, b.ord is not null as refreshed from (select * from cases where ord % 13 <> 0) a full join b on a.ord = b.ord")
def carryover_full_outer(spark, sf_dir):
    rows = cases(spark, sf_dir)
    held, fresh = rows.where("ord % 13 <> 0").select("ord", F.col("status").alias("held")), _later(rows).select("ord", F.col("status").alias("fresh"))
    return held.join(fresh, "ord", "full").select("ord", F.coalesce("fresh", "held").alias("status"), F.col("fresh").isNotNull().alias("refreshed"))


@query(CTE + "select ord, case when ord % 50 = 1 then 'CLOSED' else status end as status, ord % 50 = 1 as corrected from cases where ord % 50 <> 2")
def corrections_left(spark, sf_dir):
    rows = cases(spark, sf_dir)
    fixes = rows.where("ord % 50 in (1, 2)").select("ord", (F.col("ord") % 50 == 2).alias("quarantine"), F.lit("CLOSED").alias("override"))
    return rows.join(fixes, "ord", "left").where("not coalesce(quarantine, false)").select("ord", F.coalesce("override", "status").alias("status"), F.col("override").isNotNull().alias("corrected"))


@query(CTE + ", live as (select ord, cnr from cases where ord % 9 = 0) select ord from cases c where ord in (select ord from live) or cnr in (select cnr from live where cnr is not null)")
def refresh_semi(spark, sf_dir):
    rows = cases(spark, sf_dir).select("ord", "cnr")
    live = rows.where("ord % 9 = 0")
    return rows.join(live.select("ord"), "ord", "left_semi").select("ord").union(rows.join(live.where("cnr is not null").select("cnr"), "cnr", "left_semi").select("ord")).distinct()


@query(CTE + """select a.ord as a, b.ord as b from cases a join cases b on a.state = b.state and a.district = b.district and a.category = b.category and a.ord < b.ord and length(a.incident_reported_date) = 10 and length(b.incident_reported_date) = 10
  and abs(date_diff('day', a.rday, b.rday)) <= 3 and list_has_any(a.sections, b.sections) and not coalesce(a.cnr = b.cnr, false)""")
def merge_review_pairs(spark, sf_dir):
    return resolve.review_pairs(cases(spark, sf_dir))


@query(CTE + "select ord, case when cnr is null then ord else min(ord) over (partition by cnr) end as component from cases")
def exact_anchor_components(spark, sf_dir):
    rows = cases(spark, sf_dir)
    keys = rows.select(F.col("ord").alias("node"), F.explode(resolve.anchor_keys(F.col("cnr"), F.lit(""), F.lit(""), F.col("incident_reported_date"))).alias("key"))
    return rows.select("ord").join(resolve.components(keys), F.col("ord") == F.col("node"), "left").select("ord", F.coalesce("component", "ord").alias("component"))


@query()
def dedupe_greedy(spark, sf_dir):
    """All cases by their own districts and court numbers, which join them into a few components."""
    return resolve.dedupe(cases(spark, sf_dir))


@query(CTE + f""", m as (select *, case when length(incident_reported_date) >= 4 then incident_reported_date[1:4] else '{RUN_DATE[:4]}' end as year, min(ord) over (partition by coalesce(cnr, 'ord:' || ord)) as first from cases),
  p as (select cnr, min('CW-' || year || '-' || state || '-' || lpad(cast(ord % 1000 + 1 as varchar), 6, '0')) as known from m where cnr is not null and ord % 8 = 0 group by cnr),
  t as (select year, state, max(ord % 1000 + 1) as top from m where cnr is not null and ord % 8 = 0 group by year, state),
  n as (select m.first, 'CW-' || m.year || '-' || m.state || '-' || lpad(cast(coalesce(t.top, 0) + row_number() over (partition by m.year, m.state order by m.ord) as varchar), 6, '0') as new
        from m left join p on m.cnr = p.cnr left join t on m.year = t.year and m.state = t.state where m.ord = m.first and p.known is null)
  select m.ord, coalesce(p.known, n.new) as id, p.known is null and m.ord = m.first as minted from m left join p on m.cnr = p.cnr left join n on n.first = m.first""")
def id_mint(spark, sf_dir):
    rows = cases(spark, sf_dir)
    prior = rows.where("cnr is not null and ord % 8 = 0").select("cnr", dates.year_of(F.col("incident_reported_date"), RUN_DATE).alias("year"), "state", (F.col("ord") % 1000 + 1).alias("serial"))
    prior = prior.withColumn("id", F.concat_ws("-", F.lit("CW"), "year", "state", F.lpad(F.col("serial").cast("string"), 6, "0")))
    return identity.mint(rows, prior, RUN_DATE)


@query(CTE + "select cnr, ord, confidence from (select *, row_number() over (partition by cnr order by court is null, confidence desc, ord) as r from cases where cnr is not null) where r = 1")
def id_collision_keep(spark, sf_dir):
    return identity.keep_best(cases(spark, sf_dir).where("cnr is not null"), "cnr", F.col("court").isNull(), F.desc("confidence"), "ord").select("cnr", "ord", "confidence")


@query(CTE + "select ord, case when length(incident_reported_date) = 4 then incident_reported_date || '-' || regexp_extract(url, '/(\\d{4})/(\\d{2})/', 2) end as month, case when length(incident_reported_date) = 4 then 'source_url' end as provenance from cases")
def month_recovery(spark, sf_dir):
    got = dates.recover_month(F.col("incident_reported_date"), F.array("url"), F.lit("2001-08-02"))
    return cases(spark, sf_dir).select("ord", got["month"].alias("month"), got["provenance"].alias("provenance"))


@query(CTE + "select 'total' as what, count(*) as a, (select sum(n) from (select count(*) as n from cases group by state)) as b, true as agree from cases union all select 'statuses', count(distinct status), 9, count(distinct status) = 9 from cases")
def count_reconciliation(spark, sf_dir):
    rows = cases(spark, sf_dir)
    total, states = rows.agg(F.count("*").alias("a")), aggregates.counts(rows, "state").agg(F.sum("n").alias("b"))
    first = total.join(states).select(F.lit("total").alias("what"), "a", "b", (F.col("a") == F.col("b")).alias("agree"))
    return first.union(rows.agg(F.count_distinct("status").alias("a")).select(F.lit("statuses"), "a", F.lit(9).cast("long"), F.col("a") == 9))


@query("select cast(json_extract(props, '$.k') as bigint) % 10 as k, count(*) as n, round(sum(value), 4) as total from events group by 1")
def json_scan(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long") % 10
    return load(spark, sf_dir, "events").groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("select day, round(spent, 4) as spent, round(sum(spent) over (order by day), 4) as upto from (select cast(ts as date) as day, sum(greatest(value, 0)) as spent from events group by 1)")
def spend_running(spark, sf_dir):
    """Spending by day and so far; the running sum is over days, of which a month's ledger has a few dozen."""
    from pyspark.sql import Window

    daily = load(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.greatest("value", F.lit(0.0))).alias("spent"))
    return daily.select("day", F.round("spent", 4).alias("spent"), F.round(F.sum("spent").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)), 4).alias("upto"))


@query(CTE + "select cast(pct as bigint) as pct, active, total from (select floor(100.0 * count(*) filter (where status = 'FIR_FILED') / count(*) + 0.5) as pct, count(*) filter (where status in ('FIR_FILED', 'CHARGESHEETED', 'UNDER_TRIAL', 'APPEAL_PENDING')) as active, count(*) as total from cases)")
def stalled_headline(spark, sf_dir):
    return aggregates.stalled(cases(spark, sf_dir))


@query("""with l as (select sha256(url) as url_hash, case page_id % 3 when 0 then 'failed' else 'published' end as outcome, page_id % 3 as attempts from (select page_id, url || '#' || page_id as url from pages where page_id % 2 = 0)),
  n as (select sha256(url || '#' || page_id) as url_hash, 'failed' as new from pages where page_id % 4 < 2)
  select coalesce(l.url_hash, n.url_hash) as url_hash, case when new is null then outcome when coalesce(attempts, 0) + 1 >= 3 then 'failed_permanent' else new end as outcome, cast(coalesce(attempts, 0) + case when new = 'failed' then 1 else 0 end as int) as attempts,
  coalesce(case when l.url_hash is not null then '2001-08-01' end, '2001-08-02') as first_seen, case when new is not null then '2001-08-02' else '2001-08-01' end as last_seen from l full join n on l.url_hash = n.url_hash""")
def ledger_update(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", F.concat_ws("#", "url", F.col("page_id").cast("string")).alias("url"))
    ledger = pages.where("page_id % 2 = 0").select(F.sha2("url", 256).alias("url_hash"), F.expr("case page_id % 3 when 0 then 'failed' else 'published' end").alias("outcome"), (F.col("page_id") % 3).alias("attempts"), F.lit("2001-08-01").alias("first_seen"), F.lit("2001-08-01").alias("last_seen"))
    return identity.ledger_step(ledger, pages.where("page_id % 4 < 2").select("url", F.lit("failed").alias("outcome")), RUN_DATE)


@query("select distinct user_id, event_type from events")
def stream_dedupe(spark, sf_dir):
    return streams.drained(streams.distinct_users(streams.source(spark, sf_dir)), "append")


@query("select date_trunc('day', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def stream_windows(spark, sf_dir):
    return streams.drained(streams.hourly(streams.source(spark, sf_dir)), "complete").withColumn("total", F.round("total", 4))


@query(CTE + "select publisher, cast(ord as varchar) as tid, coalesce(accused_name, '') as title, url as headline, coalesce(court, '') as docsource, incident_reported_date as publishdate from cases")
def search_hits(spark, sf_dir):
    hit = F.struct(F.col("ord").alias("tid"), F.col("accused_name").alias("title"), F.col("url").alias("headline"), F.col("court").alias("docsource"), F.col("incident_reported_date").alias("publishdate"))
    odd = F.struct(F.lit(None).cast("long").alias("tid"), F.lit("no id").alias("title"), *[F.lit("").alias(n) for n in ("headline", "docsource", "publishdate")])
    rows = cases(spark, sf_dir).select("publisher", F.to_json(F.struct(F.array(hit, odd).alias("docs"))).alias("payload"))
    return parsers.search_hits(rows, "payload")


@query(CTE + "select ord, url, concat_ws('. ', 'CNR: ' || cnr, 'Court: ' || court, 'District: ' || district, 'Sections: ' || array_to_string(sections, ', ')) as text from cases")
def court_cases(spark, sf_dir):
    rows = cases(spark, sf_dir)
    payload = F.to_json(F.struct(F.array(F.struct("url", "district", "sections", "court", "cnr")).alias("cases")))
    return parsers.court_cases(rows.select("ord", payload.alias("payload")), "payload")


@query(CTE + "select ord, concat_ws('. ', 'Court: ' || court, 'Date: ' || incident_reported_date, 'Held in ' || district || ' .') as text, coalesce(court, 'Registry') as publisher from cases")
def judgment_text(spark, sf_dir):
    body = F.concat(F.lit("<p>Held in <b>"), "district", F.lit("</b>.</p><script>x()</script>"))
    text_ = parsers.judgment_text(body, F.col("court"), F.lit(" "), F.col("incident_reported_date"))
    return cases(spark, sf_dir).select("ord", text_.alias("text"), parsers.publisher(F.col("court"), "Registry").alias("publisher"))


@query(CTE + "select url, case when ord % 2 = 0 then '' else state end as state, district, case when minor_involved then '' else incident_reported_date end as incident_date, cast(ord as int) as issue_number from cases where ord % 7 <> 0")
def submissions(spark, sf_dir):
    url = F.when(F.col("ord") % 7 == 0, "none yet").otherwise(F.concat(F.lit("see ("), "url", F.lit(") there")))
    answers = {"Public source URL": url, "State / UT": F.when(F.col("ord") % 2 == 0, "_No response_").otherwise(F.col("state")), "District": F.col("district"), "Reported month (YYYY-MM) or date (YYYY-MM-DD)": F.when(F.col("minor_involved"), " ").otherwise(F.col("incident_reported_date")), "Anything else": F.col("publisher")}
    body = F.concat(*[x for heading, answer in answers.items() for x in (F.lit(f"### {heading}\n\n"), answer, F.lit("\n"))])
    return parsers.submissions(cases(spark, sf_dir).select(F.col("ord").alias("number"), body.alias("body")))


_FACTS = {
    "category": "case ord % 3 when 0 then 'pocso' when 1 then 'rape' else 'acid_attack' end",
    "accused_count": "case when ord % 5 < 3 then cast(ord % 12 as int) end",
    "acted": "case ord % 4 when 0 then 'arrest_made' when 1 then 'bail_denied' when 2 then 'chargesheet_filed' end",
    "acted_too": "case when ord % 11 < 3 then 'appeal_filed' end",
    "repeat_offence": "ord % 7 = 0",
    "weapon_or_threat": "ord % 9 < 2",
    "sentence_years": "case when ord % 13 < 2 then cast(ord % 13 as int) end",
    "was_minor": "ord % 8 < 5",
}
_FACTS_SQL = ", facts as (select * exclude (category), " + ", ".join(f"{sql} as {name}" for name, sql in _FACTS.items()) + " from cases)"


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir).withColumns({name: F.expr(sql) for name, sql in _FACTS.items()})
    return rows.withColumns({"minor_involved": F.col("was_minor"), "institutional_actions": F.array_compact(F.array("acted_too", "acted"))})


_NAMED = "case state " + " ".join(f"when '{c}' then '{n}'" for c, n in zip(codes.STATES, codes.STATE_NAMES, strict=True)) + " end"
_CALLED = "case category when 'pocso' then 'Child sexual offence' when 'rape' then 'Rape' else 'Acid attack' end"


@query(CTE + _FACTS_SQL + f""", p as (select *, coalesce({_LABEL}, {_CALLED}) as phrase0, incident_reported_date[1:4] as y from facts where was_minor),
  q as (select *, case when regexp_matches(lower(phrase0), 'child|minor') then phrase0 else phrase0 || ' involving a minor' end as phrase, case when accused_count >= 1 then accused_count end as cnt from p),
  r as (select *, lower(phrase[1]) || phrase[2:] as off, cast(cnt is not null as int) + cast(coalesce(acted, acted_too) is not null as int) + cast(repeat_offence as int) + cast(weapon_or_threat as int) + cast(sentence_years is not null as int) as known,
    case when cnt <= 10 then ['One', 'Two', 'Three', 'Four', 'Five', 'Six', 'Seven', 'Eight', 'Nine', 'Ten'][cnt] else cast(cnt as varchar) end || case when cnt = 1 then ' person was' else ' people were' end as who from q)
  select ord, (phrase || ' — ' || district || ' (' || y || ')')[1:90] as title, incident_reported_date[1:7] as reported,
  case when known >= 2 then concat_ws(' ', case when acted = 'arrest_made' and cnt is not null then who || ' arrested in ' || district || ' for the ' || off || '.' when acted = 'arrest_made' then 'An arrest was made in ' || district || ' for the ' || off || '.'
      when cnt is not null then who || ' accused of the ' || off || ' in ' || district || '.' else 'A case of ' || off || ' in ' || district || ' was recorded.' end,
    case when weapon_or_threat then 'A weapon or threat was involved.' end, case when repeat_offence then 'The accused is recorded as a repeat offender.' end,
    case when acted = 'chargesheet_filed' then 'Police have filed a chargesheet.' end, case when acted = 'bail_denied' then 'Bail was denied.' end, case when acted_too is not null then 'An appeal was filed.' end,
    case when sentence_years is not null then 'The court imposed a sentence of ' || sentence_years || case when sentence_years = 1 then ' year.' else ' years.' end end, 'Identifying details are withheld by law (POCSO s.23).')
  else 'A case of ' || off || ' in ' || district || ', ' || {_NAMED} || ' (' || y || '). ' || case status {" ".join(f"when '{k}' then '{v}'" for k, v in minors.STATUSES.items())} end || '. Identifying details are withheld by law (POCSO s.23).' end as summary
  from r""")
def minor_projection(spark, sf_dir):
    return minors.project(_facts(spark, sf_dir)).where("minor_involved").select("ord", "title", F.col("incident_reported_date").alias("reported"), "summary")


@query(CTE + """select ord, case ord % 6 when 0 then 'Police said [occupation withheld] in ' || district when 1 then 'A teacher was arrested in ' || district || ' on Monday' when 2 then 'The accused, a tutor, of ' || district
  when 3 then '[occupation withheld] was assaulted, man held' when 4 then 'Near ' || district || ' [occupation withheld] filed a report' else 'One of the many men accused raped [occupation withheld] ; held' end as text from cases""")
def occupation_scrub(spark, sf_dir):
    t = F.expr("""case ord % 6 when 0 then 'Police said the accused raped a nurse in ' || district when 1 then 'A teacher was arrested in ' || district || ' on Monday' when 2 then 'The accused, a tutor, of ' || district
      when 3 then 'Cabin crew member was assaulted, man held' when 4 then 'Near ' || district || ' a 24-year-old student of Green Hill College filed a report' else 'One of the many men accused raped nurse ; held' end""")
    return cases(spark, sf_dir).select("ord", persons.without_occupations(t).alias("text"))


_SAID = ["she is 9 years old", "a girl 12 of class VI", "The Teenager spoke", "Her Father-in-law", "a neighbour, an uncle", "seventeen year old", "the 5th standard", "aged 40", "a partnership", "none of it"]
_TOLD = f"concat(text, ' ', split_part('{'|'.join(_SAID)}', '|', cast(doc_id % {len(_SAID)} + 1 as int)))"


@query(f"""with d as (select doc_id, {_TOLD} as t, doc_id % 3 = 0 as minor from documents), h as (select doc_id, minor, list_filter([{', '.join(f"case when regexp_matches(t, '(?i){p}') then '{n}' end" for n, p in persons.AGES.items())}], lambda x: x is not null) as ages, regexp_extract_all(t, '(?i)\\b({'|'.join(persons.RELATIONS)})\\b', 1) as relations from d)
select doc_id, ages, relations, not minor and (len(ages) > 0 or len(relations) > 0) as hold from h""")
def identity_hits(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select("doc_id", F.expr(_TOLD).alias("t"))
    return rows.select("doc_id", persons.age_hits(F.col("t")).alias("ages"), persons.relations(F.col("t")).alias("relations"), persons.identity_detail(F.col("doc_id") % 3 == 0, F.col("t")).alias("hold"))


@query(CTE + "select ord, url, case when ord % 2 = 0 then district || ' ' || status || '. ' || section_1 || ' & ' || section_2 else coalesce(court, 'No court') end as text from cases")
def feed_entries(spark, sf_dir):
    rss = F.concat(F.lit("<rss><channel><title>t</title><item><title>"), "district", F.lit(" "), "status", F.lit("</title><link>"), "url", F.lit("</link><description><![CDATA[<p>"), "section_1", F.lit(" &  "), "section_2", F.lit("</p>]]></description></item><item><title>no link</title></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), F.coalesce("court", F.lit("No court")), F.lit('</title><link href="'), "url", F.lit('"/></entry><entry><link href="https://a.example/none"/></entry></feed>'))
    rows = cases(spark, sf_dir).select("ord", F.when(F.col("ord") % 2 == 0, rss).otherwise(atom).alias("payload"))
    return feeds.feed_entries(rows, "payload")


@query(CTE + "select ord, [url || '.pdf', 'https://c.example/lists/' || district || '.PDF?x=1&y=' || ord, 'https://d.example/' || state || '.pdf'] as urls from cases")
def pdf_links(spark, sf_dir):
    n = F.col("ord").cast("string")
    page = F.concat(F.lit('<a href="'), "url", F.lit(""".pdf">1</a><a HREF = '"""), "district", F.lit(".PDF?x=1&amp;y="), n, F.lit("""'>2</a><a href="//d.example/"""), "state", F.lit('.pdf, e.pdf">3</a><a href="x.html">4</a><a href="'), "url", F.lit('.pdf">5</a>'))
    return cases(spark, sf_dir).select("ord", feeds.pdf_urls(page, F.lit("https://c.example/lists/index.html")).alias("urls"))


@query(CTE + """select publisher, count(*) as listed, count(*) filter (where court is not null) as fetched, count(*) filter (where court is not null and ord % 6 <> 0) as with_text,
  count(*) filter (where court is not null and ord % 6 <> 0 and section_1 like 'IPC%') as qualifying, count(*) filter (where court is not null) > 10 and count(*) filter (where court is not null and ord % 6 <> 0) = 0 as broken from cases group by publisher""")
def fetch_funnel(spark, sf_dir):
    return feeds.fetch_funnel(cases(spark, sf_dir), "publisher", F.col("court").isNotNull(), F.when(F.col("ord") % 6 != 0, "text").otherwise(""), F.col("section_1").startswith("IPC"))


@query(CTE + "select state, ord from (select state, ord, row_number() over (partition by state order by ord) as r from cases) where r <= 40 order by state, ord limit 60")
def fetch_caps(spark, sf_dir):
    """The first 40 of each state and 60 of all: the caps are the feature."""
    return feeds.capped(cases(spark, sf_dir), "state", ["ord"], 40, 60).select("state", "ord")


@query(CTE.replace("with cases", "with recursive cases") + """, pairs as (select a.ord as a, b.ord as b from cases a join cases b on a.state = b.state and a.district = b.district and a.category = b.category and a.ord < b.ord and length(a.incident_reported_date) = 10 and length(b.incident_reported_date) = 10
  and abs(date_diff('day', a.rday, b.rday)) <= 3 and list_has_any(a.sections, b.sections) and not coalesce(a.cnr = b.cnr, false)), e as (select a as x, b as y from pairs union select b, a from pairs),
  reach as (select x as node, x as r from e union select e.y, reach.r from reach join e on e.x = reach.node) select node as ord, min(r) as cluster from reach group by node""")
def merge_review_clusters(spark, sf_dir):
    return resolve.review_clusters(cases(spark, sf_dir))


@query(CTE + f"select s.state, count(c.ord) as n, case when count(c.ord) = 0 then 0.0::double else round(0.25::double + 0.75::double * count(c.ord) / max(count(c.ord)) over (), 3) end as intensity from (values {_ALL_STATES}) s(state) left join cases c on c.state = s.state group by s.state")
def state_grid(spark, sf_dir):
    return views.state_grid(cases(spark, sf_dir), codes.STATES)


@query(f"with t as ({ORACLES['monthly_trend_24']}) select count(*) as months, cast(sum(n) as bigint) as total, max(n) as most, (select month from t order by n desc, month limit 1) as peak from t")
def heat_strip(spark, sf_dir):
    return views.heat_strip(aggregates.monthly_trend(cases(spark, sf_dir), RUN_DATE))


@query(CTE + f"""select ord, case length(incident_reported_date) when 10 then strftime(rday, '%b %-d, %Y') when 7 then strftime(rday, '%b %Y') else incident_reported_date end as shown, split_part(split_part(url, '://', 2), '/', 1) as domain,
  case when n is null or n < 0 then '' when n = 0 then 'today' when n = 1 then 'yesterday' when n < 7 then n || ' days ago' when n < 45 then case when floor(n / 7.0 + 0.5) = 1 then 'last week' else cast(floor(n / 7.0 + 0.5) as int) || ' weeks ago' end
  when n < 365 then case when floor(n / 30.0 + 0.5) = 1 then 'last month' else cast(floor(n / 30.0 + 0.5) as int) || ' months ago' end when floor(n / 365.0 + 0.5) = 1 then 'last year' else cast(floor(n / 365.0 + 0.5) as int) || ' years ago' end as recency
  from (select *, case when length(incident_reported_date) = 10 then date_diff('day', rday, date '{RUN_DATE}') end as n from cases)""")
def display_fields(spark, sf_dir):
    d = F.col("incident_reported_date")
    return cases(spark, sf_dir).select("ord", views.display_date(d).alias("shown"), views.source_domain(F.col("url")).alias("domain"), views.recency(d, RUN_DATE).alias("recency"))


@query(CTE + """, t as (select *, confidence >= 0.8 and ord % 4 <> 0 as yes, ord % 4 = 0 or section_1 = 'NI ACT 138' as lost from cases)
  select ord, case when lost then status else case when accused_name is not null then 'CLOSED' else status end end as status, yes and not lost as verified, case when not lost then url end as verification_note, lost as incomplete from t""")
def verdicts(spark, sf_dir):
    rows = cases(spark, sf_dir)
    told = F.to_json(F.struct((F.col("confidence") >= 0.8).alias("verified"), F.struct(F.when(F.col("accused_name").isNotNull(), "CLOSED").alias("status"), F.lit(False).alias("minor_involved")).alias("corrections"), F.col("url").alias("verification_note")))
    answer = F.when(F.col("section_1") == "NI ACT 138", "I can not say").otherwise(F.concat(F.lit("Found: "), told, F.lit(" [1]")))
    given = rows.where("ord % 4 <> 0").select("ord", models.verdict(answer).alias("verdict"))
    return models.apply_verdicts(rows.select("ord", "status", "minor_involved"), given, "ord", ["status", "minor_involved"]).select("ord", "status", "verified", "verification_note", "incomplete")


@query(CTE + "select ord, coalesce(sum(ord % 17) over (order by ord rows between unbounded preceding and 1 preceding), 0) < 5000 as asked from cases")
def budget_prefix(spark, sf_dir):
    """Who is still asked under a cap on the sum of costs before."""
    return models.budgeted(cases(spark, sf_dir).select("ord"), "ord", F.col("ord") % 17, 5000).select("ord", "asked")


_ROUTES = CTE + f"""select ord, case when not coalesce(rday between date '{RUN_DATE}' - 1500 and date '{RUN_DATE}', false) then 'out_of_scope'
  when not m and length(incident_reported_date) <> 10 then 'quarantined'
  when not {_QUALIFIES.format(s='section_1')} and not {_QUALIFIES.format(s='section_2')} or confidence < 0.8 then 'review'
  when ord % 29 <> 0 and (m or court is not null and cnr is not null and accused_name is not null or {_TYPE} in ('live_blog', 'legal_press') or confidence < 0.85) then 'held' else 'published' end as route
  from (select *, minor_involved or contains(section_1, 'POCSO') or contains(section_2, 'POCSO') as m from cases)"""


@query(_ROUTES)
def daily_routes(spark, sf_dir):
    rows = cases(spark, sf_dir)
    config = plans.RunConfig.of({"LAUNCH_STATES": "ALL", "LAUNCH_LOOKBACK_DAYS": "1500"}, RUN_DATE)
    return plans.routed(rows, config, rows.where("ord % 29 = 0").select("url")).select("ord", "route")


@query("select doc_id, 'said.text' as path, reason from (select doc_id, unnest(list_filter([" + ", ".join(f"case when regexp_matches(text, '{p}') then '{n}' end" for n, p in text.PII.items()) + "], lambda x: x is not null)) as reason from documents) union all select doc_id, 'said.victim_age', 'name' from documents where doc_id % 10 = 0 union all select doc_id, '<file>', 'unreadable' from documents where text is null")
def pii_scan(spark, sf_dir):
    said = F.struct("text", F.when(F.col("doc_id") % 10 == 0, 9).alias("victim_age"))
    payload = F.when(F.col("text").isNull(), "{broken").otherwise(F.to_json(F.struct(said.alias("said"), F.array("lang", "source").alias("list"))))
    return guards.scan_json(load(spark, sf_dir, "documents").select("doc_id", payload.alias("payload")), "payload")


@query(CTE + "select ord, ord % 3 = 0 and status <> 'CLOSED' as longer, case when ord % 5 = 0 then 'new' when ord % 3 = 0 and status <> 'CLOSED' then 'material' else 'rechecked' end as change from (select * from cases where ord % 5 > 0 or ord % 3 > 0 or status = 'CLOSED') union all select ord, false, 'new' from cases where ord % 5 = 0 and ord % 3 = 0 and status <> 'CLOSED'")
def status_transitions(spark, sf_dir):
    """Cases against their last published selves: a third of them were closed then, a fifth were not there."""
    none = F.array().cast("array<struct<status: string, date: string, source: int>>")
    now = cases(spark, sf_dir).withColumns({"id": F.col("ord"), "status_history": none})
    prior = now.where("ord % 5 > 0").select("id", "court", "sections", F.expr("if(ord % 3 = 0, 'CLOSED', status)").alias("status"), F.lit("2001-01-01").alias("first_published"), F.lit(None).cast("string").alias("last_status_change"))
    got = identity.stamps(identity.with_transition(now, prior, RUN_DATE).drop("first_published", "last_status_change"), prior, RUN_DATE, ["status", "court", "sections"])
    return got.select("ord", (F.size("status_history") == 2).alias("longer"), "change")


@query(CTE + "select ord, district, status, case when " + _TYPE + " = 'live_blog' then least(confidence, 0.79) else confidence end as confidence from cases where ord % 6 > 0")
def candidate_answers(spark, sf_dir):
    answer = F.when(F.col("ord") % 6 == 0, F.lit('{"category": "rape", "state": "KA"}')).otherwise(F.to_json(F.struct("category", "state", "district", "status", "confidence", F.lit("x").alias("victim"))))
    rows = cases(spark, sf_dir).withColumns({"answer": answer, "fetched_at": F.lit(RUN_DATE)})
    got = payloads.candidates(rows)
    return got.select(F.regexp_extract("url", r"-(\d+)$", 1).cast("long").alias("ord"), "district", "status", "confidence")


@query("select page_id, case when page_id % 3 = 0 then 'https://archive.example/' || page_id end as archive_url from pages")
def archive_snapshots(spark, sf_dir):
    n = F.col("page_id").cast("string")
    payload = F.concat(F.lit('{"archived_snapshots": {"closest": {"available": '), F.element_at(F.array(F.lit("true"), F.lit('"true"'), F.lit("false")), (F.col("page_id") % 3 + 1).cast("int")), F.lit(', "url": "https://archive.example/'), n, F.lit('"}}}'))
    return load(spark, sf_dir, "pages").select("page_id", payloads.snapshot_url(payload).alias("archive_url"))
