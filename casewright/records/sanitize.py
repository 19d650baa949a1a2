"""The last gate before a record is written: what may not be told goes, at every depth of the record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from casewright.functions import codes, dates, minors, multilingual, persons, text
from casewright.operators.guards import FORBIDDEN, FORBIDDEN_PARTS, forbidden
from casewright.records import gates
from casewright.records.schema import conform, listed


def clean(value: Column) -> Column:
    """A string without personal data and native script; a mark stands for each. Twice is as good as once."""
    return multilingual.scrub_native(text.redact(value))


def _forbidden(name: Column) -> Column:
    return F.lower(name).isin(*FORBIDDEN) | F.lower(name).rlike("|".join(FORBIDDEN_PARTS))


def contains_pii(value: Column) -> Column:
    """Whether a string holds personal data or is itself the name of a forbidden field; false for null."""
    return F.coalesce(_forbidden(value) | (F.size(text.pii_hits(value)) > 0), F.lit(False))


def _walked(value: Column, kind: DataType, leaf: Callable[[Column], Column]) -> Column:
    """``value`` with ``leaf`` applied to each string in it, and without fields and map entries of forbidden names."""
    if isinstance(kind, StringType):
        return leaf(value)
    if isinstance(kind, StructType):
        own = [f for f in kind if not forbidden(f.name)]
        return F.when(value.isNotNull(), F.struct(*[_walked(value[f.name], f.dataType, leaf).alias(f.name) for f in own])) if own else F.lit(None).cast("string")
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _walked(x, kind.elementType, leaf)) if _has_strings(kind) else value
    if isinstance(kind, MapType):
        return F.transform_values(F.map_filter(value, lambda k, v: ~_forbidden(k)), lambda k, v: _walked(v, kind.valueType, leaf))
    return value


def _has_strings(kind: DataType) -> bool:
    return isinstance(kind, (StringType, StructType, MapType)) or isinstance(kind, ArrayType) and _has_strings(kind.elementType)


def scrub(rows: DataFrame, leaf: Callable[[Column], Column] = clean) -> DataFrame:
    """``rows`` without columns and nested fields of forbidden names, every string in what is left cleaned."""
    return rows.select(*[_walked(F.col(f"`{f.name}`"), f.dataType, leaf).alias(f.name) for f in rows.schema if not forbidden(f.name)])


def coerce_minor(rows: DataFrame) -> DataFrame:
    """minor_involved as a plain yes or no: yes where nobody told, and where the category or a section says so."""
    return rows.withColumn("minor_involved", gates.minor())


def project_minors(rows: DataFrame) -> DataFrame:
    """Minors' records with fixed sentences, months for days and without accused; other records as they are."""
    told = minors.project(rows.withColumn("sections", listed("offence_sections")))
    court = F.when(F.col("minor_involved") & F.col("court").isNotNull(), F.col("court").withField("next_hearing", F.lit(None).cast("string"))).otherwise(F.col("court"))
    return told.withColumn("court", court).select(rows.columns)


def sanitize(rows: DataFrame) -> DataFrame:
    """Records of the schema's columns, fit to be told: strings cleaned, minors projected; of others the occupations that
    could tell a victim are withheld, and a lacking title is made from codes. Prose loses romanised traces as well."""
    minor = F.coalesce("minor_involved", F.lit(False))
    projected = project_minors(scrub(rows).withColumn("minor_involved", minor))
    title = minors.plain_title(F.col("category"), F.col("district"), F.col("state"), F.col("incident_reported_date"))
    kept = {"title": F.coalesce(F.nullif(F.trim(persons.without_occupations("title")), F.lit("")), title), "summary": persons.without_occupations("summary")}
    told = projected.withColumns({n: F.when(F.col("minor_involved"), F.col(n)).otherwise(c) for n, c in kept.items()})
    return told.withColumns({n: multilingual.scrub(F.col(n)) for n in kept})


def recover_date(rows: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Bare years become months where evidence of that year tells one: a dated URL, else an archive's first snapshot
    (``snapshots``: url, month), else first publication. incident_date_provenance says which; a month is never made up."""
    # a column of its own: inside a lambda the analyser would take the date that this step is about to replace
    rows = rows.withColumn("_year", F.when(F.trim("incident_reported_date").rlike(r"^\d{4}$"), F.trim("incident_reported_date")))
    year = F.col("_year")
    urls = F.transform(listed("sources"), lambda s: F.coalesce(s["url"], F.lit("")))
    dated = F.filter(F.transform(urls, lambda u: F.regexp_extract(u, r"/(\d{4}[/-](?:0[1-9]|1[0-2]))(?=[/-])", 1)), lambda m: F.substring(m, 1, 4) == year)
    by_url = F.concat(year, F.lit("-"), F.substring(F.get(dated, F.lit(0)), 6, 2))
    rows, by_snapshot = rows.withColumn("_n", F.monotonically_increasing_id()), F.lit(None).cast("string")
    if snapshots is not None:
        known = snapshots.where(F.col("month").rlike(r"^\d{4}-(0[1-9]|1[0-2])$")).select("url", "month")
        cited = rows.where(year.isNotNull()).select("_n", year.alias("y"), F.posexplode(urls).alias("place", "url"))
        seen = cited.join(known, "url").where(F.substring("month", 1, 4) == F.col("y")).groupBy("_n").agg(F.min(F.struct("place", "month"))["month"].alias("_seen"))
        rows, by_snapshot = rows.join(seen, "_n", "left"), F.col("_seen")
    first = F.when(F.col("first_published").rlike(r"^\d{4}-(0[1-9]|1[0-2])") & (F.substring("first_published", 1, 4) == year), F.substring("first_published", 1, 7))
    month = F.coalesce(by_url, by_snapshot, first)
    why = F.when(by_url.isNotNull(), "source_url").when(by_snapshot.isNotNull(), "wayback").otherwise("first_published")
    found = year.isNotNull() & month.isNotNull()
    told = {"incident_reported_date": F.when(found, month).otherwise(F.col("incident_reported_date")), "incident_date_provenance": F.when(found, why).otherwise(F.col("incident_date_provenance"))}
    return rows.withColumns(told).drop("_n", "_seen", "_year")


def date_fallback(rows: DataFrame, reported: str) -> DataFrame:
    """Records without a date of their own get the day of the document that they come from, the column ``reported``."""
    day = F.substring(F.col(reported), 1, 10)
    return rows.withColumn("incident_reported_date", F.coalesce(F.nullif(F.trim("incident_reported_date"), F.lit("")), F.when(dates.strict_day(day).isNotNull(), day)))


def withhold_names(rows: DataFrame) -> DataFrame:
    """The accused's names are withheld unless a court and a case number, or a station's number, stand for them."""
    said = lambda c: F.coalesce(c != "", F.lit(False))
    stands = said(F.col("court.name")) & (said(F.col("cnr")) | said(F.col("fir_ref.number")))
    return rows.withColumn("accused", F.when(stands, F.col("accused")).otherwise(F.transform("accused", lambda a: a.withField("name_public_court_record", F.lit(None).cast("string")))))


def normalize_sections(rows: DataFrame) -> DataFrame:
    """Sections as rules know them; what is no section moves to unparsed_sections. Twice is as good as once."""
    found = codes.normalize_sections(listed("offence_sections"))
    some = F.size(listed("offence_sections")) > 0
    return rows.withColumn("_s", found).withColumns({"offence_sections": F.when(some, F.col("_s.canonical")).otherwise(F.col("offence_sections")), "unparsed_sections": F.when(some, F.when(F.size("_s.unparsed") > 0, F.col("_s.unparsed"))).otherwise(F.col("unparsed_sections"))}).drop("_s")


def flag_sources(rows: DataFrame) -> DataFrame:
    """Each source says whether its URL could tell who the victim is; the URL itself stays."""
    return rows.withColumn("sources", F.transform("sources", lambda s: s.withField("url_carries_identifying_slug", F.when(codes.identifying_slug(s["url"]), F.lit(True)))))


def canonical_place(rows: DataFrame) -> DataFrame:
    """States and districts by their one code and name; an id whose state is no longer the record's is cleared."""
    state = codes.normalize_state(F.coalesce("state", F.lit("")))
    moved = F.col("id").startswith("CW-") & (F.length("id") >= 10) & (F.substring("id", 9, 2) != state) & (state != F.coalesce("state", F.lit("")))
    return rows.withColumns({"id": F.when(~F.coalesce(moved, F.lit(False)), F.col("id")), "state": state, "district": codes.canonical_district(F.col("district"))})


def finalize(rows: DataFrame, snapshots: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as they may be written: dates recovered, minors coerced, sanitised, cut to the schema, names withheld,
    sections and sources told by rule. What went through once comes out as it went in. ``keep`` names columns that
    stay beside them."""
    clean_ = sanitize(coerce_minor(recover_date(conform(rows, keep), snapshots)))
    return flag_sources(normalize_sections(withhold_names(conform(clean_, keep))))


def finalize_with(rows: DataFrame, *keep: str) -> DataFrame:
    """``finalize``, with the columns ``keep`` beside the record's."""
    return finalize(rows, keep=keep)
