"""The record's type, which is also the list of what a record may hold, and its JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, StringType, StructField, StructType

_TEXT, _LIST = StringType(), ArrayType(StringType())


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


#: The fields of a record, in the schema's order.
RECORD = _struct(
    id=_TEXT, cnr=_TEXT, fir_ref=_struct(station=_TEXT, number=_TEXT), state=_TEXT, district=_TEXT, incident_reported_date=_TEXT, offence_sections=_LIST, unparsed_sections=_LIST, category=_TEXT, minor_involved=BooleanType(), status=_TEXT,
    accused_count=IntegerType(), repeat_offence=BooleanType(), weapon_or_threat=BooleanType(), institutional_actions=_LIST, sentence_years=IntegerType(),
    status_history=ArrayType(_struct(status=_TEXT, date=_TEXT, source=IntegerType())), accused=ArrayType(_struct(label=_TEXT, name_public_court_record=_TEXT, status=_TEXT)), court=_struct(name=_TEXT, next_hearing=_TEXT),
    days_since_reported=IntegerType(), title=_TEXT, summary=_TEXT, sources=ArrayType(_struct(url=_TEXT, publisher=_TEXT, retrieved=_TEXT, source_type=_TEXT, url_carries_identifying_slug=BooleanType(), archive_url=_TEXT)),
    confidence=DoubleType(), first_published=_TEXT, last_status_change=_TEXT, verified=BooleanType(), verification_note=_TEXT, corrected=BooleanType(), traced_to_court=_TEXT, incident_date_provenance=_TEXT,
)
#: An id: the year and state that it was minted in, and its number there.
ID = r"^CW-(\d{4})-([A-Z]{2})-(\d{6})$"
NAMES = RECORD.fieldNames()


def _fitted(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` with just the nested fields that ``want`` has, in its order; lacking ones are null."""
    if isinstance(want, StructType):
        if not isinstance(have, StructType):
            return F.lit(None).cast(want)
        kinds = {f.name: f.dataType for f in have}
        parts = [(_fitted(value[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType):
        if not isinstance(have, ArrayType):
            return F.lit(None).cast(want)
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    return value if have == want else value.try_cast(want) if not isinstance(have, (StructType, ArrayType)) else F.lit(None).cast(want)


def conform(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The record's fields and no others, at every depth; lacking ones are null, ill-typed values too. ``keep`` names columns that stay beside them."""
    kinds = {f.name: f.dataType for f in rows.schema}
    own = [(_fitted(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in RECORD]
    return rows.select(*keep, *own)


def to_json(names: list[str] | None = None) -> Column:
    """A record's JSON: null fields are left out, but an accused's withheld name is an explicit null."""
    names = NAMES if names is None else names
    rest = F.to_json(F.struct(*[n for n in names if n != "accused"]))
    if "accused" not in names:
        return rest
    accused = F.to_json("accused", {"ignoreNullFields": "false"})
    more = F.concat(F.substring(rest, 1, 1), F.lit('"accused":'), accused, F.when(rest == "{}", "").otherwise(","), F.substring(rest, 2, 1 << 30))
    return F.when(F.size("accused") > 0, more).otherwise(rest)


def from_json(text: Column) -> Column:
    """A record from its JSON; fields that no record has are dropped, unreadable text is null."""
    return F.from_json(text, RECORD)


def empty(of: str) -> Column:
    """An empty list of the type of the field ``of``."""
    return F.array().cast(RECORD[of].dataType)


def listed(name: str) -> Column:
    """The list field ``name``, empty for null."""
    return F.coalesce(F.col(name), empty(name))


def id_part(which: int, record_id: Column | None = None) -> Column:
    """Of a well-formed id its year (1), state (2) or serial (3); null for anything else."""
    return F.nullif(F.regexp_extract(F.col("id") if record_id is None else record_id, ID, which), F.lit(""))
