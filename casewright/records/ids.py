"""Permanent ids, and what changed since the last run."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.functions import codes, dates
from casewright.operators.durability import durable
from casewright.operators.ordering import serials
from casewright.operators.resolve import components
from casewright.records import gates
from casewright.records.resolve import identity_keys
from casewright.records.schema import ID, NAMES, id_part, listed, to_json


def signature() -> Column:
    """What a change of makes a record materially other: status, court, sections, accused and severity, however ordered and written."""
    sections = F.array_sort(F.transform(codes.normalize_sections(listed("offence_sections"))["canonical"], F.lower))
    text = lambda c: F.coalesce(c, F.lit(""))
    accused = F.array_sort(F.transform(listed("accused"), lambda a: F.struct(text(a["label"]).alias("label"), text(a["name_public_court_record"]).alias("name"), text(a["status"]).alias("status"))))
    return F.struct(text("status").alias("status"), F.lower(F.trim(text("court.name"))).alias("court"), sections.alias("sections"), accused.alias("accused"), text(codes.severity(listed("offence_sections"))).alias("severity"))


def earliest_source() -> Column:
    """The least day on which one of the record's sources was fetched, null without one."""
    return F.array_min(F.filter(F.transform(listed("sources"), lambda s: F.trim(s["retrieved"])), lambda d: d != ""))


def minted(rows: DataFrame, prior: DataFrame, run_date: str, marks: DataFrame | None = None, reserve: DataFrame | None = None, order: str = "ord") -> DataFrame:
    """(order, id, minted): every record's permanent id.

    A record that has a well-formed id keeps it. Another takes the id of the first of its ``identity_keys`` that a
    record of ``prior``, or else one of ``rows`` with an id, has. What is left mints the next serial of its year and
    state by ``order``, unless one of its keys belongs to a record that minted before it: then it takes that one's id.
    Serials start after the greatest of ``prior``, ``rows``, ``marks`` (year, state, serial) and ``reserve`` (id), so
    that none is ever given twice. Records with equal keys are one in all this, so that a key that many share is cheap.
    """
    own = durable(rows.select(F.col(order).alias("o"), "id", "state", dates.year_of(F.coalesce("incident_reported_date", F.lit("")), run_date).alias("year"), identity_keys().alias("keys")))
    has = F.coalesce(F.col("id").rlike(ID), F.lit(False))
    owners = prior.where(F.col("id").rlike(ID)).select("id", identity_keys().alias("keys"), F.lit(0).alias("rank"), F.monotonically_increasing_id().alias("o")).union(own.where(has).select("id", "keys", F.lit(1), "o"))
    known = owners.select(F.explode("keys").alias("key"), "rank", "o", "id").groupBy("key").agg(F.min(F.struct("rank", "o", "id"))["id"].alias("owner"))
    sets = own.where(~has).groupBy("keys").agg(F.min("o").alias("o"))
    found = sets.select("keys", F.posexplode("keys").alias("place", "key")).join(known, "key").groupBy("keys").agg(F.sort_array(F.collect_list(F.struct("place", "owner"))).alias("found"))
    sets = durable(sets.join(found, "keys", "left")).withColumn("owner", F.when(F.get("found", F.lit(0))["place"] == 0, F.get("found", F.lit(0))["owner"]))
    # sets whose first key has an owner follow it and own nothing; the others may follow one that mints before them
    open_ = sets.where("owner is null").select("o", "keys", "found")
    groups = components(open_.select(F.col("o").alias("node"), F.explode("keys").alias("key")))

    def each(table: pa.Table) -> pa.Table:
        """In order: a set of keys follows the owner of the first of them that has one, else it mints; followers own nothing."""
        owner: dict[str, int] = {}
        out = []
        for r in sorted(table.to_pylist(), key=lambda r: r["o"]):
            there = {f["place"]: f["owner"] for f in r["found"] or ()}
            lead, old = None, None
            for k, key in enumerate(r["keys"]):
                lead, old = owner.get(key), there.get(k)
                if old is not None or lead is not None:
                    break
            if old is None and lead is None:
                lead = r["o"]
                for key in r["keys"]:
                    owner.setdefault(key, lead)
            out.append((r["o"], None if old is not None else lead, old))
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["s", "lead", "old"])

    leads = open_.join(groups, F.col("o") == F.col("node")).select("o", "keys", "found", "component").groupBy("component").applyInArrow(each, "s long, lead long, old string")
    sets = sets.join(leads, F.col("o") == F.col("s"), "left").select("keys", F.coalesce("owner", "old").alias("owner"), "lead")
    placed = own.withColumn("_has", has).join(sets, "keys", "left")
    serial = lambda df: df.select(id_part(1).alias("year"), id_part(2).alias("state"), id_part(3).cast("int").alias("serial")).where("serial is not null")
    tops = serial(prior).union(serial(own))
    if marks is not None:
        tops = tops.union(marks.select("year", "state", F.col("serial").cast("int")))
    if reserve is not None:
        tops = tops.union(serial(reserve))
    tops = tops.groupBy("year", "state").agg(F.max("serial").alias("top"))
    new = placed.where("not _has and owner is null and o = lead").select("o", "year", "state")
    made = serials(new, "o").join(tops, ["year", "state"], "left")
    name = F.concat_ws("-", F.lit("CW"), "year", "state", F.lpad((F.coalesce("top", F.lit(0)) + F.col("serial")).cast("string"), 6, "0"))
    made = made.select(F.col("o").alias("m"), name.alias("new"))
    out = placed.join(made, F.col("lead") == F.col("m"), "left")
    return out.select(F.col("o").alias(order), F.coalesce(F.when(F.col("_has"), F.col("id")), "owner", "new").alias("id"), F.coalesce(~F.col("_has") & F.col("owner").isNull() & (F.col("o") == F.col("lead")), F.lit(False)).alias("minted"))


def stamped(rows: DataFrame, prior: DataFrame, run_date: str) -> DataFrame:
    """``rows`` (with their ids) with first_published, last_status_change, status_history, traced_to_court,
    days_since_reported, and change: new, material or rechecked; traced says whether a court was first seen in this run.

    first_published is written once: the prior one, else, of a record that was there without one, its earliest source;
    a new record's own or the run's date. last_status_change moves only with the ``signature``; a new status also makes
    a point of the timeline, after a first one for the prior status if there was none. Minors' points are months.
    """
    old = prior.where("id is not null").select("id", signature().alias("_sig"), F.col("first_published").alias("_first"), F.col("last_status_change").alias("_last"), F.col("traced_to_court").alias("_traced"), gates.court_source().alias("_court"), earliest_source().alias("_early"), F.col("status").alias("_status")).withColumn("_old", F.lit(True))
    now = rows.join(old.dropDuplicates(["id"]), "id", "left").withColumn("_now", signature())
    new, moved = F.col("_old").isNull(), F.col("_old") & ~F.col("_sig").eqNullSafe(F.col("_now"))
    first = F.when(new, F.coalesce(F.nullif(F.col("first_published"), F.lit("")), F.lit(run_date))).otherwise(F.coalesce(F.nullif(F.col("_first"), F.lit("")), "_early", earliest_source(), F.lit(run_date)))
    shown = lambda d: F.when(F.coalesce("minor_involved", F.lit(False)), F.substring(d, 1, 7)).otherwise(d)
    history = listed("status_history")
    kind = rows.schema["status_history"].dataType
    point = lambda status, d: F.array(F.struct(status.alias("status"), shown(d).alias("date"), F.lit(0).alias("source"))).cast(kind)
    seeded = F.when(F.size(history) == 0, point(F.col("_status"), F.coalesce("_last", "_first", F.lit(run_date)))).otherwise(history)
    advanced = moved & ~F.col("_status").eqNullSafe(F.col("status"))
    longer = F.when(F.try_element_at(seeded, F.lit(-1))["status"].eqNullSafe(F.col("status")), seeded).otherwise(F.concat(seeded, point(F.col("status"), F.lit(run_date))))
    gained = F.col("_old") & F.col("_traced").isNull() & ~F.col("_court") & gates.court_source()
    out = {
        "first_published": first,
        "last_status_change": F.when(moved, F.lit(run_date)).when(~new, F.col("_last")),
        "status_history": F.when(advanced, longer).otherwise(F.col("status_history")),
        "traced_to_court": F.coalesce("_traced", F.when(gained, F.lit(run_date))),
        "days_since_reported": F.coalesce(dates.days_since(F.col("incident_reported_date"), run_date), "days_since_reported").cast("int"),
        "change": F.when(new, "new").when(moved, "material").otherwise("rechecked"),
        "traced": F.coalesce(gained, F.lit(False)),
    }
    return now.withColumns(out).select(*rows.columns, "change", "traced")


def change_counts(stamped_rows: DataFrame) -> DataFrame:
    """One row: new, material, rechecked, traced_to_court."""
    n = lambda c: F.count_if(F.col("change") == c).alias(c)
    return stamped_rows.agg(n("new"), n("material"), n("rechecked"), F.count_if("traced").alias("traced_to_court"))


def resolve_collisions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one record for each id, the others): court records first, then verified ones, then those with more fields, then by their JSON, the greatest first."""
    fields = sum((F.col(n).isNotNull().cast("int") for n in NAMES[1:]), F.col(NAMES[0]).isNotNull().cast("int"))
    rank = Window.partitionBy("id").orderBy(F.desc("_c"), F.desc("_v"), F.desc("_f"), F.desc("_j"))
    told = rows.withColumns({"_c": gates.court_source(), "_v": F.coalesce("verified", F.lit(False)), "_f": fields, "_j": to_json()}).withColumn("_r", F.row_number().over(rank)).drop("_c", "_v", "_f", "_j")
    return told.where("_r = 1").drop("_r"), told.where("_r > 1").drop("_r")


def high_water(marks: DataFrame, rows: DataFrame) -> DataFrame:
    """(year, state, serial): the greatest serial ever given in each slot; it never falls."""
    given = rows.select(id_part(1).alias("year"), id_part(2).alias("state"), id_part(3).cast("int").alias("serial")).where("serial is not null")
    return marks.select("year", "state", "serial").union(given).groupBy("year", "state").agg(F.max("serial").alias("serial"))
