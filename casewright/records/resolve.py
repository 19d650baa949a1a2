"""Which records are one case, and the one record made of them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from casewright.functions import codes, dates
from casewright.operators.durability import durable
from casewright.operators.resolve import STATUS_RANK, components, placements
from casewright.records import gates
from casewright.records.schema import NAMES, RECORD, listed

#: Fixed value: days within which two reports may tell of one case.
NEAR = 3
#: What a merged record takes from the other where the leading one has nothing.
FILLED = ("id", "cnr", "fir_ref", "court", "incident_reported_date", "summary", "category")


def anchor_keys() -> Column:
    """The exact keys of a record, ascending: its court number, and its station, number and year; none without either."""
    cnr = F.when(F.col("cnr") != "", F.concat(F.lit("cnr:"), F.upper(F.trim("cnr"))))
    station, number = F.lower(F.trim(F.coalesce("fir_ref.station", F.lit("")))), F.trim(F.coalesce("fir_ref.number", F.lit("")))
    reported = F.regexp_extract(F.coalesce("incident_reported_date", F.lit("")), r"^(\d{4})", 1)
    year = F.coalesce(F.nullif(F.regexp_extract(number, r"/(\d{4})\b", 1), F.lit("")), reported)
    return F.array_compact(F.array(cnr, F.when((station != "") & (number != ""), F.concat(F.lit("fir:"), station, F.lit("|"), number, F.lit("|"), year))))


def identity_keys() -> Column:
    """The exact keys, or else one key of state, district, date, sections and court, which tells courts apart."""
    text = lambda n: F.coalesce(n, F.lit(""))
    sections = F.array_join(F.array_sort(listed("offence_sections")), ",")
    anonymous = F.concat(F.lit("anon:"), F.concat_ws("|", text("state"), text("district"), text("incident_reported_date"), sections, F.lower(F.trim(text("court.name")))))
    exact = anchor_keys()
    return F.when(F.size(exact) > 0, exact).otherwise(F.array(anonymous))


def _higher(a: str | None, b: str | None) -> str | None:
    return b if STATUS_RANK.get(b, 0) > STATUS_RANK.get(a, 0) else a


def _official(record: dict) -> bool:
    return any(map(_of_court, record["sources"] or []))


def merge_records(a: dict, b: dict) -> dict:
    """One record of two. Court records lead, then higher confidence, then the first.

    Sources are joined by URL and timelines point into the joined list; sections and accused are joined too, the status
    is the one that got farther, and either one's verification and minor's flag hold.
    """
    lead, other = a, b
    if _official(a) != _official(b):
        lead, other = (a, b) if _official(a) else (b, a)
    elif (b["confidence"] or 0.0) > (a["confidence"] or 0.0):
        lead, other = b, a
    out = dict(lead)
    places: dict[str, int] = {}
    sources, moved = [], []
    for record in (lead, other):
        own = {}
        for k, s in enumerate(record["sources"] or []):
            if (url := s["url"] or "") not in places:
                places[url] = len(sources)
                sources.append(s)
            own[k] = places[url]
        moved.append(own)
    history = {}
    for record, own in zip((lead, other), moved, strict=True):
        for e in record["status_history"] or []:
            if (e["source"] or 0) in own:  # a point is never laid at another source's door
                place = own[e["source"] or 0]
                history.setdefault((e["status"], e["date"], place), {"status": e["status"], "date": e["date"], "source": place})
    accused: dict[str, dict] = {}
    for x in [*(lead["accused"] or []), *(other["accused"] or [])]:
        had = accused.get(x["label"] or "")
        if had is None:
            accused[x["label"] or ""] = dict(x)
        else:
            had["name_public_court_record"] = had["name_public_court_record"] or x["name_public_court_record"]
            had["status"] = _higher(had["status"], x["status"])
    out["sources"] = sources
    out["status"] = _higher(lead["status"], other["status"])
    out["confidence"] = max(lead["confidence"] or 0.0, other["confidence"] or 0.0)
    out["minor_involved"] = bool(lead["minor_involved"] or other["minor_involved"])
    if lead["verified"] or other["verified"]:
        out["verified"] = True
        out["verification_note"] = lead["verification_note"] or other["verification_note"] or out["verification_note"]
    for name, joined in (("offence_sections", list(dict.fromkeys([*(lead["offence_sections"] or []), *(other["offence_sections"] or [])]))), ("status_history", list(history.values())), ("accused", list(accused.values()))):
        out[name] = joined or out[name]
    for name in FILLED:
        out[name] = out[name] or other[name]
    return out


class Joined:
    """A list joined of records' lists, each key once: a leading record's entries go before what there is, others behind it."""

    def __init__(self):
        self.entries: dict = {}  # key: (place, entry)
        self.low, self.high = 0, 0

    def put(self, entries: dict, lead: bool) -> None:
        if lead:
            self.low -= len(entries)
            self.entries.update({key: (self.low + k, entry) for k, (key, entry) in enumerate(entries.items())})
        else:
            for key, entry in entries.items():
                if key not in self.entries:
                    self.entries[key] = self.high, entry
                    self.high += 1

    def keys(self) -> list:
        return sorted(self.entries, key=lambda key: self.entries[key][0])

    def values(self) -> list:
        return [entry for _, entry in sorted(self.entries.values(), key=lambda x: x[0])]


class Fold:
    """``merge_records`` of records that come one after the other, in time for each that depends on it alone.

    ``merge_records`` goes through all that was merged before; here the lists are built in place.
    """

    def __init__(self, first: dict):
        self.out, self.merged, self.courts = first, False, 0

    def _start(self) -> None:
        self.merged, r = True, self.out
        self.sources, self.history, self.accused, self.sections = Joined(), Joined(), Joined(), Joined()
        urls = [s["url"] or "" for s in r["sources"] or []]
        self.sources.put(new := _sources(r), False)
        self.courts = sum(map(_of_court, new.values()))
        self.history.put(_points(r["status_history"], urls), False)
        self.accused.put(_people(r["accused"]), False)
        self.sections.put(dict.fromkeys(r["offence_sections"] or []), False)

    def add(self, r: dict) -> None:
        a, new, court = self.out, _sources(r), _official(r)
        lead = court if court != (bool(self.courts) if self.merged else _official(a)) else (r["confidence"] or 0.0) > (a["confidence"] or 0.0)
        if not self.merged:
            self._start()
        first, other = (r, a) if lead else (a, r)
        raw = a["status_history"]
        if raw and not self.history.entries:  # points of no source of theirs, which the sources since may have given one
            had = self.sources.keys() if any(0 <= (e["source"] or 0) < len(self.sources.entries) for e in raw) else []
            self.history.put(_points(raw, had), False)
        for url, s in new.items():
            had = self.sources.entries.get(url)
            if had is None or lead:
                self.courts += _of_court(s) - (had is not None and _of_court(had[1]))
        self.sources.put(new, lead)
        self.history.put(_points(r["status_history"], [s["url"] or "" for s in r["sources"] or []]), lead)
        self.sections.put(dict.fromkeys(r["offence_sections"] or []), lead)
        if lead:
            people = _people(r["accused"])
            self.accused.put({label: _person(x, self.accused.entries[label][1]) if label in self.accused.entries else x for label, x in people.items()}, True)
        else:
            for x in r["accused"] or []:
                label = x["label"] or ""
                if label in self.accused.entries:
                    place, had = self.accused.entries[label]
                    self.accused.entries[label] = place, _person(had, x)
                else:
                    self.accused.put({label: dict(x)}, False)
        out = dict(first)
        out["status"] = _higher(first["status"], other["status"])
        out["confidence"] = max(first["confidence"] or 0.0, other["confidence"] or 0.0)
        out["minor_involved"] = bool(first["minor_involved"] or other["minor_involved"])
        if first["verified"] or other["verified"]:
            out["verified"] = True
            out["verification_note"] = first["verification_note"] or other["verification_note"] or out["verification_note"]
        for name in FILLED:
            out[name] = out[name] or other[name]
        self.out = out

    def record(self) -> dict:
        if not self.merged:
            return self.out
        places = {url: k for k, url in enumerate(self.sources.keys())}
        history = [{"status": status, "date": day, "source": places[url]} for status, day, url in self.history.keys()]
        lists = {"offence_sections": self.sections.keys(), "status_history": history, "accused": self.accused.values()}
        return self.out | {"sources": self.sources.values()} | {name: joined for name, joined in lists.items() if joined}


def _of_court(source: dict) -> bool:
    return any(part in (source["publisher"] or "").lower() for part in codes.OFFICIAL)


def _sources(r: dict) -> dict:
    """The record's sources by URL, each first one."""
    out: dict = {}
    for s in r["sources"] or []:
        out.setdefault(s["url"] or "", s)
    return out


def _points(history: list | None, urls: list) -> dict:
    """The points of a timeline whose source is there, as keys: status, date, URL."""
    return {(e["status"], e["date"], urls[e["source"] or 0]): None for e in history or [] if 0 <= (e["source"] or 0) < len(urls)}


def _person(had: dict, x: dict) -> dict:
    return had | {"name_public_court_record": had["name_public_court_record"] or x["name_public_court_record"], "status": _higher(had["status"], x["status"])}


def _people(accused: list | None) -> dict:
    """The accused by label."""
    out: dict = {}
    for x in accused or []:
        label = x["label"] or ""
        out[label] = _person(out[label], x) if label in out else dict(x)
    return out


def folded(rows: DataFrame, group: str, order: str) -> DataFrame:
    """(group, order, members, *record): a record for each group, its members merged one after the other by ``order``.

    order is the first member's. A group of any size passes through one task, record by record.
    """
    schema = StructType([rows.schema[group], rows.schema[order], StructField("members", rows.schema[order].dataType), *RECORD])

    def each(batches):
        head, fold, members, kept = None, None, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                record = {n: r[n] for n in NAMES}
                if fold is None or r[group] != head[group]:
                    if fold is not None:
                        kept.append({**fold.record(), **head, "members": members})
                    head, fold, members = {group: r[group], order: r[order]}, Fold(record), 1
                else:
                    fold.add(record)
                    members += 1
            if len(kept) >= 1024:
                yield _batch(kept, schema)
                kept = []
        if fold is not None:
            kept.append({**fold.record(), **head, "members": members})
        if kept:
            yield _batch(kept, schema)

    return rows.select(group, order, *NAMES).repartition(group).sortWithinPartitions(group, order).mapInArrow(each, schema)


def _batch(rows: list[dict], schema: StructType) -> pa.RecordBatch:
    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_pylist([{f.name: r[f.name] for f in schema} for r in rows], schema=kinds)


def _told() -> list[Column]:
    """What tells whether two records are one case."""
    return [anchor_keys().alias("anchors"), "district", dates.strict_day(F.col("incident_reported_date")).alias("day"), listed("offence_sections").alias("sections"), F.col("court.name").alias("court")]


def dedupe(rows: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(published, review): one record for each case, and the records that a human must see, with reason.

    What tells an age or a person, cites no section in scope or has little confidence is reviewed and takes no part.
    The others go in their ``order``: a record joins the first cluster with an exact or strong match; a weak match
    alone is ambiguous (``operators.resolve.placements``). Each cluster is folded from its first record on.
    """
    marked = durable(rows.withColumn("reason", gates.review_reason()))  # read several times below
    kept, held = marked.where("reason is null").drop("reason"), marked.where("reason is not null")
    told = durable(placements(kept.select(F.col(order).alias("node"), *_told()), NEAR)).withColumnRenamed("node", "o")
    placed = kept.join(told, F.col(order) == F.col("o")).drop("o")
    ambiguous = placed.where("cluster is null").drop("cluster").withColumn("reason", F.lit("ambiguous_match"))
    return folded(placed.where("cluster is not null"), "cluster", order).drop("cluster"), held.unionByName(ambiguous)


def merged_by_url(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Approved records that share a source's URL as one record each; URLs are compared without blanks around, empty ones not at all."""
    urls = F.filter(F.transform(listed("sources"), lambda s: F.trim(F.coalesce(s["url"], F.lit("")))), lambda u: u != "")
    same = components(rows.select(F.col(order).alias("node"), F.explode(urls).alias("key")))
    return folded(rows.join(same, F.col(order) == F.col("node"), "left").withColumn("component", F.coalesce("component", order)), "component", order).drop("component")


def candidate_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, days_apart, shared_sections, shared_accused): ids of records that might be one case and share no anchor.

    They agree in state, district and category, are told by the day at most ``NEAR`` days apart, and share a section or
    a named accused. Days are dealt into bands, so that only neighbouring bands meet.
    """
    tidy = lambda n: F.lower(F.trim(n))
    day = dates.strict_day(F.col("incident_reported_date"))
    lowered = lambda values: F.array_sort(F.array_distinct(F.filter(F.transform(values, lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))), lambda x: x != "")))
    base = rows.where("id <> ''").select("id", tidy("state").alias("state"), tidy("district").alias("district"), tidy("category").alias("category"), day.alias("day"), anchor_keys().alias("anchors"), lowered(listed("offence_sections")).alias("sections"), lowered(F.transform(listed("accused"), lambda a: a["name_public_court_record"])).alias("accused"), F.floor(F.unix_date(day) / (NEAR + 1)).alias("band"))
    base = base.where("day is not null and state <> '' and district <> '' and category <> ''")
    a = base.select(*[F.col(c).alias(f"a_{c}") for c in base.columns])
    b = base.select(*[F.col(c).alias(f"b_{c}") for c in base.columns if c != "band"], F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("b_band"))
    apart, sections, accused = F.abs(F.datediff("a_day", "b_day")), F.array_intersect("a_sections", "b_sections"), F.array_intersect("a_accused", "b_accused")
    same = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("state", "district", "category", "band")]
    met = a.join(b, [*same, F.col("a_id") < F.col("b_id"), apart <= NEAR, ~F.arrays_overlap("a_anchors", "b_anchors"), F.arrays_overlap("a_sections", "b_sections") | F.arrays_overlap("a_accused", "b_accused")])
    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), apart.alias("days_apart"), sections.alias("shared_sections"), accused.alias("shared_accused"))


def candidate_clusters(rows: DataFrame) -> DataFrame:
    """(cluster, ids, n_pairs): connected sets of ``candidate_pairs``, named by their least id; a human decides on them."""
    pairs = candidate_pairs(rows)
    edge = F.concat_ws("\x1f", "a", "b")
    sets = components(pairs.select(F.explode(F.array("a", "b")).alias("node"), edge.alias("key")))
    count = pairs.join(sets, F.col("a") == F.col("node")).groupBy("component").agg(F.count("*").alias("n_pairs"))
    return sets.groupBy(F.col("component").alias("cluster")).agg(F.array_sort(F.collect_list("node")).alias("ids")).join(count, F.col("cluster") == F.col("component")).select("cluster", "ids", "n_pairs")


def combine(base: DataFrame, staged: DataFrame, merge: Callable[[DataFrame, str, str], DataFrame] = folded) -> DataFrame:
    """Carried records joined to those there are, by id: both merged where both have it, the base's first; others as they are."""
    both = base.select(*NAMES, F.lit(0).alias("_from")).unionByName(staged.select(*NAMES, F.lit(1).alias("_from"))).withColumn("_n", F.monotonically_increasing_id())
    group = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.concat(F.lit("\x1f"), F.col("_n").cast("string")))
    return merge(both.withColumns({"_group": group, "_order": F.col("_from") * F.lit(1 << 62) + F.col("_n")}), "_group", "_order").select(NAMES)
