"""Guards over what is about to be published: scans of JSON for personal data, size limits, cross-checks."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from casewright.functions import text as texts
from casewright.functions.persons import AGES, OCCUPATIONS, occupation_spans

#: Names of fields that no record may have.
FORBIDDEN = (
    "victim", "victim_name", "victim_age", "victim_address", "survivor", "survivor_name", "complainant_name", "accused_victim_relation", "address", "home_address", "family", "family_members",
    "father_name", "mother_name", "guardian", "guardian_name", "relative", "school", "school_name", "college", "workplace", "employer", "employer_name", "photo", "photograph", "image", "image_url",
    "phone", "mobile", "contact", "contact_number", "email", "aadhaar", "aadhar", "pan", "dob", "date_of_birth", "birth_date", "latitude", "longitude", "gps", "geo", "coordinates",
)
#: Parts of a name that forbid it too.
FORBIDDEN_PARTS = ("victim", "survivor")
#: Fields of free text.
PROSE = ("title", "summary")
#: Fields that no correction may set.
PROTECTED = ("id", "minor_involved")
_PII = {n: re.compile(p) for n, p in texts.PII.items()}
_AGES = {n: re.compile(p, re.I) for n, p in AGES.items()}
_NATIVE = re.compile("[ऀ-ൿ]")
_OCCUPIED = re.compile("|".join(map(re.escape, OCCUPATIONS)), re.I)


def forbidden(name: str) -> bool:
    low = name.lower()
    return low in FORBIDDEN or any(p in low for p in FORBIDDEN_PARTS)


def may_override(name: str) -> bool:
    """Whether a correction may set the field."""
    return name.lower() not in PROTECTED and not forbidden(name)


def findings(value, path: str = "", published: bool = True):
    """(path, reason) of each forbidden name and each trace of a person in a JSON value; prose is searched more closely where it is to be published."""
    stack = [(value, path)]
    while stack:
        value, path = stack.pop()
        if isinstance(value, dict):
            for k, v in value.items():
                at = f"{path}.{k}" if path else str(k)
                if forbidden(str(k)):
                    yield at, "name"
                stack.append((v, at))
        elif isinstance(value, list):
            stack += [(v, f"{path}[{i}]") for i, v in enumerate(value)]
        elif isinstance(value, str):
            at = path or "<root>"
            yield from ((at, n) for n, p in _PII.items() if p.search(value))
            if published and _NATIVE.search(value):
                yield at, "native_script"
            if published and path.rsplit(".", 1)[-1] == "summary":
                yield from ((at, n) for n, p in _AGES.items() if p.search(value))
            if published and path.rsplit(".", 1)[-1] in PROSE and _OCCUPIED.search(value):
                yield from ((at, "occupation") for _ in occupation_spans(value))


_FOUND = StructType().add("path", StringType()).add("reason", StringType())


def _scan_type():
    class Scan:
        def eval(self, text: str, published: bool):
            if text is None:
                return
            try:
                value = json.loads(text)
            except ValueError:
                yield "<file>", "unreadable"
                return
            yield from findings(value, published=bool(published))

    return Scan


def scan_json(rows: DataFrame, payload: str, published: bool = True) -> DataFrame:
    """``rows`` without ``payload`` but with (path, reason) for each finding in its JSON; unreadable JSON is a finding, null is none."""
    scan = F.udtf(_scan_type(), returnType=_FOUND)
    return rows.lateralJoin(scan(F.col(payload).outer(), F.lit(published))).drop(payload)


def scan_diff(rows: DataFrame, line: str) -> DataFrame:
    """``rows`` with ``reasons``: the names of personal data in lines that a unified diff adds; only rows with some."""
    added = F.col(line).startswith("+") & ~F.col(line).startswith("+++")
    return rows.where(added).withColumn("reasons", texts.pii_hits(F.substring(line, 2, 1 << 30))).where(F.size("reasons") > 0)


def allowed_overrides(corrections: DataFrame, names: str) -> DataFrame:
    """The rows of (.., names) whose field a correction may set."""
    low = F.lower(names)
    out = low.isin(*PROTECTED, *FORBIDDEN)
    for part in FORBIDDEN_PARTS:
        out = out | low.contains(part)
    return corrections.where(~out)


def too_large(summary: DataFrame, most: int = 50 * 1024) -> Column:
    """Whether a row of ``summary`` is larger as JSON than a page may load."""
    return F.octet_length(F.to_json(F.struct(*summary.columns))) > most


def disagreements(total: DataFrame, **parts: DataFrame) -> DataFrame:
    """(part, total, found) for each named aggregate with a column n whose sum differs from ``total``'s n."""
    want = total.agg(F.sum("n").alias("total"))
    rows = None
    for name, part in parts.items():
        one = part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found")).select(F.lit(name).alias("part"), "found", F.lit(1).alias("_k"))
        rows = one if rows is None else rows.union(one)
    return rows.join(want.withColumn("_k", F.lit(1)), "_k").where("not (found <=> total)").select("part", "total", "found")


def silent(counts: DataFrame, processed: str, extracted: str, least: int = 50) -> DataFrame:
    """``counts``; reading it fails if over ``least`` documents went in and nothing came out."""
    fine = ~((F.col(processed) > least) & (F.col(extracted) == 0))
    return counts.withColumn("_ok", F.assert_true(fine, F.lit("documents were processed, but nothing was extracted"))).where("_ok is null").drop("_ok")
