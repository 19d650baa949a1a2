"""Stages that ask an external model through an injected client: budgets, retries, answers, verdicts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

#: The fields that a verifier may correct.
CORRECTABLE = ["state", "district", "status", "category", "offence_sections", "incident_reported_date", "court", "cnr", "fir_ref"]
#: Outcomes of asking about one document.
ANSWERS = "url string, outcome string, answer string, tokens long, error string"


def running_sum(rows: DataFrame, order: str, value: Column, name: str, band: int = 1 << 16) -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows before, by the whole number ``order``.

    Rows are summed up in bands of ``order`` first, so no task sees more than one band and only a row for each band
    meets in one window.
    """
    banded = rows.withColumns({"_v": F.coalesce(value, F.lit(0)), "_band": F.floor(F.col(order) / band)})
    sums = banded.groupBy("_band").agg(F.sum("_v").alias("_s"))
    starts = sums.select("_band", F.coalesce(F.sum("_s").over(Window.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    own = F.coalesce(F.sum("_v").over(Window.partitionBy("_band").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return banded.join(starts, "_band").withColumn(name, F.col("_start") + own).drop("_v", "_band", "_start")


def budgeted(rows: DataFrame, order: str, cost: Column, cap: float) -> DataFrame:
    """``rows`` with ``asked``: whether less than ``cap`` was spent before; the row that reaches the cap still is.

    Once the cap is reached nothing later is asked, however cheap.
    """
    return running_sum(rows, order, cost, "_spent").withColumn("asked", F.col("_spent") < cap).drop("_spent")


def ask(client, prompt: str, retries: int = 2, base: float = 1.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str, int]:
    """The client's (answer, tokens); after a failure it is asked again, with waits that double."""
    for n in range(retries + 1):
        try:
            return client.generate(prompt)
        except Exception:
            if n == retries:
                raise
            sleep(min(base * 2**n, longest))
    raise AssertionError


def answers(docs: DataFrame, make_clients: Callable[[], list], prompt: Column, stop_after: int = 5, until: float | None = None, clock: Callable[[], float] = time.time, **how) -> DataFrame:
    """(url, outcome, answer, tokens, error) for each of ``docs``; outcome is answered, failed or, after the time ``until``
    (seconds of ``clock``), not_asked, so that a run ends in time and the rest is asked about in the next one.

    ``make_clients`` builds a task's clients, which are tried in order. A client that fails ``stop_after`` times on
    end is not asked again in its task. Without a client left, documents fail and can be asked about next time.
    """

    def each(frames: Iterable[pd.DataFrame]):
        clients = [[c, 0] for c in make_clients()]
        for frame in frames:
            out = []
            for url, p in zip(frame["url"], frame["prompt"], strict=True):
                row = (url, "failed", None, 0, "no client left")
                if until is not None and clock() >= until:
                    out.append((url, "not_asked", None, 0, "out of time"))
                    continue
                for entry in clients:
                    if entry[1] >= stop_after:
                        continue
                    try:
                        got, tokens = ask(entry[0], p, **how)
                        entry[1], row = 0, (url, "answered", got, tokens, None)
                        break
                    except Exception as e:  # any failure of a provider counts, whatever its type
                        entry[1], row = entry[1] + 1, (url, "failed", None, 0, f"{type(e).__name__}: {str(e)[:160]}")
                out.append(row)
            yield pd.DataFrame(out, columns=[f.split()[0] for f in ANSWERS.split(", ")])

    return docs.select("url", prompt.alias("prompt")).mapInPandas(each, ANSWERS)


def first_object(text: str | None) -> str | None:
    """The first balanced ``{...}`` of a text, braces inside strings not counting."""
    depth, begin, quoted, k = 0, -1, False, 0
    text = text or ""
    while k < len(text):
        c = text[k]
        if quoted and c == "\\":
            k += 1
        elif c == '"':
            quoted = not quoted
        elif not quoted and c == "{":
            begin, depth = (k, 1) if depth <= 0 else (begin, depth + 1)
        elif not quoted and c == "}":
            depth -= 1
            if depth == 0:
                return text[begin : k + 1]
        k += 1
    return None


@F.pandas_udf(StringType())
def json_object(texts: pd.Series) -> pd.Series:
    """The first JSON object in each text, null without one."""
    return texts.map(first_object)


def verdict(answer: Column) -> Column:
    """struct(parsed, verified, note, second_url, second_publisher, corrections) of a verifier's answer.

    Only a real ``true`` verifies, never a string or number. A second source needs an http(s) URL.
    """
    v = F.coalesce(F.try_parse_json(answer), F.try_parse_json(json_object(answer)))
    text = lambda path: F.try_variant_get(v, path, "string")
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))
    url = F.trim(text("$.second_source.url"))
    web = F.lower(url).rlike("^https?://")
    corrections = F.when(kind("$.corrections").startswith("OBJECT"), F.to_json(F.try_variant_get(v, "$.corrections", "variant")))
    return F.struct(
        F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)).alias("parsed"), ((kind("$.verified") == "BOOLEAN") & F.coalesce(F.try_variant_get(v, "$.verified", "boolean"), F.lit(False))).alias("verified"),
        F.substring(F.coalesce(text("$.verification_note"), F.lit("")), 1, 300).alias("note"), F.when(web, url).alias("second_url"),
        F.when(web, F.coalesce(text("$.second_source.publisher"), F.lit("corroborating source"))).alias("second_publisher"), corrections.alias("corrections"),
    )


def apply_verdicts(cases: DataFrame, verdicts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``cases`` with the corrected values of those ``columns`` that may be corrected, verified, verification_note and incomplete.

    ``verdicts``: (key, verdict), one for a case at most. A case without a parsed verdict is unverified and incomplete: it is held, never dropped.
    """
    rows = cases.join(verdicts.select(key, F.col("verdict").alias("_v")), key, "left")
    parsed = F.coalesce(F.col("_v.parsed"), F.lit(False))
    fixed = {c: F.coalesce(F.when(parsed, F.get_json_object("_v.corrections", f"$.{c}")).try_cast(cases.schema[c].dataType), F.col(c)) for c in columns if c in CORRECTABLE}
    return rows.withColumns({**fixed, "verified": parsed & F.col("_v.verified"), "verification_note": F.when(parsed, F.nullif(F.col("_v.note"), F.lit(""))), "incomplete": ~parsed}).withColumn("verified", F.coalesce("verified", F.lit(False))).drop("_v")


def cost_usd(tokens_in: Column, tokens_out: Column, per_million_in: float, per_million_out: float) -> Column:
    return F.round(tokens_in / 1e6 * per_million_in + tokens_out / 1e6 * per_million_out, 6)
