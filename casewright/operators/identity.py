"""Stable identifiers, collisions, and change between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casewright.functions import dates
from casewright.operators.ordering import serials


def mint(cases: DataFrame, prior: DataFrame, run_date: str, prefix: str = "CW") -> DataFrame:
    """(ord, id, minted): a case takes over the id of its anchor, else mints the next serial of its year and state.

    ``prior``: (cnr, id, year, state, serial) of all ids ever given. Of new cases with one anchor the first mints and
    the others share its id. Serials are never given twice, since counting starts at the highest prior one.
    """
    rows = cases.select("ord", "cnr", "state", dates.year_of(F.col("incident_reported_date"), run_date).alias("year"))
    known = prior.groupBy("cnr").agg(F.min("id").alias("known"))
    rows = rows.join(known, "cnr", "left")
    own = Window.partitionBy(F.coalesce("cnr", F.concat(F.lit("ord:"), F.col("ord").cast("string"))))
    rows = rows.withColumn("first", F.min("ord").over(own))
    minting = rows.where((F.col("ord") == F.col("first")) & F.col("known").isNull())
    top = prior.groupBy("year", "state").agg(F.max("serial").alias("top"))
    made = serials(minting, "ord").join(top, ["year", "state"], "left").withColumn("serial", F.coalesce("top", F.lit(0)) + F.col("serial"))
    made = made.select(F.col("first").alias("f"), F.concat_ws("-", F.lit(prefix), "year", "state", F.lpad(F.col("serial").cast("string"), 6, "0")).alias("new"))
    return rows.join(made, F.col("first") == F.col("f"), "left").select("ord", F.coalesce("known", "new").alias("id"), (F.col("known").isNull() & (F.col("ord") == F.col("first"))).alias("minted"))


def keep_best(rows: DataFrame, key: str, *order) -> DataFrame:
    """The best row of each key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def material_change(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, change): new, gone, changed or same, by the columns that matter (nulls equal nulls)."""
    sign = lambda df, name: df.select(F.col(key), F.struct(*columns).alias(name))
    rows = sign(before, "was").join(sign(after, "now"), key, "full")
    return rows.select(key, F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("was").eqNullSafe(F.col("now")), "same").otherwise("changed").alias("change"))


def ledger_step(ledger: DataFrame, outcomes: DataFrame, run_date: str, most: int = 3) -> DataFrame:
    """The ledger after a run: (url_hash, outcome, attempts, first_seen, last_seen); the third failure is permanent."""
    new = outcomes.select(F.sha2("url", 256).alias("url_hash"), F.col("outcome").alias("new")).groupBy("url_hash").agg(F.max("new").alias("new"))
    rows = ledger.join(new, "url_hash", "full")
    attempts = F.coalesce("attempts", F.lit(0)) + F.when(F.col("new") == "failed", 1).otherwise(0)
    outcome = F.when(F.col("new").isNull(), F.col("outcome")).when((F.col("new") == "failed") & (attempts >= most), "failed_permanent").otherwise(F.col("new"))
    return rows.select("url_hash", outcome.alias("outcome"), attempts.cast("int").alias("attempts"), F.coalesce("first_seen", F.lit(run_date)).alias("first_seen"), F.when(F.col("new").isNotNull(), F.lit(run_date)).otherwise(F.col("last_seen")).alias("last_seen"))


def with_transition(now: DataFrame, prior: DataFrame, run_date: str, key: str = "id") -> DataFrame:
    """``now`` with its status_history (status, date, source) one point longer where the status is not the prior one's.

    An empty history first gets the prior status, dated by its last change or its publication. Dates of cases with a
    minor are months. ``prior``: (key, status, last_status_change, first_published), one row for a case at most.
    """
    old = prior.select(key, F.col("status").alias("_was"), F.coalesce("last_status_change", "first_published", F.lit(run_date)).alias("_since"))
    rows = now.join(old, key, "left")
    shown = lambda d: F.when(F.coalesce("minor_involved", F.lit(True)), F.substring(d, 1, 7)).otherwise(d)
    kind = now.schema["status_history"].dataType
    point = lambda status, d: F.array(F.struct(status.alias("status"), shown(d).alias("date"), F.lit(0).alias("source"))).cast(kind)
    had = F.coalesce("status_history", F.array().cast(kind))
    seeded = F.when(F.size(had) == 0, point(F.col("_was"), F.col("_since"))).otherwise(had)
    last = F.try_element_at(seeded, F.lit(-1))["status"]
    longer = F.when(last.eqNullSafe(F.col("status")), seeded).otherwise(F.concat(seeded, point(F.col("status"), F.lit(run_date))))
    moved = F.col("_was").isNotNull() & ~F.col("_was").eqNullSafe(F.col("status"))
    return rows.withColumn("status_history", F.when(moved, longer).otherwise(F.col("status_history"))).drop("_was", "_since")


def stamps(now: DataFrame, prior: DataFrame, run_date: str, columns: list[str], key: str = "id") -> DataFrame:
    """``now`` with first_published (once and for all), last_status_change (the run's date only if one of ``columns`` differs) and change: new, material or rechecked."""
    old = prior.select(key, F.struct(*columns).alias("_old"), F.col("first_published").alias("_first"), F.col("last_status_change").alias("_last"))
    rows = now.join(old, key, "left")
    new, same = F.col("_old").isNull(), F.col("_old").eqNullSafe(F.struct(*columns))
    return rows.withColumns(
        {"first_published": F.coalesce("_first", F.lit(run_date)), "last_status_change": F.when(~new & ~same, F.lit(run_date)).otherwise(F.col("_last")), "change": F.when(new, "new").when(same, "rechecked").otherwise("material")}
    ).drop("_old", "_first", "_last")


def high_water(marks: DataFrame, ids: DataFrame) -> DataFrame:
    """(year, state, serial): the greatest serial ever given in each slot; it never falls, even when cases go."""
    return marks.select("year", "state", "serial").union(ids.select("year", "state", "serial")).groupBy("year", "state").agg(F.max("serial").alias("serial"))


def fates(docs: DataFrame, held: DataFrame, published: DataFrame, staged: DataFrame, pending: DataFrame, key: str = "url") -> DataFrame:
    """(key, outcome) of each document: held before published before staged before pending, else what ``docs`` says."""
    rows = docs.select(key, "outcome")
    out = F.lit(None).cast("string")
    for name, those in reversed([("held", held), ("published", published), ("staged_pending", staged), ("pending", pending)]):
        rows = rows.join(those.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
        out = F.when(F.col(f"_{name}"), name).otherwise(out)
    return rows.select(key, F.coalesce(out, "outcome").alias("outcome"))
