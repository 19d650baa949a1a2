"""Places in an order without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casewright.operators.durability import durable


def placed(rows: DataFrame, name: str) -> DataFrame:
    """Sorted ``rows`` with their place, 1, 2, ..., in the order that they come in.

    A sort leaves ranges of rows in partitions that follow each other, so a row's place is its place in its partition
    after all rows of the partitions before; only a row for each partition meets in a window.
    """
    numbered = durable(rows.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sums = numbered.groupBy(part.alias("_p")).agg(F.count("*").alias("_c"))
    starts = sums.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    return numbered.withColumn("_p", part).join(F.broadcast(starts), "_p").select(*rows.columns, (F.col("_s") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name))


def serials(rows: DataFrame, order: str, band: int = 1 << 16) -> DataFrame:
    """``rows`` (order, year, state) with serial: 1, 2, ... within each year and state, by the whole number ``order``.

    Rows are counted in bands of ``order`` first, so that a slot with most of the rows fills many tasks; only a row for
    each slot and band meets in a window.
    """
    banded = rows.withColumn("_band", F.floor(F.col(order) / band))
    sums = banded.groupBy("year", "state", "_band").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("year", "state").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("year", "state", "_band").orderBy(order))
    return banded.join(sums.select("year", "state", "_band", before.alias("_start")), ["year", "state", "_band"]).withColumn("serial", (F.col("_start") + own).cast("int")).drop("_band", "_start")
