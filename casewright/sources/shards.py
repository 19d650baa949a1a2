"""Cases as JSON files of bounded size in a folder for each year and state."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from casewright.functions import dates


def parted(rows: DataFrame, key: list, most: int) -> DataFrame:
    """``rows`` (with _year, _state and _size) in ranges of ``key``, with _part: the number of the file that a row goes to.

    A file holds rows of one year and state, in order, with at most ``most`` bytes or one row. Rows are dealt out by ranges,
    so a state with most of the rows fills many tasks; each task streams through its rows.
    """
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)

    def each(batches):
        first = TaskContext.get().partitionId() * 1_000_000
        part, slot, full = first - 1, None, 0
        for batch in batches:
            parts = []
            for year, state, n in zip(*(batch.column(c).to_pylist() for c in ("_year", "_state", "_size")), strict=True):
                if (year, state) != slot or full + n > most:
                    part, slot, full = part + 1, (year, state), 0
                full += n
                parts.append(part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.int64())], names=[*batch.schema.names, "_part"])

    return rows.mapInArrow(each, StructType([*rows.schema.fields]).add("_part", LongType()))


def write_shards(cases: DataFrame, path: str, run_date: str, most: int = 500 * 1024) -> None:
    """Replaces the files under ``path``, latest cases first within a file of at most ``most`` bytes (or one case)."""
    names = cases.columns
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))) + 1
    rows = cases.withColumns({"_year": dates.year_of(F.col("incident_reported_date"), run_date), "_state": F.coalesce("state", F.lit("UNKNOWN")), "_size": size})
    dealt = parted(rows, ["_year", "_state", F.desc("incident_reported_date"), "ord"], most).drop("_size")
    dealt.write.mode("overwrite").partitionBy("_year", "_state", "_part").json(path)


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    """All cases under ``path``; a broken file is an error, never a gap."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path + "/*/*/*")
