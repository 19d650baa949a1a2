"""A training corpus from raw documents: good texts, without near copies, without repeated passages, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.llm import copies, packing, quality, suffix
from casewright.llm.common import durable, table

#: SQL has no such hashes, models or packing; the stages are tested against brute force instead.
ORACLE_SQL = None


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text the classifier, trained on the labels of ``docs``, accepts (a score of 0.7 or more).

    Null and empty texts, and texts of white space, have no features and get the score of the classifier's bias alone,
    near one half, so they go. Rows that repeat an id, or have none, are judged each by its own text.
    """
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: texts joined by links of a 5-word Jaccard similarity of 0.8 or more.

    The row of smallest id stays, rows without an id coming last, of equals the first as ``docs`` is read; so of rows
    that repeat an id and a text one stays, and a row whose text is another's stays whatever its id. Texts without
    words, null and empty ones included, are one group.
    """
    row = "row" + "_" * max(map(len, docs.columns))  # longer than any other name
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = copies.near_copies(numbered, row).select(F.col("id").alias(row), "component")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    ranked = durable(rows.join(numbered.select(row, "doc_id"), row).select(row, "component", place.alias("place")))
    least = ranked.groupBy("component").agg(F.min("place").alias("least"))
    others = ranked.join(least, "component").where("place <> least").select(row)
    return numbered.join(others, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; their texts lose each string of 100 bytes that begins earlier in the corpus, and what cuts leave of a
    character. Null texts become empty; rows without an id keep their text; n_chars is counted anew."""
    rest = {c: f"_carried{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    inner = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(name) for c, name in rest.items()])
    got = suffix.remove_repeats(inner, carry=tuple(rest.values()), whole_characters=True)
    text = F.col("kept").cast("string")
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")} | {c: F.col(name) for c, name in rest.items()}
    return got.select(*[made[c].alias(c) for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts packed into sequences of 2048, 8192 or 32768 bytes, with the boundaries of what each sequence holds.

    A null or empty text is a piece without tokens; rows that repeat an id are pieces of their own.
    """
    return packing.packed(docs)


STAGES = [("good_texts", good_texts), ("one_of_each", one_of_each), ("without_repeats", without_repeats), ("sequences", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else durable(docs), sf_dir)
    return docs
