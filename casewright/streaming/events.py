"""Streams over the event table: deduplication and windows with watermarks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.operators.durability import shared_folder


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/events.parquet*")  # a pattern, as a stream takes no single file
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """All that the stream yields for the input there is, as a table in the folder that all executors share.

    Each batch has a folder of its own, which it replaces, so that a batch that runs again doesn't count twice; in
    complete mode every batch is the whole result and replaces the one before.
    """
    at = f"{shared_folder(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    write = lambda batch, k: batch.write.mode("overwrite").parquet(f"{at}/rows/batch={0 if mode == 'complete' else k}")
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/rows/*")


def distinct_users(events: DataFrame) -> DataFrame:
    """Each pair of user and event type once, the state bounded by the watermark."""
    return events.withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type")


def hourly(events: DataFrame, size: str = "1 day") -> DataFrame:
    """Counts and sums of each window and event type, late events up to the watermark included."""
    w = F.window("ts", size)
    return events.withWatermark("ts", "2 days").groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
