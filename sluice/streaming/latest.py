"""Streams over the event log: latest state by key, windowed counts (extras), and replay to completion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream with event time as TIMESTAMP."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a file stream needs a folder or a pattern; the pattern matches the table, be it a file or a folder
    files = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return files.withColumn("ts", F.col("ts").cast("timestamp"))


def latest_actions(events: DataFrame) -> DataFrame:
    """Last event type of each user; ties by event_id. Complete or update mode."""
    return events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("action"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    counted = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def first_deliveries(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Each event once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def replayed(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """Run the stream over what is there and return the sink's rows: of all micro-batches, or in complete mode of the last.

    Micro-batches are written as files in the shared folder, each by its number, so that one that is tried again replaces itself.
    """
    path, done = f"{work_folder(spark)}/replay-{uuid.uuid4().hex}", []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/{number}")
        done.append(number)

    run = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    numbers = sorted(set(done))[-1:] if mode == "complete" else sorted(set(done))
    if not numbers:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(f"{path}/rows/{n}" for n in numbers))
