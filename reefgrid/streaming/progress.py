"""Progress of runs: counters, current stage, stage sessions, failing events.

The same functions serve batch frames and streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.functions.names import stage_progress
from reefgrid.streaming.run import WATERMARK


def progress(events: DataFrame) -> DataFrame:
    """All counters of a run."""
    return events.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("counter").alias("total_counter"),
        F.count_if(F.col("stage") == "FEATURE_EXTRACTION").alias("n_features"),
        F.count_if(F.col("stage") == "MATCHING").alias("n_matches"), F.max("ts").alias("last_ts"),
    )


def current_stage(events: DataFrame) -> DataFrame:
    """The last stage a run wrote, how far along it is, and the run's elapsed seconds."""
    newest = F.struct("ts", "event_id")
    return events.groupBy("run_id").agg(
        F.max_by("stage", newest).alias("stage"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    ).select(
        "run_id", "stage", stage_progress(F.col("stage")).alias("pct"),
        (F.unix_seconds("last_ts") - F.unix_seconds("first_ts")).alias("elapsed_sec"),
    )


def stage_sessions(events: DataFrame, gap: str = "2 hours", watermark: str = WATERMARK) -> DataFrame:
    """Stretches of activity of each stage in each run, closed by a quiet gap."""
    if events.isStreaming:
        events = events.withWatermark("ts", watermark)
    # Bounds are aggregates, not fields of the window: a later filter on a field
    # of the grouping key would be pushed below the merging of sessions.
    return events.groupBy("run_id", "stage", F.session_window("ts", gap).alias("session")).agg(
        F.min("ts").alias("start"), (F.max("ts") + F.expr(f"interval {gap}")).alias("end"),
        F.count(F.lit(1)).alias("n_events"),
    ).drop("session")


def failing(events: DataFrame) -> DataFrame:
    """Events that cannot be counted: no counter or no known stage."""
    return events.filter(F.col("counter").isNull() | F.col("stage").isNull())


def error_state(events: DataFrame) -> DataFrame:
    """The last failing event of each run; it stays until a later one replaces it."""
    return failing(events).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_errors"), F.max("event_id").alias("last_error")
    )


def quarantine(events: DataFrame, good: str, bad: str, checkpoint: str) -> None:
    """Splits a stream into countable events and failing ones, batch by batch."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.filter(F.col("counter").isNotNull() & F.col("stage").isNotNull()).write.mode("overwrite").parquet(
            f"{good}/batch_id={batch_id}"
        )
        failing(batch).write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")
        batch.unpersist()

    events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(
        availableNow=True
    ).start().awaitTermination()
