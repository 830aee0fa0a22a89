"""Rows that come too late for a windowed operator, counted into a table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.session import scratch_path
from reefgrid.streaming.run import WATERMARK

_LATE = "operator string, n_rows bigint, n_late bigint, mark_us bigint"


def count_late(events: DataFrame, ends: dict[str, Column], out: str, checkpoint: str, watermark: str = WATERMARK) -> None:
    """For every batch of a stream, how many of its rows each operator drops.

    ``ends`` has for each operator the end of what a row belongs to: it is dropped
    once the watermark, the newest ``ts`` of all batches before less ``watermark``,
    has reached that. Rows are counted one by one, before anything is added up. A
    batch writes ``late/batch_id=`` and its watermark in folders of its own, so a
    repeated batch leaves the same rows, and a restarted stream goes on from them.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id:
            before = spark.read.schema("newest_us bigint").parquet(f"{out}/marks/batch_id={batch_id - 1}").first()[0]
        batch.persist()
        try:
            delay = F.expr(f"interval {watermark}")
            mark = F.timestamp_micros(F.lit(before).cast("bigint")) - delay
            row = batch.agg(
                F.count(F.lit(1)).alias("n_rows"), F.unix_micros(F.max("ts")).alias("newest"), F.unix_micros(F.max(mark)).alias("mark"),
                *[F.count_if(F.coalesce(end <= mark, F.lit(False))).alias(name) for name, end in ends.items()]).first()
            rows = [(name, row["n_rows"], row[name], row["mark"]) for name in ends]
            spark.createDataFrame(rows, _LATE).coalesce(1).write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
            newest = max((t for t in (before, row["newest"]) if t is not None), default=None)
            spark.createDataFrame([(newest,)], "newest_us bigint").coalesce(1).write.mode("overwrite").parquet(f"{out}/marks/batch_id={batch_id}")
        finally:
            batch.unpersist()

    events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


def run_late(events: DataFrame, ends: dict[str, Column], label: str = "late") -> DataFrame:
    """``(operator, batch_id, n_rows, n_late, mark_us)`` for what has arrived."""
    base = scratch_path(events.sparkSession, label)
    count_late(events, ends, os.path.join(base, "out"), os.path.join(base, "state"))
    return events.sparkSession.read.schema(_LATE + ", batch_id int").parquet(os.path.join(base, "out", "late"))
