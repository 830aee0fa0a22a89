"""Running a stream over what has arrived, into tables that survive retries."""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from reefgrid.operators.ranks import last_by_key
from reefgrid.session import scratch_path

WATERMARK = "10 minutes"


class LateRows(StreamingQueryListener):
    """Counts rows dropped for being later than the watermark, per query."""

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        n = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        with self._lock:
            self.dropped[str(event.progress.runId)] = self.dropped.get(str(event.progress.runId), 0) + n

    def onQueryTerminated(self, event):
        pass


def read_stream(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A file-source stream; ``ts`` is turned into a timestamp that watermarks accept."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.load(folder)
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def append_to(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append-mode results to Parquet (exactly once), for all data available now."""
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()


def upsert_to(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Update-mode results: each batch's changed rows in a folder of its own.

    A repeated batch overwrites its folder, so retries leave no duplicates.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(put).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Newest row per key of an upserted table."""
    return last_by_key(spark.read.parquet(out), keys, ["batch_id"]).drop("batch_id")


def run_append(stream: DataFrame, label: str) -> DataFrame:
    base = scratch_path(stream.sparkSession, label)
    append_to(stream, os.path.join(base, "out"), os.path.join(base, "state"))
    return stream.sparkSession.read.schema(stream.schema).parquet(os.path.join(base, "out"))


def run_update(stream: DataFrame, label: str, keys: list[str]) -> DataFrame:
    base = scratch_path(stream.sparkSession, label)
    upsert_to(stream, os.path.join(base, "out"), os.path.join(base, "state"))
    return latest(stream.sparkSession, os.path.join(base, "out"), keys)
