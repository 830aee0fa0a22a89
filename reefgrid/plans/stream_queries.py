"""Streams over the events table, run to the end of the available data.

Windows and sessions that are still open at the end of the data come out too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey
from reefgrid.streaming import progress, resources
from reefgrid.session import scratch_path
from reefgrid.streaming.late import run_late
from reefgrid.streaming.run import read_stream, run_update
from reefgrid.streaming.sessions import run_sessions

query = Registry()

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _events(s: Survey):
    # A glob serves a single file as well as a folder of them.
    return read_stream(s.spark, f"{s.folder}/events.parque[t]", EVENTS)


@query("stream_progress", with_views("stage_events") + """
    SELECT run_id, count(*) AS n_events, CAST(sum(counter) AS BIGINT) AS total_counter, count(*) FILTER (stage = 'FEATURE_EXTRACTION') AS n_features,
           count(*) FILTER (stage = 'MATCHING') AS n_matches, epoch_us(max(ts)) AS last_us FROM stage_events GROUP BY 1""")
def stream_progress(s: Survey):
    counters = progress.progress(s.stage_events(_events(s)))
    return run_update(counters, "progress", ["run_id"]).withColumn("last_us", F.unix_micros("last_ts")).drop("last_ts")


@query("stream_stage", with_views("stage_events") + """
    SELECT run_id, arg_max(stage, ts) AS stage, CAST(floor(epoch_us(max(ts)) / 1000000) - floor(epoch_us(min(ts)) / 1000000) AS BIGINT) AS elapsed_sec FROM stage_events GROUP BY 1""")
def stream_stage(s: Survey):
    stages = progress.current_stage(s.stage_events(_events(s)))
    return run_update(stages, "stage", ["run_id"]).drop("pct")


GPU_SQL = with_views("gpu") + """
    SELECT label, epoch(start)::BIGINT AS start_sec, peak_mib, round(mean_mib, 4) AS mean_mib, n_samples FROM (
        SELECT label, {start} AS start, max(used_mib) AS peak_mib, avg(used_mib) AS mean_mib, count(*) AS n_samples FROM {source} GROUP BY 1, 2)"""


# Updates carry windows that are still open, so the last state of each holds all of them.
WINDOW_KEYS = ["label", "start", "end"]


def _windows(df):
    return df.select("label", F.unix_seconds("start").alias("start_sec"), "peak_mib", rnd("mean_mib", 4), "n_samples")


@query("stream_gpu_window", GPU_SQL.format(start="date_trunc('minute', ts)", source="gpu"))
def stream_gpu_window(s: Survey):
    return _windows(run_update(resources.gpu_windows(s.gpu_samples(_events(s))), "gpu", WINDOW_KEYS))


@query("stream_gpu_sliding", GPU_SQL.format(
    start="date_trunc('minute', ts) - to_minutes(back)", source="gpu, range(0, 5) t(back)"))
def stream_gpu_sliding(s: Survey):
    return _windows(run_update(resources.gpu_windows(s.gpu_samples(_events(s)), "5 minutes", "1 minute"), "gpu5", WINDOW_KEYS))


@query("stream_stage_sessions", with_views("stage_events") + """
    , g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM stage_events WINDOW w AS (PARTITION BY run_id, stage ORDER BY ts)),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY run_id, stage ORDER BY ts ROWS UNBOUNDED PRECEDING) AS grp FROM g)
    SELECT run_id, stage, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 7200000000 AS end_us, count(*) AS n_events FROM n GROUP BY run_id, stage, grp""")
def stream_stage_sessions(s: Survey):
    return run_sessions(s.stage_events(_events(s))).select("run_id", "stage", "start_us", "end_us", "n_events")


@query("stream_late_rows", """
    WITH b AS (SELECT *, CASE WHEN event_id % 10 < 7 THEN 0 WHEN event_id % 10 < 9 THEN 1 ELSE 2 END AS batch FROM events),
    m AS (SELECT batch, max(ts) AS newest FROM b GROUP BY 1),
    k AS (SELECT c.batch, max(p.newest) - INTERVAL 10 MINUTE AS mark FROM m c LEFT JOIN m p ON p.batch < c.batch GROUP BY 1),
    e AS (SELECT b.batch, mark, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS w, ts + INTERVAL 2 HOUR AS s FROM b JOIN k USING (batch))
    SELECT 'gpu_windows' AS operator, batch::INTEGER AS batch_id, count(*) AS n_rows, count(*) FILTER (w <= mark) AS n_late, epoch_us(max(mark)) AS mark_us FROM e GROUP BY batch
    UNION ALL SELECT 'stage_sessions', batch::INTEGER, count(*), count(*) FILTER (s <= mark), epoch_us(max(mark)) FROM e GROUP BY batch""")
def stream_late_rows(s: Survey):
    """The events arrive in three files, two of them after newer events; rows too late for a window or a session are counted."""
    folder = scratch_path(s.spark, "late-files")
    turn = F.when(F.col("event_id") % 10 < 7, 0).when(F.col("event_id") % 10 < 9, 1).otherwise(2)
    for batch in range(3):
        s.table("events").filter(turn == batch).coalesce(1).write.mode("append").parquet(folder)
    stream = read_stream(s.spark, folder, EVENTS, files_per_batch=1)
    ends = {"gpu_windows": F.date_trunc("minute", "ts") + F.expr("interval 1 minute"), "stage_sessions": F.col("ts") + F.expr("interval 2 hours")}
    return run_late(stream, ends)


@query("stream_training", """
    SELECT user_id % 10 AS run_id, max(event_id)::DOUBLE AS iteration,
           CAST((20 + max(event_id) FILTER (event_id % 4 = 0) % 15) || '.' || lpad(CAST(max(event_id) FILTER (event_id % 4 = 0) % 997 AS VARCHAR), 3, '0') AS DOUBLE) AS psnr,
           round((99999999999 - max(event_id)) / (max(event_id) % 150 + 1.5::DOUBLE), 2) AS eta_sec FROM events GROUP BY 1""")
def stream_training(s: Survey):
    latest = run_update(resources.training_progress(s.metric_lines(_events(s))), "training", ["run_id"])
    return latest.select("run_id", "iteration", "psnr", rnd("eta_sec", 2))


@query("stream_errors", """
    SELECT user_id % 10 AS run_id, count(*) AS n_errors, max(event_id) AS last_error FROM events WHERE event_id % 13 = 0 GROUP BY 1""")
def stream_errors(s: Survey):
    broken = F.when(F.col("event_id") % 13 == 0, "{oops").otherwise(F.col("props"))
    events = s.stage_events(_events(s).withColumn("props", broken))
    return run_update(progress.error_state(events), "errors", ["run_id"])
