"""Streams equal their batch form; late rows are dropped and counted."""

import time

from pyspark.sql import functions as F

from reefgrid.streaming import progress, resources
from reefgrid.streaming.late import count_late
from reefgrid.streaming.run import LateRows, append_to, latest, read_stream, run_append, run_update, upsert_to
from reefgrid.streaming.sessions import SESSION_KEYS, session_updates

EVENTS = "event_id bigint, run_id bigint, stage string, counter bigint, ts timestamp"
STAGES = ["FEATURE_EXTRACTION", "MATCHING", "COMPLETE"]


def events(spark, n, start=0):
    i = F.col("id")
    return spark.range(start, start + n).select(
        i.alias("event_id"), (i % 3).alias("run_id"), F.element_at(F.array(*map(F.lit, STAGES)), (i % 5 % 3 + 1).cast("int")).alias("stage"),
        F.when(i % 7 != 0, i).alias("counter"), F.timestamp_seconds(i * 37).alias("ts"),
    )


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_update_streams_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for k in range(3):
        put(events(spark, 100, k * 100), folder)
    stream = lambda: read_stream(spark, folder, EVENTS, files_per_batch=1)
    batch = events(spark, 300)
    assert same(run_update(progress.progress(stream()), "p", ["run_id"]), progress.progress(batch))
    assert same(run_update(progress.current_stage(stream()), "s", ["run_id"]), progress.current_stage(batch))
    assert same(run_update(progress.error_state(stream()), "e", ["run_id"]), progress.error_state(batch))


def test_a_stream_continues_where_it_stopped(spark, tmp_path):
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    for k in range(2):
        put(events(spark, 80, k * 80), folder)
        upsert_to(progress.progress(read_stream(spark, folder, EVENTS)), out, state)
    assert same(latest(spark, out, ["run_id"]), progress.progress(events(spark, 160)))


def test_closed_windows_and_sessions_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for k in range(3):
        put(events(spark, 120, k * 120), folder)
    batch = events(spark, 360)
    newest = batch.agg(F.max("ts") - F.expr("interval 10 minutes")).scalar()
    stream = lambda: read_stream(spark, folder, EVENTS, files_per_batch=1)
    got = run_append(progress.stage_sessions(stream(), "3 minutes"), "x")
    assert same(got, progress.stage_sessions(batch, "3 minutes").filter(F.col("end") <= newest)) and got.count()
    as_gpu = lambda df: df.select("ts", F.col("stage").alias("label"), F.col("event_id").alias("used_mib"))
    got = run_append(resources.gpu_windows(as_gpu(stream()), "5 minutes", "1 minute"), "g")
    assert same(got, resources.gpu_windows(as_gpu(batch), "5 minutes", "1 minute").filter(F.col("end") <= newest)) and got.count()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    listener = LateRows()
    spark.streams.addListener(listener)
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    sample = "ts timestamp, label string, used_mib bigint"
    for ids in ([1, 100_000], [2, 200_000]):
        put(spark.createDataFrame([(i,) for i in ids], "i bigint").select(
            F.timestamp_seconds("i").alias("ts"), F.lit("a").alias("label"), F.col("i").alias("used_mib")), folder)
        append_to(resources.gpu_windows(read_stream(spark, folder, sample)), out, state)
    for _ in range(50):
        if sum(listener.dropped.values()):
            break
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert sorted(r.peak_mib for r in spark.read.parquet(out).collect()) == [1, 100_000]
    assert sum(listener.dropped.values()) == 1


def test_training_stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    lines = [(1, 1, "iter 10 max_iter=100 loss=0.9 it/s=3.0"), (1, 2, "iter 40 PSNR: 20.5"), (2, 1, "nothing")]
    put(spark.createDataFrame(lines, "run_id bigint, line_no bigint, line string"), folder)
    stream = read_stream(spark, folder, "run_id bigint, line_no bigint, line string")
    got = {r.run_id: r for r in run_update(resources.training_progress(stream), "t", ["run_id"]).collect()}
    assert (got[1].iteration, got[1].pct, got[1].eta_sec, got[1].psnr) == (40.0, 40, 20.0, 20.5)
    assert got[2].iteration is None and got[2].eta_sec is None


def test_quarantine(spark, tmp_path):
    folder, good, bad, state = (str(tmp_path / d) for d in ("in", "good", "bad", "state"))
    put(events(spark, 70), folder)
    progress.quarantine(read_stream(spark, folder, EVENTS), good, bad, state)
    assert spark.read.parquet(bad).count() == 10 and spark.read.parquet(good).count() == 60


def sessions_by_hand(rows, gap):
    """(run, stage, start_us, n) of rows (run, stage, seconds)."""
    out = []
    for key in {r[:2] for r in rows}:
        times = sorted(r[2] for r in rows if r[:2] == key)
        start = n = 0
        for i, t in enumerate(times):
            if i == 0 or t - times[i - 1] >= gap:
                if n:
                    out.append((*key, start * 1_000_000, (times[i - 1] + gap) * 1_000_000, n))
                start, n = t, 0
            n += 1
        out.append((*key, start * 1_000_000, (times[-1] + gap) * 1_000_000, n))
    return sorted(out)


def test_sessions_come_out_open_merge_and_survive_a_restart(spark, tmp_path):
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    schema = "run_id bigint, stage string, ts timestamp"
    batches = [
        [(1, "A", 1000), (1, "A", 1050), (1, "A", 1300), (2, "B", 1000)],
        [(1, "A", 1140), (1, "A", 1220), (2, "B", 1099)],  # joins two sessions into one; 99 seconds are within the gap
        [(1, "A", 90_000), (2, "B", 1199)],  # 100 seconds are not
        [(1, "A", 90_010), (1, "A", 200)],  # 200 is far behind the watermark
        [(3, None, 95_000)],
    ]
    seen = []
    for rows in batches:
        put(spark.createDataFrame(rows, "run_id bigint, stage string, s bigint").select("run_id", "stage", F.timestamp_seconds("s").alias("ts")), folder)
        seen += [r for r in rows if r[2] != 200]
        # Each call is a new run of the stream over its checkpoint.
        upsert_to(session_updates(read_stream(spark, folder, schema), 100, "10 minutes"), out, state)
        now = latest(spark, out, SESSION_KEYS).filter("n_events > 0")
        got = sorted((r.run_id, r.stage, r.start_us, r.end_us, r.n_events) for r in now.filter("stage IS NOT NULL").collect())
        assert got == sessions_by_hand([r for r in seen if r[1]], 100)
    rows = latest(spark, out, SESSION_KEYS).collect()
    assert [r.n_events for r in rows if r.start_us == 1300_000_000] == [0]  # taken in by an earlier session
    assert {(r.start_us // 1_000_000, r.closed) for r in rows if r.n_events} >= {(1000, True), (90_000, True), (95_000, False)}
    assert [r.n_events for r in rows if r.run_id == 3] == [1]


def test_late_rows_are_counted_per_operator_and_batch(spark, tmp_path):
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    ends = {"minutes": F.date_trunc("minute", "ts") + F.expr("interval 1 minute"), "quick": F.col("ts")}
    for seconds in ([0, 10_000], [9_390, 9_400, 9_430, 20_000, None], [5, 19_399, 19_400]):
        put(spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts")), folder)
        count_late(read_stream(spark, folder, "ts timestamp"), ends, out, state)
    rows = spark.read.parquet(out + "/late").collect()
    found = {(r.operator, r.batch_id): (r.n_rows, r.n_late) for r in rows}
    assert found == {
        ("minutes", 0): (2, 0), ("quick", 0): (2, 0), ("minutes", 1): (5, 1), ("quick", 1): (5, 2), ("minutes", 2): (3, 1), ("quick", 2): (3, 3)}
