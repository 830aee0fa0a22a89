"""Stage sessions kept in state: open ones come out with every batch, closed ones leave the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reefgrid.streaming.run import WATERMARK, run_update

SESSION_KEYS = ["run_id", "stage", "start_us"]
_OUT = "run_id bigint, stage string, start_us bigint, end_us bigint, n_events bigint, closed boolean"
_STATE = "starts array<bigint>, lasts array<bigint>, counts array<bigint>"


def merged(sessions: np.ndarray, gap: int) -> np.ndarray:
    """Rows ``(start, last, count)``, sorted, those less than ``gap`` apart made one."""
    if not len(sessions):
        return sessions
    sessions = sessions[np.argsort(sessions[:, 0], kind="stable")]
    last = np.maximum.accumulate(sessions[:, 1])
    first = np.flatnonzero(np.concatenate([[True], sessions[1:, 0] - last[:-1] >= gap]))
    return np.column_stack([sessions[first, 0], np.maximum.reduceat(sessions[:, 1], first), np.add.reduceat(sessions[:, 2], first)])


def _step(gap: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.array(state.get, np.int64).T.reshape(-1, 3) if state.exists else np.zeros((0, 3), np.int64)
        now = held
        if not state.hasTimedOut:
            for batch in batches:
                ts = batch["us"].to_numpy(np.int64)
                now = merged(np.concatenate([now, merged(np.column_stack([ts, ts, np.ones(len(ts), np.int64)]), gap)]), gap)
        # Rows behind the watermark do not get here, so what ended before it can no longer grow.
        passed = state.getCurrentWatermarkMs() * 1000
        closed = now[:, 1] + gap <= passed
        known = {tuple(s) for s in held.tolist()}
        rows = [(*key, s[0], s[1] + gap, s[2], bool(c)) for s, c in zip(now.tolist(), closed) if c or tuple(s) not in known]
        # A session that an earlier one has taken in leaves an empty row under its start.
        rows += [(*key, start, start, 0, True) for start in set(held[:, 0].tolist()) - set(now[:, 0].tolist())]
        left = now[~closed]
        if len(left):
            state.update(tuple(left[:, i].tolist() for i in range(3)))
            state.setTimeoutTimestamp(max(int(left[:, 1].min() + gap), passed + 1000) // 1000 + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
    return run


def session_updates(events: DataFrame, gap_seconds: int = 7200, watermark: str = WATERMARK) -> DataFrame:
    """Changed sessions of each stage of each run, ``(run_id, stage, start_us, end_us, n_events, closed)``, for update mode.

    A session comes out whenever it grows and once more, ``closed``, when the
    watermark has passed its end; one that was merged into an earlier one comes
    out with no events. A key's state holds its open sessions only.
    """
    rows = events.withWatermark("ts", watermark).select(
        F.col("run_id").cast("bigint").alias("run_id"), "stage", "ts", F.unix_micros("ts").alias("us"))
    return rows.groupBy("run_id", "stage").applyInPandasWithState(
        _step(gap_seconds * 1_000_000), _OUT, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def run_sessions(events: DataFrame, label: str = "sessions", gap_seconds: int = 7200) -> DataFrame:
    """All sessions of what has arrived, open ones included."""
    return run_update(session_updates(events, gap_seconds), label, SESSION_KEYS).filter("n_events > 0")
