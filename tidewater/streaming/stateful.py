"""User function on keyed state: the open hook for state updates that no
plan of built-in operators expresses.

``SessionStream`` in ``tidewater.streaming.sessions`` is the form to use
for sessions. Here the same rule is written as an
``applyInPandasWithState`` function on event time: a key's state is dropped
when the watermark passes its last request plus the timeout, and Spark
filters requests behind the watermark, so its delay must cover the lateness
of the input. All rows of a key and batch meet in one call.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from tidewater.operators.sessions import CLICKSTREAM_MAX, SESSION_TIMEOUT_S

OUTPUT_SCHEMA = ("ip string, event_id long, ts timestamp, session_start timestamp, "
                 "session_length long, clickstream array<string>")
STATE_SCHEMA = "n long, start_us long, last_us long, clicks array<string>"


def _session_fn(timeout_s: int, keep_max: int):
    T = timeout_s * 1_000_000

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        frames = [p for p in pdfs if len(p)]
        if not frames:
            return
        rows = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        us = rows["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
        eid = rows["event_id"].to_numpy()
        order = np.lexsort((eid, us))               # (ts, event_id) order
        us, eid = us[order], eid[order]
        urls = rows["url"].to_numpy()[order].tolist()
        if state.exists:
            n, start, last, clicks = state.get
            clicks = list(clicks)
        else:
            n, start, last, clicks = 0, None, None, []
        m = len(us)
        # gaps, and each row's place behind its last gap, without a loop over rows
        prev = np.append(us[0] - T - 1 if last is None else last, us[:-1])
        before = np.maximum.accumulate(prev)
        new = us - before > T
        first = np.maximum.accumulate(np.where(new, np.arange(m), -1))
        out_n = np.where(first >= 0, np.arange(m) - first, np.arange(m) + n) + 1
        out_start = np.where(first >= 0, us[first], us[0] if start is None else start)
        out_clicks = [(urls[f:min(i + 1, f + keep_max)] if f >= 0 else (clicks + urls[:i + 1])[:keep_max])
                      for i, f in enumerate(first.tolist())]
        n, start, clicks = int(out_n[-1]), int(out_start[-1]), out_clicks[-1]
        last = int(max(us[-1], us[-1] if last is None else last))
        state.update((n, start, last, clicks))
        state.setTimeoutTimestamp(max(last // 1000 + timeout_s * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({
            "ip": np.full(m, key[0], dtype=object),
            "event_id": eid,
            "ts": us.astype("datetime64[us]"),
            "session_start": out_start.astype("datetime64[us]"),
            "session_length": out_n,
            "clickstream": out_clicks,
        })

    return fn


def sessions_with_state(requests: DataFrame, watermark: str = "0 seconds", timeout_s: int = SESSION_TIMEOUT_S,
                        keep_max: int = CLICKSTREAM_MAX) -> DataFrame:
    """Per request: running session state of its ip. ``requests`` is a
    streaming DataFrame with ip, event_id, ts (timestamp), url."""
    return (requests.withWatermark("ts", watermark).groupBy("ip")
            .applyInPandasWithState(_session_fn(timeout_s, keep_max), OUTPUT_SCHEMA, STATE_SCHEMA,
                                    "append", GroupStateTimeout.EventTimeTimeout))
