"""Sessions by key in Spark's own keyed state.

A ``StatefulProcessor`` holds, per key, the open session (a value state) and,
while a batch is at work, the rows of a busy key (a map state). A key's rows
come in chunks of an Arrow batch. If there is one chunk, it is put in order
and run through; of more, up to ``held_rows`` rows are held and put in order.
A key with more rows has each such run set aside in order, ``PIECE_ROWS`` rows a
piece, in the map state, which the state store keeps on disk; the runs are then
merged, a piece of each at a time, and run through by blocks of ``block_s``
(short ones together). So a call holds a run, or a piece of every run and a block,
and the state store is called once a piece, not once a block and chunk.

``emit="requests"`` gives out the running session at every request;
``emit="ended"`` a row per session, when it is over: a request comes more than
the timeout after the one before, or a timer goes off. Timers follow the
watermark (``time_mode="EventTime"``: the session's last request lies more than
the timeout behind it) or the clock (``"ProcessingTime"``: no request of the key
was read for so long). ``ttl_s`` also lets the state store forget a session that
was not touched for so long by the clock, without giving it out: a bound for
state whose timers never come to anything, to be set far above the timeout
and the time a trigger takes. With ``"None"`` the newest session of every key
stays, which is what ``open_sessions`` reads from the state store.

A request older than its key's last one joins the session open at that time;
one older than the watermark is dropped by Spark (event time only).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewater.operators.sessions import CLICKSTREAM_MAX, SESSION_TIMEOUT_S
from tidewater.operators.windows import US
from tidewater.streaming.live_windows import with_keyed_state

BLOCK_S = 300
HELD_ROWS = 200_000  # of a key, held in a call
PIECE_ROWS = 1000    # of a run set aside; also of blocks run through together
REQUEST = "{key}, event_id long, ts timestamp, session_start timestamp, session_length long, clickstream array<string>"
ENDED = "{key}, session_start timestamp, session_end timestamp, session_length long, clickstream array<string>"


class SessionProcessor(StatefulProcessor):
    def __init__(self, key: str = "ip", timeout_s: int = SESSION_TIMEOUT_S, keep_max: int = CLICKSTREAM_MAX,
                 emit: str = "requests", time_mode: str = "None", block_s: int = BLOCK_S, ttl_s: int | None = None,
                 held_rows: int = HELD_ROWS):
        if ttl_s is not None and time_mode != "ProcessingTime":
            raise ValueError("state has a time to live only by the clock")
        self.ttl_ms = None if ttl_s is None else ttl_s * 1000
        self.key, self.timeout, self.keep_max = key, timeout_s * US, keep_max
        self.emit, self.time_mode, self.block, self.held_rows = emit, time_mode, block_s * US, held_rows

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "n long, start long, last long, seen long, clicks array<string>", self.ttl_ms)
        self.aside = handle.getMapState("aside", "block long, part long", "us array<long>, ids array<long>, urls array<string>")

    # -- one ordered run of requests ------------------------------------------------------------
    def _advance(self, key, us: np.ndarray, ids: np.ndarray, urls: np.ndarray, seen: int) -> pd.DataFrame:
        """The rows that these requests (of one key) give out; the open session moves on."""
        order = np.lexsort((ids, us))
        us, ids, urls = us[order], ids[order], urls[order].tolist()
        n, start, last, _, clicks = self.open.get() if self.open.exists() else (0, None, None, None, [])
        clicks, m = list(clicks), us.size
        before = np.maximum.accumulate(np.append(us[0] - self.timeout - 1 if last is None else last, us[:-1]))
        new = us - before > self.timeout
        begin = np.maximum.accumulate(np.where(new, np.arange(m), -1))  # where each request's session begins here
        length = np.where(begin >= 0, np.arange(m) - begin, np.arange(m) + n) + 1
        since = np.where(begin >= 0, us[begin], us[0] if start is None else start)

        def first_urls(i: int) -> list[str]:
            b = int(begin[i])
            return urls[b:min(i + 1, b + self.keep_max)] if b >= 0 else (clicks + urls[:i + 1])[:self.keep_max]
        if self.emit == "requests":
            out = self._requests(key, us, ids, since, length, [first_urls(i) for i in range(m)])
        else:
            over = np.flatnonzero(new)
            if n == 0:
                over = over[1:]  # the first of these requests ends no session
            out = self._ended(key, [start if i == 0 else since[i - 1] for i in over], before[over],
                              [n if i == 0 else length[i - 1] for i in over], [clicks if i == 0 else first_urls(i - 1) for i in over])
        newest = int(max(us[-1], before[-1])) if last is not None else int(us[-1])
        self.open.update((int(length[-1]), int(since[-1]), newest, seen, first_urls(m - 1)))
        return out

    def _requests(self, key, us, ids, since, length, clicks) -> pd.DataFrame:
        return pd.DataFrame({self.key: pd.Series([key[0]] * us.size, dtype=object), "event_id": ids, "ts": us.astype("datetime64[us]"),
                             "session_start": since.astype("datetime64[us]"), "session_length": length, "clickstream": clicks})

    def _ended(self, key, start, end, length, clicks) -> pd.DataFrame:
        return pd.DataFrame({self.key: pd.Series([key[0]] * len(start), dtype=object),
                             "session_start": np.array(start, np.int64).astype("datetime64[us]"),
                             "session_end": np.array(end, np.int64).astype("datetime64[us]"),
                             "session_length": np.array(length, np.int64), "clickstream": pd.Series(clicks, dtype=object)})

    # -- Spark's calls -----------------------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues):
        seen = timerValues.getCurrentProcessingTimeInMs() if self.time_mode == "ProcessingTime" else 0
        chunks = (self._columns(part) for part in rows if len(part))
        first = next(chunks, None)
        if first is None:
            return
        second = next(chunks, None)
        if second is None:
            yield self._advance(key, *first, seen)
        else:
            held, size, pieces = [first, second], len(first[0]) + len(second[0]), []
            del first, second
            for chunk in chunks:
                if size >= self.held_rows:
                    self._set_aside(self._ordered(held), pieces)
                    held, size = [], 0
                held.append(chunk)
                size += len(chunk[0])
            run = self._ordered(held)
            del held
            if pieces:
                self._set_aside(run, pieces)
                del run
                yield from self._run_through(key, self._merged(pieces), seen)
            else:
                yield from self._run_through(key, [(run, None)], seen)
        self._watch(timerValues)

    def _columns(self, part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (part["ts"].to_numpy().astype("datetime64[us]").astype(np.int64), part["event_id"].to_numpy(np.int64),
                part["url"].to_numpy(object))

    def _ordered(self, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        us, ids, urls = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((ids, us))
        return us[order], ids[order], urls[order]

    def _set_aside(self, run, pieces: list[tuple[int, int]]) -> None:
        """Put an ordered run into the map state; ``pieces`` gets the first time and the number of each piece."""
        us, ids, urls = run
        for a in range(0, us.size, PIECE_ROWS):
            own = slice(a, a + PIECE_ROWS)
            pieces.append((int(us[a]), len(pieces)))
            self.aside.updateValue((int(us[a]) // self.block, pieces[-1][1]), (us[own].tolist(), ids[own].tolist(), urls[own].tolist()))

    def _merged(self, pieces: list[tuple[int, int]]):
        """The rows set aside, in order, as the pieces are taken by their first times: what
        is held after each, and the time from which more may come (None: no more)."""
        pieces = sorted(pieces)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        for i, (start, n) in enumerate(pieces):
            us, ids, urls = self.aside.getValue((start // self.block, n))
            self.aside.removeKey((start // self.block, n))
            held = self._ordered([held, (np.array(us, np.int64), np.array(ids, np.int64), np.array(urls, object))])
            until = pieces[i + 1][0] if i + 1 < len(pieces) else None
            yield held, until
            if until is not None:  # what is past was run through: whole blocks
                a = int(np.searchsorted(held[0], until // self.block * self.block))
                held = tuple(c[a:] for c in held)

    def _run_through(self, key, runs, seen: int) -> Iterator[pd.DataFrame]:
        """Advance by the whole blocks that are held, short ones together."""
        for (us, ids, urls), until in runs:
            stop = us.size if until is None else int(np.searchsorted(us, until // self.block * self.block))
            cuts = [*(np.flatnonzero(np.diff(us[:stop] // self.block)) + 1).tolist(), stop]
            a = 0
            for b, after in zip(cuts, [*cuts[1:], None]):
                if b > a and (after is None or after - a > PIECE_ROWS):
                    yield self._advance(key, us[a:b], ids[a:b], urls[a:b], seen)
                    a = b

    def _watch(self, timerValues) -> None:
        """A timer for the time at which the open session will be over."""
        _, _, last, seen, _ = self.open.get()
        if self.time_mode == "EventTime":
            self.handle.registerTimer((last + self.timeout) // 1000 + 1)
        elif self.time_mode == "ProcessingTime":
            self.handle.registerTimer(seen + self.timeout // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.open.exists():
            return
        n, start, last, seen, clicks = self.open.get()
        if self.time_mode == "EventTime":
            over = timerValues.getCurrentWatermarkInMs() > (last + self.timeout) // 1000
        else:
            over = timerValues.getCurrentProcessingTimeInMs() >= seen + self.timeout // 1000
        if over:  # else a request has come since the timer was set
            self.open.clear()
            if self.emit == "ended":
                yield self._ended(key, [start], [last], [n], [list(clicks)])

    def close(self) -> None:
        pass


def keyed_sessions(requests: DataFrame, key: str = "ip", emit: str = "requests", time_mode: str = "None",
                   watermark: str = "0 seconds", **options) -> DataFrame:
    """Streaming sessions of streaming ``requests`` (key, event_id, ts as
    timestamp, url)."""
    with_keyed_state(requests.sparkSession)
    rows = requests.select(key, "event_id", "ts", "url").where(F.col("ts").isNotNull())
    if time_mode == "EventTime":
        rows = rows.withWatermark("ts", watermark)
    kind = f"`{key}` {requests.schema[key].dataType.simpleString()}"
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=SessionProcessor(key, emit=emit, time_mode=time_mode, **options),
        outputStructType=(REQUEST if emit == "requests" else ENDED).format(key=kind), outputMode="Update", timeMode=time_mode)


def open_sessions(spark: SparkSession, checkpoint: str, key: str = "ip", batch_id: int | None = None) -> DataFrame:
    """The open session of every key after a batch (the last), read from the
    state store of a query's checkpoint; the query need not run."""
    reader = spark.read.format("statestore").option("stateVarName", "open")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return _as_sessions(reader.load(checkpoint), key)


def session_changes(spark: SparkSession, checkpoint: str, first_batch: int = 0, key: str = "ip") -> DataFrame:
    """What each batch changed in the open sessions, from the state store's
    change feed: batch_id, change_type (update or delete) and the session."""
    feed = (spark.read.format("statestore").option("stateVarName", "open").option("readChangeFeed", "true")
            .option("changeStartBatchId", first_batch).load(checkpoint))
    return _as_sessions(feed, key, "batch_id", "change_type")


def _as_sessions(state: DataFrame, key: str, *more: str) -> DataFrame:
    at = {name: F.timestamp_micros(F.col(f"value.{c}")).cast("timestamp_ntz") for name, c in (("session_start", "start"), ("session_end", "last"))}
    return state.select(*more, F.col(f"key.{key}").alias(key), *[c.alias(n) for n, c in at.items()],
                        F.col("value.n").alias("session_length"), F.col("value.clicks").alias("clickstream"))
