"""Sessions in Spark's keyed state: chunks of a hot key, timers, the state
store read from outside."""
import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from test_live_windows import _run, _stream

from tidewater.operators import sessions as S
from tidewater.session import fresh_dir
from tidewater.streaming.runner import run_available, run_every
from tidewater.streaming.session_state import SessionProcessor, keyed_sessions, open_sessions, session_changes

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ip string, event_id long, ts timestamp, url string"
REQUEST = ["ip", "event_id", "ts", "session_start", "session_length", "clickstream"]


class _Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class _Map:
    def __init__(self):
        self.held, self.most = {}, 0

    def keys(self):
        return iter(list(self.held))

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


class _Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, *_):
        return _Value()

    def getMapState(self, *_):
        return _Map()

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_call_holds_a_block_of_a_hot_key():
    class Watched(SessionProcessor):
        most = 0

        def _advance(self, key, us, *rest):
            self.most = max(self.most, us.size)
            return super()._advance(key, us, *rest)

    rng = np.random.default_rng(1)
    n = 50_000
    us = rng.permutation(np.arange(n) * 250_000)                       # 4 requests a second of one ip, in any order
    rows = pd.DataFrame({"ts": pd.Series(us.astype("datetime64[us]")), "event_id": np.arange(n), "url": [f"/{i % 7}" for i in range(n)]})
    p = Watched("ip", block_s=300)
    p.init(_Handle())
    got = pd.concat(p.handleInputRows(("hot",), (rows[a:a + 1000] for a in range(0, n, 1000)), None))
    assert p.most == 1200 and not p.aside.held
    got = got.sort_values("ts")
    assert got["session_length"].tolist() == list(range(1, n + 1))
    order = np.argsort(us)
    assert got["clickstream"].iloc[-1] == [f"/{i % 7}" for i in order[:10]]
    assert p.open.held[0] == n


def test_a_key_in_a_few_chunks_is_not_set_aside_row_by_row():
    """Chunks that each span a long time: state calls follow the pieces, not the blocks."""
    rng = np.random.default_rng(4)
    n = 12_000
    us = np.sort(rng.integers(0, 30 * 86_400, n)) * 1_000_000
    us[100:140] = us[100]                                                # equal times, over runs
    at = rng.permutation(n)
    rows = pd.DataFrame({"ts": pd.Series(us[at].astype("datetime64[us]")), "event_id": at, "url": [f"/{i % 7}" for i in at]})
    out = {}
    for held in (2_000, 5_000, 200_000, 0):
        p = SessionProcessor("ip", held_rows=held) if held else SessionProcessor("ip")
        p.init(_Handle())
        calls = []
        put = p.aside.updateValue
        p.aside.updateValue = lambda k, v: (calls.append(len(v[0])), put(k, v))
        chunk = 1000 if held else n
        got = pd.concat(p.handleInputRows(("hot",), (rows[a:a + chunk] for a in range(0, n, chunk)), None))
        assert not p.aside.held and sum(calls) == (n if held and held < n else 0) and len(calls) <= 2 * n // 1000
        out[held] = got.astype(str).values.tolist()
    assert out[2_000] == out[5_000] == out[200_000] == out[0] and len(out[0]) == n


def _requests(rng, n, start, span, keys):
    return [(rng.choice(keys), start * 1000 + i, T0 + dt.timedelta(seconds=start + rng.randrange(span)), f"/{rng.randrange(9)}") for i in range(n)]


def test_running_sessions_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(2)
    batches = [_requests(rng, 150, b * 6000, 6000, ["a", "b", "c", None, "hot", "hot", "hot"]) for b in range(3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")   # so that keys come in several chunks
    try:
        got = _run(spark, keyed_sessions(_stream(spark, tmp_path, batches, SCHEMA), block_s=900)).select(*REQUEST).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = S.running_sessions(spark.createDataFrame([r for b in batches for r in b], SCHEMA)).select(*REQUEST).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 450


def _sessions_of(rows, timeout=1800):
    out = []
    for ip in {r[0] for r in rows}:
        own = sorted((r[2], r[1], r[3]) for r in rows if r[0] == ip)
        cut = [i for i in range(len(own)) if i == 0 or (own[i][0] - own[i - 1][0]).total_seconds() > timeout] + [len(own)]
        out += [(ip, own[a][0], own[b - 1][0], b - a, [x[2] for x in own[a:b]][:10]) for a, b in zip(cut, cut[1:])]
    return out


def test_sessions_end_by_gaps_and_by_the_watermark(spark, tmp_path):
    rng = random.Random(9)
    batches = [_requests(rng, 60, b * 4000, 4000, ["a", "b", None]) for b in range(4)]
    batches[0] += [("once", 1, T0, "/x")]
    edge = T0 + dt.timedelta(seconds=15990)
    batches[3] += [("edge", 7, edge - dt.timedelta(seconds=1800), "/1"), ("edge", 8, edge, "/2")]   # a gap of exactly the timeout
    got = _run(spark, keyed_sessions(_stream(spark, tmp_path, batches, SCHEMA), emit="ended", time_mode="EventTime"))
    got = [(r.ip, r.session_start, r.session_end, r.session_length, r.clickstream) for r in got.collect()]
    every = [r for b in batches for r in b]
    mark = max(r[2] for r in every)
    want = _sessions_of(every)
    newest = {ip: max(s[1] for s in want if s[0] == ip) for ip in {s[0] for s in want}}
    want = [s for s in want if s[1] < newest[s[0]] or mark > s[2] + dt.timedelta(seconds=1800)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert any(s[0] == "once" for s in got) and not any(s[0] == "edge" for s in got)


def test_sessions_end_by_the_clock(spark, tmp_path):
    s = _stream(spark, tmp_path, [[("a", 1, T0, "/1"), ("a", 2, T0, "/2")], [("b", 3, T0, "/3")]], SCHEMA)
    out = fresh_dir(spark, "test-clock")
    ended = keyed_sessions(s, emit="ended", time_mode="ProcessingTime", timeout_s=1, ttl_s=3600)
    q = (ended.writeStream.outputMode("update").option("checkpointLocation", fresh_dir(spark, "test-ck"))
         .foreachBatch(lambda df, b: df.write.mode("append").parquet(out)).trigger(processingTime="500 milliseconds").start())
    try:
        until = dt.datetime.now() + dt.timedelta(seconds=90)
        got = {}
        while len(got) < 2 and dt.datetime.now() < until:
            q.awaitTermination(1)
            assert q.exception() is None
            try:
                got = {r.ip: (r.session_length, r.clickstream) for r in spark.read.parquet(out).collect()}
            except Exception:  # nothing is written yet, or a batch is being written
                got = {}
    finally:
        q.stop()
    assert got == {"a": (2, ["/1", "/2"]), "b": (1, ["/3"])}


def test_state_store_is_read_from_outside(spark, tmp_path):
    batches = [[(k, b * 10 + i, T0 + dt.timedelta(seconds=60 * b + i), f"/{b}") for i, k in enumerate(keys)]
               for b, keys in enumerate((["a", "b", "a"], ["c"], ["a"]))]
    ck = fresh_dir(spark, "test-ck")
    run_available(keyed_sessions(_stream(spark, tmp_path, batches, SCHEMA)).writeStream.outputMode("update").format("noop")
                  .option("checkpointLocation", ck))
    assert {r.ip: r.session_length for r in open_sessions(spark, ck).collect()} == {"a": 3, "b": 1, "c": 1}
    assert {r.ip: r.session_length for r in open_sessions(spark, ck, batch_id=0).collect()} == {"a": 2, "b": 1}
    changed = sorted((r.batch_id, r.change_type, r.ip, r.session_length) for r in session_changes(spark, ck).collect())
    # a batch writes the keys it has requests of, and no others
    assert changed == [(0, "update", "a", 2), (0, "update", "b", 1), (1, "update", "c", 1), (2, "update", "a", 3)]


def test_processing_time_runner(spark, tmp_path):
    """A trigger by the clock gives the same rows as all at once."""
    batches = [_requests(random.Random(b), 20, b * 100, 100, ["a", "b"]) for b in range(2)]
    s = keyed_sessions(_stream(spark, tmp_path, batches, SCHEMA))
    out = fresh_dir(spark, "test-every")
    run_every(s.writeStream.outputMode("update").option("checkpointLocation", fresh_dir(spark, "test-ck"))
              .foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/batch_id={b}")), "0 seconds")
    assert spark.read.parquet(out).agg(F.count(F.lit(1))).first()[0] == 40
