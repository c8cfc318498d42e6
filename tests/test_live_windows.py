"""Window totals that leave the stream with every trigger, against a
brute-force run of the same triggers."""
import collections
import datetime as dt
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.session import fresh_dir
from tidewater.streaming.live_windows import BLOCK_SLIDES, WindowTotals, added_up, live_alarm, live_totals
from tidewater.streaming.runner import run_available
from tidewater.streaming.sinks import write_batch

T0 = dt.datetime(2024, 1, 1)
START = 1_704_067_200  # T0


def _stream(spark, tmp_path, batches, schema):
    """A file per batch, admitted in order."""
    for i, rows in enumerate(batches):
        path = f"{tmp_path}/in/{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (1_600_000_000 + i, 1_600_000_000 + i))
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))


def _run(spark, stream, checkpoint=None):
    out = fresh_dir(spark, "test-live")
    run_available(stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint or fresh_dir(spark, "test-ck"))
                  .foreachBatch(lambda df, b: write_batch(df.withColumn("batch", F.lit(b)), out, b)))
    return spark.read.parquet(out)


def _brute(batches, length, late_s):
    """Rows (batch, key, end, total) given out; batches hold (second, key, value)."""
    out, now, held, newest = [], {}, collections.defaultdict(collections.Counter), None
    for b, rows in enumerate(batches):
        mark = None if newest is None else newest - late_s
        rows = [r for r in rows if mark is None or r[0] > mark]
        for key in {r[1] for r in rows}:
            new = {r[0] for r in rows if r[1] == key}
            for s, x, v in rows:
                if x == key:
                    held[key][s] += v
            last = max(max(new) + 1, now.get(key, -1 << 60))
            for t in sorted({s + 1 for s in held[key]} | {s + 1 + length for s in held[key]}):
                if t <= last and (t > now.get(key, -1 << 60) or any(t - 1 - length <= s <= t - 1 for s in new)):
                    out.append((b, key, t, sum(v for s, v in held[key].items() if t - length <= s < t)))
            now[key] = last
        if mark is not None:
            for key in held:
                for t in sorted({s + 1 for s in held[key]} | {s + 1 + length for s in held[key]}):
                    if now[key] < t <= mark:
                        out.append((b, key, t, sum(v for s, v in held[key].items() if t - length <= s < t)))
                if mark is not None and any(now[key] < s + 1 + length <= mark for s in held[key]):
                    now[key] = mark
        if rows:
            newest = max([newest or 0, *[r[0] for r in rows]])
    return collections.Counter(out)


def test_late_rows_correct_earlier_windows_and_idle_keys_run_down(spark, tmp_path):
    rng = random.Random(5)
    batches = []
    for b in range(6):
        rows = [(200 * b + rng.randrange(200), rng.choice(["a", "b", None]), rng.randint(1, 3)) for _ in range(25)]
        rows += [(max(0, 200 * b - rng.randrange(90)), "a", 1) for _ in range(5 if b else 0)]      # late, within the watermark
        rows += [(5, "b", 100)] if b == 4 else []                                                # far too late
        rows += [(10, "once", 1)] if b == 0 else []                                              # a key that falls silent
        batches.append(rows)
    s = _stream(spark, tmp_path, [[(T0 + dt.timedelta(seconds=t), k, v) for t, k, v in rows] for rows in batches],
                "ts timestamp, key string, v long")
    got = _run(spark, live_totals(s, ["key"], ["v"], 300, 1, watermark="100 seconds")).collect()
    given = collections.Counter((r.batch, r.key, int((r.window_end - T0).total_seconds()), r.v) for r in got if r.batch < len(batches))
    assert given == _brute(batches, 300, 100)
    assert any(k == "once" and n == 0 for _, k, _, n in given)
    newest = {}
    for b, k, t, n in sorted(given, key=lambda r: r[0]):
        newest[k, t] = n
    for (k, t), n in newest.items():                     # what is given out last is right by all rows that count
        assert n == sum(v for rows in batches for s, x, v in rows if x == k and t - 300 <= s < t and v < 100)


def test_alarm_goes_on_from_a_checkpoint(spark, tmp_path):
    rows = [(T0 + dt.timedelta(seconds=i // 2), "Failure" if 300 <= i < 700 else "Success") for i in range(1200)]
    parts = [rows[:500], rows[500:800], rows[800:]]
    ck, schema = fresh_dir(spark, "test-ck"), "ts timestamp, status_class string"
    first = _run(spark, live_alarm(_stream(spark, tmp_path, parts[:2], schema)), ck).collect()
    path = f"{tmp_path}/in/2"
    spark.createDataFrame(parts[2], schema).coalesce(1).write.parquet(path)
    again = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{tmp_path}/in")
    second = _run(spark, live_alarm(again), ck).collect()
    assert {r.batch for r in first} == {0, 1} and min(r.batch for r in second) >= 2  # a batch without rows may come first
    got = [*first, *second]
    assert len(got) == len({r.window_end for r in got}) == 600
    for r in got:
        t = (r.window_end - T0).total_seconds()
        own = [c for x, c in rows if t - 300 <= (x - T0).total_seconds() < t]
        ok, err = own.count("Success"), own.count("Failure")
        assert (r.n_success, r.n_failure) == (ok, err)
        assert r.verdict == ("insufficient" if ok + err <= 100 else "alarm" if err > 0.5 * ok else "ok")


def test_rows_are_added_up_before_the_state(spark):
    df = spark.range(0, 50_000, 1, 2).select((F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 7).alias("b"), F.lit(1).cast("long").alias("v"))
    got = added_up(df, ["k"], "b", ["v"]).collect()
    assert sum(r.v for r in got) == 50_000 and len(got) <= 21 * 8


@pytest.mark.parametrize("length, slide", [(300, 7)])
def test_the_slide_divides_the_window(spark, length, slide):
    with pytest.raises(ValueError):
        live_totals(spark.createDataFrame([], "ts timestamp, v long"), [], ["v"], length, slide)


class _State(dict):
    """A handle, its value state and its map states, in memory."""

    def __init__(self):
        self.timers, self.maps, self.one = [], {}, None

    def getValueState(self, *_):
        return self

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _State())

    def exists(self):
        return self.one is not None

    def get(self):
        return self.one

    def update(self, value):
        self.one = value

    def clear(self):
        super().clear()
        self.one = None

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.mark


def _triggers(processor, triggers, chunk):
    """What a key gives out, trigger by trigger of (watermark in s, seconds); the frames."""
    state = _State()
    processor.init(state)
    out = []
    for mark, seconds in triggers:
        state.mark = mark * 1000
        us = np.asarray(seconds, np.int64) * 1_000_000
        rows = pd.DataFrame({"bucket_us": us, "v": 1, "w": us // 1_000_000})
        out.append(list(processor.handleInputRows(("k",), (rows[a:a + chunk] for a in range(0, len(rows), chunk)), state)))
        out[-1] += list(processor.handleExpiredTimer(("k",), state, None))
    return out, state


def test_a_call_holds_two_blocks_of_a_long_queue():
    n = 60_000
    out, state = _triggers(WindowTotals(["k"], ["v", "w"], 300, 1, held_buckets=7_000), [(0, np.random.default_rng(3).permutation(n))], 1000)
    assert max(len(f) for f in out[0]) <= 2 * BLOCK_SLIDES and not state.maps["fresh"]
    got = pd.concat(out[0])
    assert (got["window_end_us"] // 1_000_000).tolist() == list(range(1, n + 1))
    assert got["v"].tolist() == [min(t, 300) for t in range(1, n + 1)]
    assert got["w"].tolist() == [sum(range(max(0, t - 300), t)) for t in range(1, n + 1)]


@pytest.mark.parametrize("block, held", [(1, 1 << 40), (300, 40), (1000, 40), (1 << 20, 1 << 40)])
def test_blocks_give_out_what_one_queue_does(block, held):
    rng = random.Random(block)
    triggers, newest = [], 0
    for b in range(9):
        mark = max(0, newest - 900)
        rows = [600 * b + 2000 * (b > 4) + rng.randrange(900) for _ in range(rng.choice([5, 120]))] + [mark + 1 + rng.randrange(900) for _ in range(6)]
        triggers.append((mark, [r for r in rows if r > mark]))
        newest = max(newest, *triggers[-1][1])
    got, _ = _triggers(WindowTotals(["k"], ["v", "w"], 300, 1, block_slides=block, held_buckets=held), triggers, 16)
    held_rows, now = [], -1 << 60
    for (mark, rows), frames in zip(triggers, got):
        held_rows += rows
        last = max(now, max(rows) + 1)
        ends = {t for r in held_rows for t in (r + 1, r + 301)}
        given = [t for t in sorted(ends) if t <= last and (t > now or any(t - 301 <= r <= t - 1 for r in rows))]
        late = [t for t in sorted(ends) if last < t <= mark]
        now = max(last, mark)
        want = [(t, sum(t - 300 <= r < t for r in held_rows), sum(r for r in held_rows if t - 300 <= r < t)) for t in given + late]
        frames = pd.concat(frames) if frames else pd.DataFrame({"window_end_us": [], "v": [], "w": []})
        assert [(t // 1_000_000, v, w) for t, v, w in zip(frames["window_end_us"], frames["v"], frames["w"])] == want


def test_rows_are_added_up_across_short_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 20_000, 1, 2).select(F.lit("k").alias("k"), (F.col("id") % 7).alias("b"), F.lit(1).cast("long").alias("v"))
        got = added_up(df, ["k"], "b", ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.v for r in got) == 20_000 and len(got) == 14
