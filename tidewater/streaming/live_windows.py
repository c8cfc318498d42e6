"""Sliding-window totals that leave the stream with every trigger.

Rows are added up per key and slide bucket in the tasks that read them
(Arrow tables, no state); a ``StatefulProcessor`` keeps, per key, the queue of
the buckets that a window can still hold, in Spark's state store, by blocks of
time, of which a call holds two, and not more than ``HELD_BUCKETS`` of the
trigger's buckets besides. A trigger
puts its buckets in, gives out the totals of the windows that changed, and
takes off the buckets that no later row can reach. Neither the rows nor the
windows of earlier triggers are read again.

What a trigger gives out, per key: a window ends at every time at which a
bucket enters it or leaves it. Given out are those after the newest time of
the trigger before and up to this one's, and the earlier ones that rows of
this trigger have changed (late rows correct what was given out). A key that
gets no rows is looked at again when the watermark reaches the time at which
its oldest bucket leaves. Rows older than the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewater.functions import logparse as lp
from tidewater.operators.weblog import alarm_verdict
from tidewater.operators.windows import US, floor_to, from_micros, to_micros

#: Settings that keyed state needs: the provider, and a change log per batch instead of whole snapshots.
KEYED_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def with_keyed_state(spark: SparkSession) -> None:
    """Set what keyed state needs for the queries that this session starts."""
    for k, v in KEYED_STATE_CONF.items():
        spark.conf.set(k, v)


#: Rows that a task holds of those it adds up, and buckets that a call holds of a key's.
HELD_ROWS = 100_000
HELD_BUCKETS = 500_000
#: Slides of a block of the queue, at least.
BLOCK_SLIDES = 4096


def added_up(df: DataFrame, keys: list[str], bucket: str, sums: list[str]) -> DataFrame:
    """``df`` with its rows added up per key and bucket, in the tasks that read
    them and for up to ``HELD_ROWS`` sums at a time: a partial aggregate without
    state, so it may stand before a stateful operator."""
    names = [*keys, bucket, *sums]

    def total(t: pa.Table) -> pa.Table:
        t = t.group_by([*keys, bucket]).aggregate([(c, "sum") for c in sums])
        return t.rename_columns(names).select(names).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(total(pa.Table.from_batches([batch])))
            size += held[-1].num_rows
            if size >= HELD_ROWS:
                held = [total(pa.concat_tables(held))]
                size = held[0].num_rows
                if size >= HELD_ROWS // 2:  # they hardly add up
                    yield from held.pop().to_batches(max_chunksize=10_000)
                    size = 0
        if held:
            yield from total(pa.concat_tables(held)).to_batches(max_chunksize=10_000)
    own = df.select(*keys, bucket, *sums)
    return own.mapInArrow(run, own.schema)


class WindowTotals(StatefulProcessor):
    """Per key: totals of ``sums`` in the windows of ``length_s`` that changed.

    The queue of a key's buckets lies in a map state by blocks of time, each at
    least as long as a window, so a window has its buckets in two of them. A
    call takes the blocks one by one, and only those that rows of the trigger
    or the time since the trigger before can have changed."""

    def __init__(self, keys: list[str], sums: list[str], length_s: int, slide_s: int,
                 block_slides: int = BLOCK_SLIDES, held_buckets: int = HELD_BUCKETS):
        self.keys, self.sums = keys, sums
        self.length, self.slide = length_s * US, slide_s * US
        self.block, self.most = max(self.length, block_slides * self.slide), held_buckets

    def init(self, handle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "now long, blocks array<long>")
        self.queue = handle.getMapState("queue", "block long", "buckets binary, sums binary")
        self.fresh = handle.getMapState("fresh", "block long", "buckets binary, sums binary")

    # -- blocks of the map states -------------------------------------------------------------------
    def _none(self) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0, np.int64), np.zeros((0, len(self.sums)), np.int64)

    def _read(self, state, block: int) -> tuple[np.ndarray, np.ndarray]:
        buckets, sums = state.getValue((block,))
        return np.frombuffer(buckets, np.int64), np.frombuffer(sums, np.int64).reshape(-1, len(self.sums))

    def _write(self, state, block: int, bucket: np.ndarray, value: np.ndarray) -> None:
        state.updateValue((block,), (bucket.tobytes(), np.ascontiguousarray(value).tobytes()))

    def _held(self) -> tuple[int | None, set[int]]:
        if not self.at.exists():
            return None, set()
        now, blocks = self.at.get()
        return now, set(blocks)

    def _by_block(self, bucket: np.ndarray, value: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Buckets in order, cut into their blocks."""
        block = bucket // self.block
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), bucket.size]
        return {int(block[a]): (bucket[a:b], value[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a}

    def _joined(self, *parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _merged(self, bucket: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, at = np.unique(bucket, return_inverse=True)
        out = np.zeros((one.size, len(self.sums)), np.int64)
        np.add.at(out, at, value)
        return one, out

    def _gathered(self, rows) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], set[int]]:
        """The buckets of a trigger by block. If they are more than a call
        may hold, they are set aside in ``fresh``, in the blocks given second."""
        held, size, aside = [self._none()], 0, set()

        def set_aside(bucket: np.ndarray, value: np.ndarray) -> None:
            for b, own in self._by_block(bucket, value).items():
                self._write(self.fresh, b, *(self._merged(*self._joined(self._read(self.fresh, b), own)) if b in aside else own))
                aside.add(b)
        for part in rows:
            held.append((part["bucket_us"].to_numpy(np.int64), part[self.sums].to_numpy(np.int64)))
            size += len(part)
            if size >= self.most:
                held = [self._merged(*self._joined(*held))]
                size = held[0][0].size
                if size >= self.most // 2:
                    set_aside(*held[0])
                    held, size = [self._none()], 0
        bucket, value = self._merged(*self._joined(*held))
        if not aside:
            return self._by_block(bucket, value), aside
        set_aside(bucket, value)
        return {}, aside

    # -- what changes -------------------------------------------------------------------------------
    def _changes(self, key, bucket, value, times) -> pd.DataFrame:
        """Totals of the windows that end at ``times``."""
        upto = np.concatenate((np.zeros((1, len(self.sums)), np.int64), np.cumsum(value, axis=0)))
        total = (upto[np.searchsorted(bucket, times - self.slide, side="right")]
                 - upto[np.searchsorted(bucket, times - self.slide - self.length, side="right")])
        return pd.DataFrame({**{k: pd.Series([v] * times.size, dtype=object) for k, v in zip(self.keys, key)},
                             "window_end_us": times, **{c: total[:, i] for i, c in enumerate(self.sums)}})

    def _ends(self, bucket: np.ndarray) -> np.ndarray:
        """Times at which a window changes by the buckets."""
        return np.union1d(bucket + self.slide, bucket + self.slide + self.length)

    def _staying(self, now: int, blocks: set[int]) -> list[int]:
        """The blocks with buckets that are still to leave the newest window."""
        return sorted(b for b in blocks if b >= (now - self.slide - self.length) // self.block)

    def _kept(self, now: int, blocks: set[int], watermark_us: int) -> None:
        """The queue without the buckets that no window of a later row holds
        and that have left the newest window."""
        reach = min(watermark_us, now - self.slide) - self.length
        for b in [b for b in blocks if b * self.block <= reach - self.slide]:
            bucket, value = self._read(self.queue, b)
            live = bucket > reach - self.slide
            if not live.any():
                self.queue.removeKey((b,))
                blocks.discard(b)
            elif not live.all():
                self._write(self.queue, b, bucket[live], value[live])
        self.at.update((now, sorted(blocks)))
        for b in self._staying(now, blocks):
            bucket, _ = self._read(self.queue, b)
            leaving = bucket[bucket + self.slide + self.length > now]
            if leaving.size:
                self.handle.registerTimer(int(-(-(leaving[0] + self.slide + self.length) // 1000)))
                return

    def handleInputRows(self, key, rows, timerValues):
        now, blocks = self._held()
        new, aside = self._gathered(rows)
        arrived = aside or set(new)
        if not arrived:
            return

        def added(b: int) -> tuple[np.ndarray, np.ndarray]:
            return self._none() if b not in arrived else self._read(self.fresh, b) if aside else new[b]

        def entered(b: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
            """A block with the trigger's buckets put in, and those buckets."""
            own = added(b)
            all_of = self._read(self.queue, b) if b in blocks else self._none()
            if b in arrived:
                all_of = self._merged(*self._joined(all_of, own)) if b in blocks else own
                self._write(self.queue, b, *all_of)
            return all_of, own[0]
        latest = int(added(max(arrived))[0][-1] + self.slide)
        latest = latest if now is None else max(latest, now)
        todo = {t for b in arrived for t in (b, b + 1)}
        if now is not None:
            todo |= {t for b in blocks for t in (b, b + 1) if t >= (now - self.slide) // self.block}
        last = None
        for t in sorted(todo):
            before = last[1] if last is not None and last[0] == t - 1 else entered(t - 1)
            last = t, entered(t)
            bucket, value = self._joined(before[0], last[1][0])
            times = self._ends(bucket)
            times = times[((times - self.slide) // self.block == t) & (times <= latest)]
            if now is not None:
                # of the times given out before, those inside a window that a new bucket entered
                fresh = np.concatenate((before[1], last[1][1]))
                after = np.searchsorted(fresh, times - self.slide - self.length, side="left")
                touched = np.append(fresh, np.iinfo(np.int64).max)[after] <= times - self.slide
                times = times[(times > now) | touched]
            if times.size:
                yield self._changes(key, bucket, value, times)
        if aside:
            self.fresh.clear()
        self._kept(latest, blocks | arrived, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, blocks = self._held()
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        if now is None:
            return
        near = self._staying(now, blocks) or sorted(blocks)[-1:]
        bucket, value = self._joined(self._none(), *[self._read(self.queue, b) for b in near])
        times = self._ends(bucket)
        times = times[(times > now) & (times <= watermark)]
        if times.size:
            yield self._changes(key, bucket, value, times)
        now = max(now, int(watermark))
        if bucket.size and bucket[-1] + self.slide + self.length <= now and bucket[-1] + self.length < watermark:
            self.queue.clear()
            self.at.clear()
        else:
            self._kept(now, blocks, watermark)

    def close(self) -> None:
        pass


def live_totals(df: DataFrame, keys: list[str], sums: list[str], length_s: int, slide_s: int, ts: str = "ts",
                watermark: str = "10 minutes") -> DataFrame:
    """Streaming (``*keys``, window_end, ``*sums``): the totals of the windows
    that each trigger changes. ``sums`` are long columns of ``df``."""
    with_keyed_state(df.sparkSession)
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    counted = df.where(F.col(ts).isNotNull()).withColumn("bucket_us", floor_to(to_micros(ts), slide_s * US))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    out = (added_up(counted, keys, "bucket_us", sums)
           .withColumn("bucket_ts", from_micros("bucket_us").cast("timestamp")).withWatermark("bucket_ts", watermark)
           .groupBy(*keys).transformWithStateInPandas(
               statefulProcessor=WindowTotals(keys, sums, length_s, slide_s),
               outputStructType=", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "window_end_us long", *[f"`{c}` long" for c in sums]]),
               outputMode="Update", timeMode="EventTime"))
    return out.select(*keys, from_micros("window_end_us").alias("window_end"), *sums)


def live_alarm(classes: DataFrame, length_s: int = 300, slide_s: int = 1, ts: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """Streaming (window_end, n_success, n_failure, verdict) from rows with
    ``ts`` and ``status_class``: the verdicts that each trigger changes."""
    hit = {"n_success": lp.SUCCESS, "n_failure": lp.FAILURE}
    rows = classes.select(ts, F.lit("").alias("all"), *[(F.col("status_class") == c).cast("long").alias(n) for n, c in hit.items()])
    out = live_totals(rows, ["all"], list(hit), length_s, slide_s, ts, watermark)
    return out.select("window_end", *hit, alarm_verdict("n_success", "n_failure").alias("verdict"))
