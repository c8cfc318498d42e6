"""Keyed sessions of a stream, on event time.

Each micro-batch runs the batch plan of ``operators.sessions`` with the open
session of every key carried from the batch before (a versioned table: last
request, start, count, first URLs). So the answer depends on the requests and
their order alone, not on how fast batches come; no Python runs per row; and
a hot key is cut into time blocks like in the batch form.

A session ends by the gap between two requests' times. State is only cleaned
up: with ``keep_s``, keys whose last request is that much older than the
newest are dropped (choose it above the timeout plus the lateness expected).
A request older than its key's last one joins the session open at that time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import sessions as S
from tidewater.streaming.sinks import write_batch
from tidewater.streaming.store import VersionedTable


class SessionStream:
    """``foreachBatch`` sink: running sessions per request below ``out``, and
    the state of all keys after the batch, shown to ``on_snapshot`` (also as
    the temp view ``sessions``) and kept for the next."""

    def __init__(self, out: str, key: str = "ip", timeout_s: int = S.SESSION_TIMEOUT_S,
                 keep_max: int = S.CLICKSTREAM_MAX, keep_s: int | None = None,
                 on_snapshot: Callable[[DataFrame, int], None] | None = None, requests: bool = True):
        self.rows, self.state = f"{out}/requests", VersionedTable(f"{out}/state")
        self.key, self.timeout_s, self.keep_max, self.keep_s = key, timeout_s, keep_max, keep_s
        self.on_snapshot, self.requests = on_snapshot, requests

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        held = self.state.read(spark, batch_id)
        df = df.persist()
        try:
            options = {"timeout_s": self.timeout_s, "keep_max": self.keep_max, "carry": held}
            if self.requests:
                write_batch(S.running_sessions(df, self.key, **options), self.rows, batch_id)
            now = S.session_snapshot(df, self.key, **options)
            if self.keep_s is not None:
                newest = now.agg(F.max("session_end").alias("_newest"))
                now = (now.crossJoin(F.broadcast(newest))  # one row
                       .where(F.col("session_end") >= F.col("_newest") - F.expr(f"interval {int(self.keep_s)} seconds"))
                       .drop("_newest"))
            self.state.write(now, batch_id)
        finally:
            df.unpersist()
        if self.on_snapshot is not None:
            snapshot = self.snapshot(spark)
            snapshot.createOrReplaceTempView("sessions")
            self.on_snapshot(snapshot, batch_id)

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """The newest session of every key."""
        return self.state.read(spark)
