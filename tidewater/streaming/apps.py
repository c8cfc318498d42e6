"""The reference's streaming programs as Structured Streaming queries.

Each function takes a streaming DataFrame (from any line source) and
returns a streaming DataFrame or starts a query with ``foreachBatch``;
the same operators serve the bounded tables in ``tidewater.plans``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import weblog as W
from tidewater.operators.windows import to_micros, windows_of_buckets
from tidewater.streaming.sinks import KeyedStore


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need ``timestamp``; the tables hold ``timestamp_ntz``."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _flatten(df: DataFrame, window: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c != window]
    return df.select(F.col(f"{window}.start").cast("timestamp_ntz").alias("window_start"),
                     F.col(f"{window}.end").cast("timestamp_ntz").alias("window_end"), *rest)


class SlidingCounts:
    """Sliding-window counts of a stream by key.

    The stream counts rows per slide bucket and key (a tumbling window in
    update mode); a keyed store holds the newest count of each. Windows are
    made of the stored buckets, so every window is there from its first row
    on, none waits for a watermark, and a short slide copies nothing in the
    stream. Rows later than ``watermark`` are dropped by Spark (its progress
    reports count them as ``numRowsDroppedByWatermark``); all others count in
    every window that holds them, whatever the slide.
    """

    def __init__(self, out: str, keys, slide_s: int, watermark: str = "10 minutes"):
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.slide_s, self.watermark = slide_s, watermark
        self.store = KeyedStore(out, ["_b", *self.keys], ["_batch"], ["n"])

    def stream(self, df: DataFrame, ts: str = "ts"):
        """Writer of the bucket counts of ``df`` into the store."""
        counts = (df.withWatermark(ts, self.watermark)
                  .groupBy(F.window(ts, f"{self.slide_s} seconds").alias("w"), *self.keys)
                  .agg(F.count(F.lit(1)).alias("n")))
        return counts.writeStream.outputMode("update").foreachBatch(self._keep)

    def _keep(self, df: DataFrame, batch_id: int) -> None:
        start = to_micros(F.col("w.start").cast("timestamp_ntz"))
        self.store(df.select(start.alias("_b"), *self.keys, "n", F.lit(batch_id).cast("long").alias("_batch")), batch_id)

    def buckets(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark).select("_b", *self.keys, "n")

    def windows(self, spark: SparkSession, length_s: int) -> DataFrame:
        return windows_of_buckets(self.buckets(spark), self.keys, length_s, self.slide_s)


def status_hourly_stream(lines: DataFrame) -> DataFrame:
    """Count by status and hour of the request time; run in complete mode."""
    parsed = W.status_times(lines).select("status", F.col("log_time").cast("timestamp").alias("t"))
    agg = parsed.where(F.col("t").isNotNull()).groupBy("status", F.window("t", "1 hour")).agg(
        F.count(F.lit(1)).alias("n"))
    return _flatten(agg)


def to_console(df: DataFrame, mode: str = "complete", rows: int = 20):
    """Writer that prints a stream's result to the console per trigger."""
    return df.writeStream.format("console").outputMode(mode).option("numRows", rows).option("truncate", False)


def length_totals_stream(posts: DataFrame) -> DataFrame:
    """Running totals over all batches (complete mode keeps them in the
    state store, so they survive a restart)."""
    from tidewater.functions.text import utf16_length
    L = utf16_length("text")
    return posts.agg(F.count(F.lit(1)).alias("n_posts"), F.sum(L).cast("bigint").alias("total_chars"),
                     F.max(L).cast("bigint").alias("max_len"))
