"""Keyed sessions with an idle timeout (batch form of keyed state).

A session of a key (an ip) is a run of its requests, in (ts, event_id)
order, with no gap above the timeout.  Per request the reference emits the
running state: number of requests so far and the first ten URLs.

Skew: one key may hold a third of all rows, so no step partitions rows by
the key alone.  Rows are shuffled once, by (key, time block).  Inside a
block the gaps cut them into pieces of sessions; a block of an hour holds at
most three pieces of a key at a timeout of half an hour, so the table of
pieces (first and last time, count, first URLs) is small next to the data.
Windows over a key's pieces, in order, join them to sessions.  Sessions are
aggregates of pieces and never come back to the rows; the running form joins
each row to its piece on the columns the rows are already partitioned by.

A stream carries the open session of each key between batches as one more
piece ahead of all others (``carry``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.windows import US, from_micros, to_micros

# Fixed values (reference settings).
SESSION_TIMEOUT_S = 30 * 60   # idle time after which a key's state expires
CLICKSTREAM_MAX = 10          # URLs kept per session

# Time block of the skew-safe plan: the most one task holds for one key is
# one hour of that key's requests; the block summaries have at most one row
# per request (and a busy key one row per hour).
SESSION_BLOCK_S = 3_600


def append_keep_first(xs, x, keep_max: int = CLICKSTREAM_MAX) -> F.Column:
    """State update of a clickstream: append ``x`` and keep the first
    ``keep_max`` elements (once full, later URLs are not kept)."""
    xs = F.col(xs) if isinstance(xs, str) else xs
    x = F.col(x) if isinstance(x, str) else x
    return F.slice(F.concat(xs, F.array(x)), 1, keep_max)


#: Block number of the carried pieces, ahead of every block of rows.
_CARRIED = -(1 << 62)


def _block_rows(df: DataFrame, key: str, ts: str, tie: str, url: str, timeout_s: int, block_s: int) -> DataFrame:
    """Rows with their block, the number of the piece in it (``_irun``) and
    their place in the piece (``_rn``)."""
    kn, kv = F.col(key).isNull().alias("_kn"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_kv")
    base = (df.where(F.col(ts).isNotNull())
            .select(key, ts, tie, url, kn, kv, to_micros(ts).alias("_us"))
            # never null here; declared so, no null test is inferred from
            # the join into one branch only (which would stop exchange reuse)
            .withColumn("_blk", F.coalesce(F.floor(F.col("_us") / F.lit(block_s * US)), F.lit(0))))
    part = ["_kn", "_kv", "_blk"]
    w = Window.partitionBy(*part).orderBy("_us", tie)
    gap = F.coalesce((F.col("_us") - F.col("_lag") > timeout_s * US).cast("int"), F.lit(0))
    return (base.withColumn("_lag", F.lag("_us").over(w))
            .withColumn("_irun", F.sum(gap).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_rn", F.row_number().over(Window.partitionBy(*part, "_irun").orderBy("_us", tie))))


def _pieces(rows: DataFrame, key: str, ts: str, url: str, timeout_s: int, keep_max: int,
            carry: DataFrame | None) -> DataFrame:
    """Pieces of sessions with their session: ``sid``, rows of the session
    before the piece, its start and its first URLs so far."""
    # taking the end from ``ts`` and grouping by the key keep this branch's
    # columns equal to the rows' own, which lets Spark reuse their exchange
    p = rows.groupBy("_kn", "_kv", "_blk", "_irun", key).agg(
        F.min("_us").alias("_first"), to_micros(F.max(ts)).alias("_last"), F.count(F.lit(1)).alias("_cnt"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("_rn") <= keep_max, F.struct("_rn", url)))),
                    lambda x: x[url]).alias("_urls")).withColumn("_start", F.col("_first"))
    if carry is not None:
        p = p.unionByName(carry.select(
            F.col(key).isNull().alias("_kn"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_kv"),
            F.lit(_CARRIED).cast("long").alias("_blk"), F.lit(0).cast("long").alias("_irun"), key,
            to_micros("session_end").alias("_first"), to_micros("session_end").alias("_last"),
            F.col("session_length").alias("_cnt"), F.col("clickstream").alias("_urls"),
            to_micros("session_start").alias("_start")))
    w = Window.partitionBy("_kn", "_kv").orderBy("_blk", "_irun")
    before = F.max("_last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("_first") - F.col("_prev") > timeout_s * US).cast("int"), F.lit(1))
    p = (p.withColumn("_prev", before)
         .withColumn("sid", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    ws = Window.partitionBy("_kn", "_kv", "sid").orderBy("_blk", "_irun")
    earlier = ws.rowsBetween(Window.unboundedPreceding, -1)
    return (p.withColumn("_before", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
            .withColumn("_session_start", F.first("_start").over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_ahead", F.when(F.col("_before") < keep_max, F.col("_urls"))))


def running_sessions(df: DataFrame, key: str = "ip", ts: str = "ts", url: str = "url",
                     tie: str = "event_id", timeout_s: int = SESSION_TIMEOUT_S,
                     keep_max: int = CLICKSTREAM_MAX, block_s: int = SESSION_BLOCK_S,
                     carry: DataFrame | None = None) -> DataFrame:
    """Per request: ``session_start``, ``session_length`` (requests so far in
    the session) and ``clickstream`` (its first ``keep_max`` URLs so far).
    ``carry`` has the keys' open sessions before these rows (the columns of
    ``session_snapshot``); a request older than its key's open session's end
    joins that session."""
    rows = _block_rows(df, key, ts, tie, url, timeout_s, block_s)
    ws = Window.partitionBy("_kn", "_kv", "sid").orderBy("_blk", "_irun").rowsBetween(Window.unboundedPreceding, -1)
    p = (_pieces(rows, key, ts, url, timeout_s, keep_max, carry)
         .withColumn("_carried", F.slice(F.flatten(F.collect_list("_ahead").over(ws)), 1, keep_max))
         .select("_kn", "_kv", "_blk", F.col("_irun").alias("_piece"), "_before", "_session_start", "_carried"))
    part = ["_kn", "_kv", "_blk"]
    # the piece is compared beside the join's keys, so that the rows stay as they are partitioned;
    # no row lies in the carried pieces' block
    j = rows.join(p, part).where(F.col("_irun") - F.col("_piece") == 0)
    j = j.withColumn("session_length", (F.col("_before") + F.col("_rn")).cast("bigint"))
    upto = (Window.partitionBy(*part, "_irun").orderBy("_us", tie)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = F.collect_list(F.when(F.col("session_length") <= keep_max, F.col(url))).over(upto)
    clicks = F.slice(F.concat("_carried", local), 1, F.least(F.col("session_length"), F.lit(keep_max)).cast("int"))
    return j.select(key, ts, tie, url, from_micros("_session_start").cast(df.schema[ts].dataType).alias("session_start"),
                    "session_length", clicks.alias("clickstream"))


def sessions(df: DataFrame, key: str = "ip", ts: str = "ts", url: str = "url", tie: str = "event_id",
             timeout_s: int = SESSION_TIMEOUT_S, keep_max: int = CLICKSTREAM_MAX,
             block_s: int = SESSION_BLOCK_S, carry: DataFrame | None = None) -> DataFrame:
    """One row per session: start, end, number of requests, first URLs; an
    aggregate of its pieces (the URL list takes at most ``keep_max`` of them)."""
    p = _pieces(_block_rows(df, key, ts, tie, url, timeout_s, block_s), key, ts, url, timeout_s, keep_max, carry)
    kind = df.schema[ts].dataType
    ahead = F.sort_array(F.collect_list(F.when(F.col("_ahead").isNotNull(), F.struct("_blk", "_irun", "_ahead"))))
    return p.groupBy(key, "sid").agg(
        F.min("_session_start").alias("_s"), F.max("_last").alias("_e"), F.sum("_cnt").alias("session_length"),
        F.slice(F.flatten(F.transform(ahead, lambda x: x["_ahead"])), 1, keep_max).alias("clickstream")).select(
        key, "sid", from_micros("_s").cast(kind).alias("session_start"), from_micros("_e").cast(kind).alias("session_end"),
        "session_length", "clickstream")


def session_snapshot(df: DataFrame, key: str = "ip", ts: str = "ts", url: str = "url",
                     tie: str = "event_id", timeout_s: int = SESSION_TIMEOUT_S,
                     keep_max: int = CLICKSTREAM_MAX, carry: DataFrame | None = None) -> DataFrame:
    """State of every key after the last request: its latest session (with
    ``carry``, also of the keys that have no request here)."""
    s = sessions(df, key, ts, url, tie, timeout_s, keep_max, carry=carry)
    packed = F.struct("sid", "session_start", "session_end", "session_length", "clickstream")
    latest = s.groupBy(key).agg(F.max(packed).alias("_m"))
    return latest.select(key, "_m.session_start", "_m.session_end", "_m.session_length", "_m.clickstream")
