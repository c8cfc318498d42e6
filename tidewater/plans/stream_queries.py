"""Streaming queries: each stages its input from the driver's tables as
ordered parts (or replays the table directly), runs the stream to the end
with an ``availableNow`` trigger, and returns what the sink holds.

Where the stream's final result is deterministic, it carries the oracle
of its batch twin, so the stream path is checked value by value.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.logparse import FIELDS
from tidewater.operators import text as T
from tidewater.operators import weblog as W
from tidewater.operators.windows import top_k_change_points, top_k_per_window
from tidewater.plans import duck as D
from tidewater.plans import log_queries, session_queries  # noqa: F401  (oracles reused)
from tidewater.plans.learning_queries import KMEANS_START, ROUND
from tidewater.plans.log_queries import _RECORD_SQL
from tidewater.plans.registry import ORACLES, query
from tidewater.plans.text_queries import u16
from tidewater.session import fresh_dir
from tidewater.sources.replay import replay_in_batches, replay_stream
from tidewater.sources.staging import stage_parts
from tidewater.sources.streams import as_kafka_records, kafka_lines, read_lines
from tidewater.sources.tables import blobs, points, posts, table, weblog, weblog_dense
from tidewater.streaming import apps as A
from tidewater.streaming.folder_sink import folder_writer, read_committed
from tidewater.streaming.learners import KMeansStream, PinnedScorer, RegressionStream, labeled_of, vectors_of
from tidewater.streaming.live_windows import live_alarm
from tidewater.streaming.runner import checkpoint_for, file_stream, run_available, run_every
from tidewater.streaming.session_state import keyed_sessions, open_sessions
from tidewater.streaming.sessions import SessionStream
from tidewater.streaming.sinks import (
    RECORD_SEP,
    KeyedStore,
    SaveUntil,
    per_batch,
    print_batch,
    skip_empty,
    sql_per_batch,
    write_batch,
    write_counted,
)
from tidewater.streaming.stateful import sessions_with_state

PARTS = 4          # micro-batches per replayed table
SAVE_LIMIT = 100   # of save_posts_limited: passed at every scale
SAVE_PARTS = 8


def _staged(spark, df, order, kind, fmt="parquet", columns=None, parts=PARTS):
    path = stage_parts(spark, df, order, parts, kind, fmt=fmt, columns=columns)
    return file_stream(spark, path.path, df.select(*(columns or df.columns)).schema, fmt, path.files)


# -- SRC2: a folder of text files as a stream ---------------------------------------
_PARSE_NO_ID = D.with_(D.WEBLOG) + "select " + ", ".join(
    (f"nullif({D.grp(1)}, '') as ip" if f == "ip" else f'{D.grp(i + 1)} as "{f}"')
    for i, f in enumerate(FIELDS)) + f" from weblog where {D.matched()}"


@query("stream_text_dir", _PARSE_NO_ID)
def q_stream_text_dir(spark, sf):
    wl = weblog(spark, sf)
    path = stage_parts(spark, wl, "event_id", PARTS, "weblog_text", fmt="text", columns=["line"])
    lines = read_lines(spark, "text_dir", path=path.path, max_files_per_trigger=path.files)
    out = fresh_dir(spark, "out/stream_text_dir")
    run_available(W.parse_log(lines).writeStream.format("parquet").option("path", out)
                  .option("checkpointLocation", checkpoint_for(spark, "stream_text_dir")))
    return spark.read.parquet(out)


# -- SRC6: the replay source, and STM10: restart from the checkpoint ------------------
@query("stream_replay_source", "select event_id, ts, user_id, event_type from events")
def q_stream_replay_source(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    out, ckpt = fresh_dir(spark, "out/stream_replay"), checkpoint_for(spark, "stream_replay")
    per_batch_ids = max(1, ev.count() // PARTS)
    replay_in_batches(spark, f"{sf}/events.parquet", "event_id", ev.schema, per_batch_ids, lambda s:
                      s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt),
                      ids_per_partition=max(1, per_batch_ids // 4))
    return spark.read.parquet(out)


@query("stream_restart", "select event_type, count(*) as n from events group by all")
def q_stream_restart(spark, sf):
    """Counts per event type, computed in two runs of one query: the
    second run restarts from the first run's checkpoint with more input."""
    ev = table(spark, sf, "events").select("event_id", "event_type")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    ckpt = checkpoint_for(spark, "stream_restart")
    out = fresh_dir(spark, "out/stream_restart")
    for stop in (lo + (hi - lo) // 2, hi + 1):
        s = replay_stream(spark, f"{sf}/events.parquet", "event_id", ev.schema, stop_at=stop)
        counts = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        run_available(counts.writeStream.outputMode("complete")
                      .foreachBatch(lambda df, bid: write_batch(df, out, 0))
                      .option("checkpointLocation", ckpt))
    return spark.read.parquet(f"{out}/batch_id=0")


# -- APP13 / SRC4 / STM2 / ORD3: top URLs of a Kafka-shaped stream --------------------
def _sliding(spark, df, keys, slide_s, name):
    """Run a stream of sliding counts to its end; the counts."""
    counts = A.SlidingCounts(fresh_dir(spark, f"out/{name}"), keys, slide_s)
    run_available(counts.stream(df).option("checkpointLocation", checkpoint_for(spark, name)))
    return counts


@query("stream_top_urls", ORACLES["top_urls"])
def q_stream_top_urls(spark, sf):
    rec = as_kafka_records(weblog(spark, sf))
    urls = W.strict_urls(kafka_lines(_staged(spark, rec, "offset", "kafka_records")), keep=("ts",))
    counts = _sliding(spark, urls, "url", 60, "stream_top_urls")
    return top_k_per_window(counts.windows(spark, 300), "url", 10)


@query("stream_sliding_counts", ORACLES["sliding_url_counts"])
def q_stream_sliding_counts(spark, sf):
    urls = W.strict_urls(weblog(spark, sf), keep=("event_id", "ts"))
    s = A.event_time(_staged(spark, urls, "event_id", "urls"))
    return _sliding(spark, s, "url", 60, "stream_sliding_counts").windows(spark, 300)


@query("stream_top_urls_1s", ORACLES["top_urls_1s"])
def q_stream_top_urls_1s(spark, sf):
    urls = W.strict_urls(weblog(spark, sf), keep=("event_id", "ts"))
    s = A.event_time(_staged(spark, urls, "event_id", "urls_1s"))
    return top_k_change_points(_sliding(spark, s, "url", 1, "stream_top_urls_1s").buckets(spark), "url", 300, 1)


# -- APP7: popular hashtags of a stream, APP2: alarm of a stream, at the reference's 1 s slide --------
@query("stream_top_hashtags", ORACLES["top_hashtags_1s"])
def q_stream_top_hashtags(spark, sf):
    tags = T.hashtags(posts(spark, sf), keep=("post_id", "ts"))
    s = A.event_time(_staged(spark, tags, "post_id", "hashtags"))
    counts = _sliding(spark, s, "hashtag", 1, "stream_top_hashtags")
    return top_k_change_points(counts.buckets(spark), "hashtag", 300, 1)


@query("stream_error_alarm", ORACLES["error_alarm_1s"])
def q_stream_error_alarm(spark, sf):
    lines = A.event_time(_staged(spark, weblog_dense(spark, sf), "event_id", "weblog_dense"))
    classes = W.status_classes(lines, keep=("ts",))
    counts = _sliding(spark, classes, "status_class", 1, "stream_error_alarm")
    return W.alarm_change_points(counts.buckets(spark), 300, 1)


# -- STM2 / AGG2 / APP2: windows and alarm verdicts as they leave the stream, trigger by trigger -----------------
def _tagged(stream, out, name, mode="update"):
    """Run a stream of changes to its end; its rows by the batch that gave them out."""
    body = per_batch(out, lambda df, bid: df.withColumn("batch_id", F.lit(bid).cast("bigint")))
    run_available(stream.writeStream.outputMode(mode).foreachBatch(body).option("checkpointLocation", checkpoint_for(stream.sparkSession, name)))
    return stream.sparkSession.read.parquet(out)


_LIVE_CLASSES = D.with_(D.WEBLOG_DENSE, f"""c as (select event_id, epoch_us(ts) - epoch_us(ts) % 1000000 as b,
  {D.status_class(f"case when {D.matched()} then {D.grp(6)} else '[error]' end")} as c from weblog)""",
                        D.parts("c", "event_id", PARTS), """
n as (select b, batch_id, count(*) filter (c = 'Success') as ok, count(*) filter (c = 'Failure') as err from parts group by all),
s as (select batch_id, max(max(b) + 1000000) over (order by batch_id) as now from n group by batch_id),
t as (select distinct unnest([b + 1000000, b + 301000000]) as t from n)""")


@query("stream_error_alarm_live", _LIVE_CLASSES + """
, w as (select t, cast(sum(ok) as bigint) as n_success, cast(sum(err) as bigint) as n_failure
        from t join n on b >= t - 300000000 and b < t group by t
        union all select t, 0, 0 from t where not exists (select 1 from n where b >= t.t - 300000000 and b < t.t))
select (select min(batch_id) from s where now >= t) as batch_id, make_timestamp(t) as window_end, n_success, n_failure,
       case when n_success + n_failure <= 100 then 'insufficient' when n_failure > 0.5 * n_success then 'alarm' else 'ok' end as verdict
from w where t <= (select max(now) from s)""")
def q_stream_error_alarm_live(spark, sf):
    lines = A.event_time(_staged(spark, weblog_dense(spark, sf), "event_id", "weblog_dense"))
    changes = live_alarm(W.status_classes(lines, keep=("ts",)))
    out = _tagged(changes, fresh_dir(spark, "out/stream_error_alarm_live"), "stream_error_alarm_live")
    return out.select("batch_id", "window_end", "n_success", "n_failure", "verdict")


# -- APP4 / STM3 / STM4 / SNK3: hourly status counts in complete mode ----------------------
@query("stream_status_hourly", ORACLES["status_hourly"])
def q_stream_status_hourly(spark, sf):
    path = stage_parts(spark, weblog(spark, sf), "event_id", PARTS, "weblog_text", fmt="text",
                       columns=["line"])
    lines = read_lines(spark, "text_dir", path=path.path, max_files_per_trigger=path.files)
    out = fresh_dir(spark, "out/stream_status_hourly")
    run_available(A.status_hourly_stream(lines).writeStream.outputMode("complete")
                  .foreachBatch(lambda df, bid: write_batch(df, out, 0))
                  .option("checkpointLocation", checkpoint_for(spark, "stream_status_hourly")))
    return spark.read.parquet(f"{out}/batch_id=0").select("window_start", "window_end", "status", "n")


# -- APP6 / STM5 / STM6 / STM7: sessions with carried state -----------------------------------
def _session_stream(spark, sf, name, **options):
    req = W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts")).select("ip", "event_id", "ts", "url")
    sink = SessionStream(fresh_dir(spark, f"out/{name}"), **options)
    run_available(_staged(spark, req, "event_id", "requests").writeStream.foreachBatch(sink)
                  .option("checkpointLocation", checkpoint_for(spark, name)))
    return sink


@query("stream_sessions", ORACLES["session_running"])
def q_stream_sessions(spark, sf):
    sink = _session_stream(spark, sf, "stream_sessions")
    return spark.read.parquet(sink.rows).select(
        "ip", "event_id", "ts", "session_start", "session_length", F.array_join("clickstream", ",").alias("clickstream"))


@query("stream_session_snapshot", ORACLES["session_snapshot"])
def q_stream_session_snapshot(spark, sf):
    """State of every ip after each batch, shown under the batch as a SQL
    view; the result is the last."""
    def show(df, batch_id):
        print_batch(5)(df.sparkSession.sql("select ip, session_length, clickstream from sessions order by session_length desc, ip"),
                       batch_id)
    sink = _session_stream(spark, sf, "stream_session_snapshot", requests=False, on_snapshot=show)
    return sink.snapshot(spark).withColumn("clickstream", F.array_join("clickstream", ","))


# -- UDF4: a user function on keyed state -----------------------------------------------------------
@query("stream_sessions_udf", ORACLES["session_running"])
def q_stream_sessions_udf(spark, sf):
    req = W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts")).select("ip", "event_id", "ts", "url")
    s = A.event_time(_staged(spark, req, "event_id", "requests_udf"))
    out = fresh_dir(spark, "out/stream_sessions_udf")
    run_available(sessions_with_state(s).writeStream.outputMode("append").format("parquet")
                  .option("path", out).option("checkpointLocation", checkpoint_for(spark, "stream_sessions_udf")))
    r = spark.read.parquet(out)
    return r.select("ip", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                    F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                    "session_length", F.array_join("clickstream", ",").alias("clickstream"))


# -- STM5 / STM6 / STM7 / UDF4: sessions in Spark's keyed state ---------------------------------------
def _requests_stream(spark, sf, kind):
    req = W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts")).select("ip", "event_id", "ts", "url")
    return A.event_time(_staged(spark, req, "event_id", kind))


def _wall(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names}).withColumn("clickstream", F.array_join("clickstream", ","))


@query("stream_sessions_processor", ORACLES["session_running"])
def q_stream_sessions_processor(spark, sf):
    out = fresh_dir(spark, "out/stream_sessions_processor")
    changes = keyed_sessions(_requests_stream(spark, sf, "requests_processor"))
    rows = _tagged(changes, out, "stream_sessions_processor")
    return _wall(rows, "ts", "session_start").select("ip", "event_id", "ts", "session_start", "session_length", "clickstream")


@query("stream_session_expired", D.with_(D.WEBLOG, session_queries._SESS) + f"""
, m as (select max(epoch_ms(ts)) as mark from weblog),
o as (select *, lead(session_start) over (partition by ip order by session_start) as next from f)
select ip, session_start, session_end, session_length, array_to_string(urls, ',') as clickstream
from o, m where next is not null or mark > (epoch_us(session_end) + {session_queries.T_US}) // 1000""")
def q_stream_session_expired(spark, sf):
    """Sessions that are over: the key's next request came after the timeout,
    or the last watermark (the newest request of all) has passed the last
    request and the timeout."""
    out = fresh_dir(spark, "out/stream_session_expired")
    ended = keyed_sessions(_requests_stream(spark, sf, "requests_expired"), emit="ended", time_mode="EventTime")
    rows = _tagged(ended, out, "stream_session_expired")
    return _wall(rows, "session_start", "session_end").select("ip", "session_start", "session_end", "session_length", "clickstream")


@query("stream_state_snapshot", ORACLES["session_snapshot"])
def q_stream_state_snapshot(spark, sf):
    """The newest session of every ip, read from the state store."""
    checkpoint = checkpoint_for(spark, "stream_state_snapshot")
    changes = keyed_sessions(_requests_stream(spark, sf, "requests_snapshot"))
    run_available(changes.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint))
    return open_sessions(spark, checkpoint).withColumn("clickstream", F.array_join("clickstream", ","))


# -- APP5 / SNK7 / STM6: requests stored by ip (upsert) ------------------------------------------
@query("stream_requests_by_ip", ORACLES["requests_by_ip_latest"])
def q_stream_requests_by_ip(spark, sf):
    req = W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts"))
    s = _staged(spark, req, "event_id", "requests_ip")
    store = KeyedStore(fresh_dir(spark, "out/requests_by_ip"), "ip", ["ts", "event_id"],
                       ["url", "status", "agent"], mode="upsert")
    run_available(s.writeStream.foreachBatch(store)
                  .option("checkpointLocation", checkpoint_for(spark, "requests_by_ip")))
    return store.read(spark).select("ip", "ts", "event_id", "url", "status", "agent")


# -- SNK8: a sink of our own with a commit per batch ---------------------------------------------
@query("stream_custom_sink", ORACLES["requests_by_ip_append"])
def q_stream_custom_sink(spark, sf):
    req = W.requests_by_ip(weblog(spark, sf), keep=("event_id",)).select("event_id", "ip", "url", "status", "agent")
    out = fresh_dir(spark, "out/custom_sink")
    run_available(folder_writer(_staged(spark, req, "event_id", "requests_sink"), out)
                  .option("checkpointLocation", checkpoint_for(spark, "custom_sink")))
    return read_committed(spark, out, req.schema)


# -- AGG8 / SNK7: rows of each batch, counted while they are written ------------------------------------
@query("stream_batch_rowcount", D.with_(D.WEBLOG, D.parts("weblog", "event_id", PARTS)) + "select batch_id, count(*) as n from parts group by all")
def q_stream_batch_rowcount(spark, sf):
    out, totals = fresh_dir(spark, "out/batch_rows"), fresh_dir(spark, "out/batch_rowcount")

    def body(df, batch_id):
        n = write_counted(df, out, batch_id)
        write_batch(df.sparkSession.createDataFrame([(batch_id, n)], "batch_id long, n long").coalesce(1), totals, batch_id)
    lines = _staged(spark, weblog(spark, sf), "event_id", "weblog_counted")
    run_available(lines.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_for(spark, "batch_rowcount")))
    return spark.read.parquet(totals).select("batch_id", "n")


# -- APP3 / SNK9 / STM9: SQL on every batch ---------------------------------------------------------
AGENTS_SQL = "select agent, count(*) as total from requests group by agent"  # fixed value: the query under test


@query("stream_log_agents_sql", D.with_(D.WEBLOG, D.parts("weblog", "event_id", PARTS)) + f"""
select batch_id, agent, count(*) as total from ({_RECORD_SQL}) join (select event_id, batch_id from parts) using (event_id)
group by all""")
def q_stream_log_agents_sql(spark, sf):
    req = W.request_records(weblog(spark, sf), keep=("event_id", "ts"))
    s = _staged(spark, req, "event_id", "requests_rec")
    out = fresh_dir(spark, "out/log_agents_sql")
    run_available(s.writeStream.foreachBatch(
        sql_per_batch(out, "requests", AGENTS_SQL))
        .option("checkpointLocation", checkpoint_for(spark, "log_agents_sql")))
    return spark.read.parquet(out).select("batch_id", "agent", "total")


# -- STM9 / FLT3: a per-batch action that knows its batch ---------------------------------------------
@query("stream_foreach_batch", D.with_(D.WEBLOG) + f"""
, b as (select min(event_id) as lo, (max(event_id) - min(event_id)) // {PARTS} + 1 as width from weblog)
select cast((event_id - lo) // width as bigint) as batch_id,
       {D.status_class(f"case when {D.matched()} then {D.grp(6)} else '[error]' end")} as status_class,
       count(*) as n
from weblog, b group by all""")
def q_stream_foreach_batch(spark, sf):
    """Status-class counts of every micro-batch, tagged with its batch id
    (the staged parts are event-id ranges, one part per batch)."""
    cls = W.status_classes(weblog(spark, sf), keep=("event_id",))
    s = _staged(spark, cls, "event_id", "status_classes")
    out = fresh_dir(spark, "out/foreach_batch")
    body = per_batch(out, lambda df, bid: df.groupBy("status_class").agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("batch_id", F.lit(bid).cast("bigint")))
    run_available(s.writeStream.foreachBatch(body)
                  .option("checkpointLocation", checkpoint_for(spark, "foreach_batch")))
    return spark.read.parquet(out).select("batch_id", "status_class", "n")


# -- APP8 / APP9 / STM13: running totals across batches ------------------------------------------------
_POST_PARTS = D.with_(D.POSTS, D.parts("posts", "post_id", PARTS))


@query("stream_post_length", _POST_PARTS + f"""
select batch_id, cast(sum(n) over w as bigint) as n_posts, cast(sum(c) over w as bigint) as total_chars,
       cast(max(m) over w as bigint) as max_len, cast(sum(c) over w // sum(n) over w as bigint) as avg_len
from (select batch_id, count(*) as n, sum({u16('text')}) as c, max({u16('text')}) as m from parts group by all)
window w as (order by batch_id rows between unbounded preceding and current row)""")
def q_stream_post_length(spark, sf):
    s = _staged(spark, posts(spark, sf), "post_id", "posts")
    out = fresh_dir(spark, "out/post_length")
    body = per_batch(out, lambda df, bid: df.withColumn("batch_id", F.lit(bid).cast("bigint"))
                     .withColumn("avg_len", F.expr("total_chars div n_posts")))
    run_available(A.length_totals_stream(s).writeStream.outputMode("complete").foreachBatch(body)
                  .option("checkpointLocation", checkpoint_for(spark, "post_length")))
    return spark.read.parquet(out).select("batch_id", "n_posts", "total_chars", "max_len", "avg_len")


# -- APP10 / SNK1: the first rows of each batch ------------------------------------------------------------
@query("print_posts_stream", _POST_PARTS + """
select batch_id, post_id, ts, text from (
  select *, row_number() over (partition by batch_id order by ts, post_id) as rn from parts) where rn <= 10""")
def q_print_posts_stream(spark, sf):
    s = _staged(spark, posts(spark, sf), "post_id", "posts_print")
    out = fresh_dir(spark, "out/print_posts")
    body = per_batch(out, lambda df, bid: df.orderBy("ts", "post_id").limit(10)
                     .withColumn("batch_id", F.lit(bid).cast("bigint")))
    run_available(s.writeStream.foreachBatch(body)
                  .option("checkpointLocation", checkpoint_for(spark, "print_posts")))
    return spark.read.parquet(out).select("batch_id", "post_id", "ts", "text")


# -- APP11 / SNK4 / SNK5 / SNK6 / STM1 / STM11 / STM12: save texts ----------------------------------------------
def _save(spark, sf, files_per_batch, name, limit=None):
    s = _staged(spark, posts(spark, sf), "post_id", "posts_save", parts=SAVE_PARTS)
    sink = SaveUntil(spark, fresh_dir(spark, f"out/{name}"), limit, files_per_batch)
    run_every(s.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_for(spark, name)),
              "0 seconds", lambda: sink.done)
    return spark.read.option("lineSep", RECORD_SEP).text(sink.out).select("value")


_ALL_POSTS = D.with_(D.POSTS) + "select text as value from posts"


@query("save_posts", _ALL_POSTS)
def q_save_posts(spark, sf):
    return _save(spark, sf, 1, "save_posts")


@query("save_posts_wide", _ALL_POSTS)
def q_save_posts_wide(spark, sf):
    return _save(spark, sf, None, "save_posts_wide")


@query("save_posts_limited", D.with_(D.POSTS, D.parts("posts", "post_id", SAVE_PARTS)) + f"""
, n as (select batch_id, count(*) as n from parts group by all),
r as (select batch_id, coalesce(sum(n) over (order by batch_id rows between unbounded preceding and 1 preceding), 0) as before from n)
select text as value from parts join r using (batch_id) where before <= {SAVE_LIMIT}""")
def q_save_posts_limited(spark, sf):
    """Whole batches up to the first total above the limit; there the query
    is stopped, with the offsets of the rest uncommitted."""
    return _save(spark, sf, 1, "save_posts_limited", SAVE_LIMIT)


@query("stream_text_sink", _ALL_POSTS)
def q_stream_text_sink(spark, sf):
    s = _staged(spark, posts(spark, sf), "post_id", "posts_text")
    out = fresh_dir(spark, "out/text_sink")
    run_available(s.select("text").writeStream.format("text").option("path", out)
                  .option("lineSep", RECORD_SEP)
                  .option("checkpointLocation", checkpoint_for(spark, "text_sink")))
    return spark.read.option("lineSep", RECORD_SEP).text(out)


# -- APP14 / ML1 / ML2 / STM14: streaming k-means on parsed lines, scoring from the stored model ----------------------
# Scaling of the lines, known before the stream begins: (value - base) / unit.
SCALES = {"income": (113000.0, 54000.0), "age": (45.0, 17.0)}


def _scaled_lines(spark, sf):
    """``[income,age]`` lines in scaled units."""
    parts = [F.format_string("%.6f", (F.col(c) - m) / u) for c, (m, u) in SCALES.items()]
    return blobs(spark, sf).select("id", "label", F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")).alias("line"))


_BLOB_PARTS = (D.BLOBS, "scaled as (select id, label, " + ", ".join(
    f"round(({c} - {m}) / {u}, 6) as {c[0]}" for c, (m, u) in SCALES.items()) + " from blobs)", D.parts("scaled", "id", PARTS))


def _centres_sql() -> str:
    """CTEs m0 (the start) to m<PARTS>: the model after each batch."""
    start = " union all ".join(f"select {i} as cluster, 0e0 as weight, {a}e0 as c0, {b}e0 as c1" for i, (a, b) in enumerate(KMEANS_START))
    out = [f"m0 as ({start})"]
    for b in range(PARTS):
        out.append(f"""a{b} as (select id, i, a, arg_min(cluster, (d, cluster)) as cluster from (
  select p.id, p.i, p.a, m.cluster, (p.i - m.c0) * (p.i - m.c0) + (p.a - m.c1) * (p.a - m.c1) as d
  from parts p, m{b} m where p.batch_id = {b}) group by all)""")
        out.append(f"""m{b + 1} as (select m.cluster, m.weight + coalesce(s.n, 0) as weight,
  (m.c0 * m.weight + coalesce(s.s0, 0)) / greatest(m.weight + coalesce(s.n, 0), 1e-16) as c0,
  (m.c1 * m.weight + coalesce(s.s1, 0)) / greatest(m.weight + coalesce(s.n, 0), 1e-16) as c1
  from m{b} m left join (select cluster, count(*) as n, sum(i) as s0, sum(a) as s1 from a{b} group by cluster) s using (cluster))""")
    return ",\n".join(out)


_KMEANS = D.with_(*_BLOB_PARTS, _centres_sql())


def _kmeans_stream(spark, sf):
    s = vectors_of(_staged(spark, _scaled_lines(spark, sf), "id", "blobs"), ["income", "age"])
    trainer = KMeansStream(fresh_dir(spark, "out/kmeans_model"), ["income", "age"], KMEANS_START, keep=PARTS + 1)
    run_available(s.writeStream.foreachBatch(trainer)
                  .option("checkpointLocation", checkpoint_for(spark, "kmeans_train")))
    return trainer


@query("stream_kmeans", _KMEANS + " union all ".join(
    f"select cast({b} as bigint) as batch_id, cluster, weight, round(c0, {ROUND}) as c0, round(c1, {ROUND}) as c1 from m{b + 1}"
    for b in range(PARTS)))
def q_stream_kmeans(spark, sf):
    models = _kmeans_stream(spark, sf).models
    return spark.read.parquet(models.path).select("batch_id", "cluster", "weight", *[F.round(c, ROUND).alias(c) for c in ("c0", "c1")])


@query("stream_train_and_score", _KMEANS + f"""
select label, cluster, count(*) as n from (
  select p.id, p.label, arg_min(m.cluster, ((p.i - m.c0) * (p.i - m.c0) + (p.a - m.c1) * (p.a - m.c1), m.cluster)) as cluster
  from parts p, m{PARTS} m group by p.id, p.label) group by all""")
def q_stream_train_and_score(spark, sf):
    trainer = _kmeans_stream(spark, sf)
    s = vectors_of(_staged(spark, _scaled_lines(spark, sf), "id", "blobs_test"), ["income", "age"])
    out = fresh_dir(spark, "out/kmeans_scores")
    body = per_batch(out, lambda df, bid: trainer.score(df).select("id", "label", "cluster"))
    run_available(s.writeStream.foreachBatch(body)
                  .option("checkpointLocation", checkpoint_for(spark, "kmeans_score")))
    return spark.read.parquet(out).groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("stream_train_and_score_live", _KMEANS + " union all ".join(f"""
select p.id, p.label, cast({b} as bigint) as model_batch,
       arg_min(m.cluster, ((p.i - m.c0) * (p.i - m.c0) + (p.a - m.c1) * (p.a - m.c1), m.cluster)) as cluster
from parts p, m{b + 1} m where p.batch_id = {b} group by p.id, p.label""" for b in range(PARTS)))
def q_stream_train_and_score_live(spark, sf):
    """Two queries at work at once. Parts are put into the folder of the
    training query and then into that of the scoring one, so each part is
    scored by the model that has just seen it, and all but the last while
    training goes on."""
    lines = _scaled_lines(spark, sf)
    staged = stage_parts(spark, lines, "id", PARTS, "blobs_live")
    parts = spark.read.option("recursiveFileLookup", "false").parquet(staged.path)
    feeds = {name: fresh_dir(spark, f"blobs_{name}") for name in ("train", "score")}
    for feed in feeds.values():
        write_batch(parts.where("_part < 0").select(*lines.columns), feed, -1)  # a folder to begin with
    trainer = KMeansStream(fresh_dir(spark, "out/kmeans_live_model"), ["income", "age"], KMEANS_START, keep=PARTS + 2)
    scorer = PinnedScorer(trainer, fresh_dir(spark, "out/kmeans_live_scores"), ["id", "label", "cluster"])
    running = {}
    for name, sink in (("train", trainer), ("score", scorer)):
        rows = file_stream(spark, feeds[name], lines.schema, "parquet", 1000)
        running[name] = (vectors_of(rows, ["income", "age"]).writeStream.foreachBatch(skip_empty(sink))
                         .option("checkpointLocation", checkpoint_for(spark, f"kmeans_live_{name}"))
                         .trigger(processingTime="0 seconds").start())
    try:
        for b in range(PARTS):
            for name, q in running.items():
                write_batch(parts.where(F.col("_part") == b).select(*lines.columns), feeds[name], b, files=1)  # there at once, or not
                q.processAllAvailable()
    finally:
        for q in running.values():
            q.stop()
    models = spark.read.parquet(trainer.models.path).select(F.col("batch_id").alias("model_batch")).distinct()
    order = models.withColumn("_b", F.row_number().over(Window.orderBy("model_batch")) - 1)  # a row per part
    return (spark.read.parquet(scorer.out).join(F.broadcast(order), "model_batch")
            .select("id", "label", F.col("_b").cast("bigint").alias("model_batch"), "cluster"))


# -- APP15 / ML4 / ML5: streaming linear regression on parsed lines, and its scoring ----------------------------------
def _point_lines(spark, sf):
    """``y,x`` lines."""
    return points(spark, sf).select("id", F.concat_ws(",", F.format_string("%.6f", "y"), F.format_string("%.6f", "x")).alias("line"))


def _regression_sql() -> str:
    """CTEs w0 to w<PARTS>: slope and intercept after each batch's gradient
    steps (step 0.1 / sqrt(t), at most 50, until the weights settle)."""
    out = ["w0 as (select 0e0 as w, 0e0 as c)"]
    for b in range(PARTS):
        out.append(f"""q{b} as (select avg(x * x) as xx, avg(x) as x, avg(x * y) as xy, avg(y) as y from parts where batch_id = {b})""")
        out.append(f"""g{b} as (select 0 as t, w, c, false as settled from w{b}
  union all
  select t + 1, nw, nc, sqrt((nw - w) * (nw - w) + (nc - c) * (nc - c)) < 0.001e0 * greatest(sqrt(nw * nw + nc * nc), 1e0)
  from (select g.t, g.w, g.c, g.w - 0.1e0 / sqrt(g.t + 1) * (q.xx * g.w + q.x * g.c - q.xy) as nw,
               g.c - 0.1e0 / sqrt(g.t + 1) * (q.x * g.w + g.c - q.y) as nc
        from g{b} g, q{b} q where not g.settled and g.t < 50))""")
        out.append(f"w{b + 1} as (select arg_max(w, t) as w, arg_max(c, t) as c from g{b})")
    return ",\n".join(out)


_REGRESSION = D.with_(D.POINTS, D.parts("points", "id", PARTS), _regression_sql()).replace("with ", "with recursive ", 1)


def _regression_stream(spark, sf):
    s = labeled_of(_staged(spark, _point_lines(spark, sf), "id", "points"), "y", ["x"])
    trainer = RegressionStream(fresh_dir(spark, "out/regression_model"), ["x"], "y", keep=PARTS + 1)
    run_available(s.writeStream.foreachBatch(trainer)
                  .option("checkpointLocation", checkpoint_for(spark, "regression")))
    return trainer


@query("stream_regression", _REGRESSION + " union all ".join(
    f"select cast({b} as bigint) as batch_id, round(w, {ROUND}) as slope, round(c, {ROUND}) as intercept from w{b + 1}" for b in range(PARTS)))
def q_stream_regression(spark, sf):
    models = _regression_stream(spark, sf).models
    return spark.read.parquet(models.path).select("batch_id", F.round("w0", ROUND).alias("slope"), F.round("intercept", ROUND).alias("intercept"))


@query("stream_regression_score", _REGRESSION + f"select id, y, round(w * x + c, {ROUND}) as y_hat from points, w{PARTS}")
def q_stream_regression_score(spark, sf):
    """Known label and prediction, by the newest stored model."""
    trainer = _regression_stream(spark, sf)
    s = labeled_of(_staged(spark, _point_lines(spark, sf), "id", "points_test"), "y", ["x"])
    out = fresh_dir(spark, "out/regression_scores")
    body = per_batch(out, lambda df, bid: trainer.score(df).select("id", "y", F.round("y_hat", ROUND).alias("y_hat")))
    run_available(s.writeStream.foreachBatch(body)
                  .option("checkpointLocation", checkpoint_for(spark, "regression_score")))
    return spark.read.parquet(out).select("id", "y", "y_hat")
