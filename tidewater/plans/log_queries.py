"""Access-log queries over the ``weblog`` views, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import weblog as W
from tidewater.operators.reduce_windows import reduce_windows
from tidewater.operators.windows import (
    US,
    bucket_counts,
    floor_to,
    sliding_change_points,
    sliding_counts,
    to_micros,
    top_k_change_points,
    top_k_per_window,
)
from tidewater.plans import duck as D
from tidewater.plans.registry import query
from tidewater.sources.tables import weblog, weblog_dense

# Query parameters: the reference's 300 s window; the correctness queries
# slide every 60 s (the compact form slides every second, as the reference).
WINDOW_S = 300
SLIDE_S = 60
BATCH_S = 3600
TOP_K = 10

# -- PRJ1 / PRJ7 / SCL1 ------------------------------------------------------
@query("parse_log", D.with_(D.WEBLOG) + f"""
select event_id, nullif({D.grp(1)}, '') as ip, {D.grp(2)} as client, {D.grp(3)} as "user",
       {D.grp(4)} as date_time, {D.grp(5)} as request, {D.grp(6)} as status,
       {D.grp(7)} as bytes, {D.grp(8)} as referer, {D.grp(9)} as agent
from weblog where {D.matched()}""")
def q_parse_log(spark, sf):
    return W.parse_log(weblog(spark, sf))


# -- PRJ2 ---------------------------------------------------------------------
@query("extract_request", D.with_(D.WEBLOG) + f"""
select event_id, {D.request_or_unit()} as request from weblog""")
def q_extract_request(spark, sf):
    return W.extract_request(weblog(spark, sf))


# -- PRJ3 ---------------------------------------------------------------------
@query("url_strict", D.with_(D.WEBLOG) + f"""
select event_id, {D.url_strict(D.request_or_unit())} as url from weblog""")
def q_url_strict(spark, sf):
    return W.strict_urls(weblog(spark, sf), keep=("event_id",))


# -- PRJ4 / SCL7 ----------------------------------------------------------------
@query("url_lenient", D.with_(D.WEBLOG) + f"""
select event_id, case when {D.matched()} then {D.url_lenient(D.grp(5))} else 'error' end as url
from weblog""")
def q_url_lenient(spark, sf):
    return W.lenient_urls(weblog(spark, sf))


# -- PRJ5 / PRJ6 ----------------------------------------------------------------
_RECORD_SQL = f"""
select event_id, ts,
       case when {D.matched()} then {D.url_lenient(D.grp(5))} else 'error' end as url,
       case when {D.matched()} then cast({D.grp(6)} as integer) else 0 end as status,
       case when {D.matched()} then {D.grp(9)} else 'error' end as agent,
       case when {D.matched()} then nullif({D.grp(1)}, '') else 'error' end as ip
from weblog"""


@query("request_record", D.with_(D.WEBLOG) + "select event_id, url, status, agent from (" + _RECORD_SQL + ")")
def q_request_record(spark, sf):
    return W.request_records(weblog(spark, sf), keep=("event_id",))


# -- FLT2 / SCL6 ----------------------------------------------------------------
@query("status_class", D.with_(D.WEBLOG) + f"""
select event_id, {D.status_class(f"case when {D.matched()} then {D.grp(6)} else '[error]' end")} as status_class
from weblog""")
def q_status_class(spark, sf):
    return W.status_classes(weblog(spark, sf), keep=("event_id",))


# -- SCL5 -------------------------------------------------------------------------
@query("log_time", D.with_(D.WEBLOG) + f"""
select event_id, {D.log_time(D.grp(4))} as log_time from weblog where {D.matched()}""")
def q_log_time(spark, sf):
    return W.log_times(weblog(spark, sf))


# -- AGG5 / ORD2 / APP4 -------------------------------------------------------------
@query("status_hourly", D.with_(D.WEBLOG, f"""p as (select {D.grp(6)} as status, {D.log_time(D.grp(4))} as t
  from weblog where {D.matched()})""") + f"""
select * from {D.sliding('p', 't', ['status'], 3600, 3600)}""")
def q_status_hourly(spark, sf):
    return W.status_hourly(weblog(spark, sf)).orderBy("window_start", "status")


# -- AGG1 (a) -----------------------------------------------------------------------
_URLS = f"u as (select ts, {D.url_strict(D.request_or_unit())} as url from weblog)"


@query("sliding_url_counts", D.with_(D.WEBLOG, _URLS) + f"""
select * from {D.sliding('u', 'ts', ['url'], WINDOW_S, SLIDE_S)}""")
def q_sliding_url_counts(spark, sf):
    return sliding_counts(W.strict_urls(weblog(spark, sf)), "ts", ["url"], WINDOW_S, SLIDE_S)


# -- AGG1 (b): the add/subtract form at the reference's 1 s slide ----------------------
@query("sliding_counts_compact", D.with_(D.WEBLOG, _URLS) + f"""
, b as (select url, epoch_us(ts) - epoch_us(ts) % 1000000 as b, count(*) as c from u group by all),
d as (select url, b + 1000000 as t, c as d from b
      union all select url, b + 1000000 + {WINDOW_S * 1_000_000}, -c from b),
s as (select url, t, sum(d) as d from d group by all having sum(d) <> 0)
select make_timestamp(t) as window_end, url,
       cast(sum(d) over (partition by url order by t rows between unbounded preceding and current row) as bigint) as n
from s""")
def q_sliding_counts_compact(spark, sf):
    return sliding_change_points(W.strict_urls(weblog(spark, sf)), "ts", ["url"], WINDOW_S, 1)


# -- ORD1 / ORD3 / APP1 (flagship) --------------------------------------------------------
@query("top_urls", D.with_(D.WEBLOG, _URLS) + f"""
select * from (
  select *, cast(row_number() over (partition by window_start, window_end
                                    order by n desc, url asc nulls first) as integer) as rank
  from {D.sliding('u', 'ts', ['url'], WINDOW_S, SLIDE_S)}) where rank <= {TOP_K}""")
def q_top_urls(spark, sf):
    counts = sliding_counts(W.strict_urls(weblog(spark, sf)), "ts", ["url"], WINDOW_S, SLIDE_S)
    return top_k_per_window(counts, "url", TOP_K)


# -- AGG2 / AGG9 / AGG10 / APP2 on the dense view -------------------------------------------
_STATUS_TEXT = f"case when {D.matched()} then {D.grp(6)} else '[error]' end"
_CLASSES = f"c as (select ts, {D.status_class(_STATUS_TEXT)} as status_class from weblog)"
_TOTALS = f"""t as (select window_start, window_end,
   cast(sum(case when status_class = 'Success' then n else 0 end) as bigint) as n_success,
   cast(sum(case when status_class = 'Failure' then n else 0 end) as bigint) as n_failure
 from {D.sliding('c', 'ts', ['status_class'], WINDOW_S, SLIDE_S)} group by all)"""


@query("status_sliding_counts", D.with_(D.WEBLOG_DENSE, _CLASSES) + f"""
select * from {D.sliding('c', 'ts', ['status_class'], WINDOW_S, SLIDE_S)}""")
def q_status_sliding_counts(spark, sf):
    return W.status_sliding_counts(weblog_dense(spark, sf), WINDOW_S, SLIDE_S)


@query("alarm_totals", D.with_(D.WEBLOG_DENSE, _CLASSES, _TOTALS) + "select * from t")
def q_alarm_totals(spark, sf):
    return W.alarm_totals(weblog_dense(spark, sf), WINDOW_S, SLIDE_S)


@query("error_alarm", D.with_(D.WEBLOG_DENSE, _CLASSES, _TOTALS) + f"""
select *, case when n_success + n_failure <= {W.ALARM_FLOOR} then 'insufficient'
               when n_failure > {W.ALARM_RATIO} * n_success then 'alarm' else 'ok' end as verdict
from t""")
def q_error_alarm(spark, sf):
    return W.error_alarm(weblog_dense(spark, sf), WINDOW_S, SLIDE_S)


# -- AGG10 / APP2 at the reference's 1 s slide: totals and verdict at every change ---------------
ALARM_1S = D.with_(D.WEBLOG_DENSE, _CLASSES) + f"""
, b as (select epoch_us(ts) - epoch_us(ts) % 1000000 as b, count(*) filter (status_class = 'Success') as s,
               count(*) filter (status_class = 'Failure') as f from c group by all),
d as (select b + 1000000 as t, s, f from b union all select b + 1000000 + {WINDOW_S * 1_000_000}, -s, -f from b),
g as (select t, sum(s) as s, sum(f) as f from d group by t having sum(s) <> 0 or sum(f) <> 0),
r as (select make_timestamp(t) as window_end, cast(sum(s) over w as bigint) as n_success,
             cast(sum(f) over w as bigint) as n_failure
      from g window w as (order by t rows between unbounded preceding and current row))
select *, case when n_success + n_failure <= {W.ALARM_FLOOR} then 'insufficient'
               when n_failure > {W.ALARM_RATIO} * n_success then 'alarm' else 'ok' end as verdict from r"""


@query("error_alarm_1s", ALARM_1S)
def q_error_alarm_1s(spark, sf):
    return W.error_alarm_compact(weblog_dense(spark, sf), WINDOW_S, 1)


# -- APP1 at the reference's 1 s slide: top URLs at every change ------------------------------------
TOP_URLS_1S = D.with_(D.WEBLOG, _URLS) + D.top_change_points("u", "url", WINDOW_S, TOP_K)


@query("top_urls_1s", TOP_URLS_1S)
def q_top_urls_1s(spark, sf):
    urls = W.strict_urls(weblog(spark, sf))
    return top_k_change_points(bucket_counts(urls, "ts", ["url"], 1), "url", WINDOW_S, 1, TOP_K)


# -- AGG4 / SNK9 / PRJ8 / APP3: SQL on each batch ----------------------------------------------
@query("log_agents_sql", D.with_(D.WEBLOG) + f"""
select make_timestamp(epoch_us(ts) - epoch_us(ts) % {BATCH_S * 1_000_000}) as batch_start,
       agent, count(*) as total
from ({_RECORD_SQL}) group by all""")
def q_log_agents_sql(spark, sf):
    from tidewater.streaming.batches import batch_start
    recs = W.request_records(weblog(spark, sf), keep=("ts",))
    recs.select(batch_start("ts", BATCH_S).alias("batch_start"), "url", "status", "agent") \
        .createOrReplaceTempView("requests")
    return spark.sql("select batch_start, agent, count(*) as total from requests "
                     "group by batch_start, agent")


# -- AGG8: rows per batch --------------------------------------------------------------------------
@query("batch_rowcount", D.with_(D.WEBLOG) + f"""
select make_timestamp(epoch_us(ts) - epoch_us(ts) % {BATCH_S * 1_000_000}) as batch_start, count(*) as n
from weblog group by all""")
def q_batch_rowcount(spark, sf):
    from tidewater.streaming.batches import batch_start
    wl = weblog(spark, sf)
    return wl.groupBy(batch_start("ts", BATCH_S).alias("batch_start")).agg(F.count(F.lit(1)).alias("n"))


# -- SNK7 / APP5: requests stored by ip --------------------------------------------------------------
@query("requests_by_ip_append", D.with_(D.WEBLOG) + """
select event_id, ip, url, status, agent from (""" + _RECORD_SQL + ")")
def q_requests_by_ip_append(spark, sf):
    return W.requests_by_ip(weblog(spark, sf), keep=("event_id",))


@query("requests_by_ip_latest", D.with_(D.WEBLOG) + """
select ip, ts, event_id, url, status, agent from (
  select *, row_number() over (partition by ip order by ts desc, event_id desc) as rn
  from (""" + _RECORD_SQL + ")) where rn = 1")
def q_requests_by_ip_latest(spark, sf):
    recs = W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts"))
    return W.latest_by_key(recs, "ip", ["ts", "event_id"], ["url", "status", "agent"])


# -- SRC4 / SRC5: message payloads to lines ------------------------------------------------------------
@query("decode_kafka_records", D.with_(D.WEBLOG) + """
select 'weblog' as topic, cast(event_id % 4 as integer) as "partition", event_id as "offset", line from weblog""")
def q_decode_kafka_records(spark, sf):
    from tidewater.sources.streams import as_kafka_records, kafka_lines
    return kafka_lines(as_kafka_records(weblog(spark, sf))).select("topic", "partition", "offset", "line")


@query("decode_bytes", D.with_(D.WEBLOG) + """
select event_id, line, cast(strlen(line) as bigint) as n_bytes from weblog""")
def q_decode_bytes(spark, sf):
    from tidewater.sources.streams import decode_bytes
    b = weblog(spark, sf).select("event_id", F.encode("line", "UTF-8").alias("value"))
    return b.select("event_id", decode_bytes("value").alias("line"),
                    F.octet_length("value").cast("bigint").alias("n_bytes"))


# -- UDF2: windows of a reduce function given by the user, without and with its inverse ---------------
def longer(a: int, b: int) -> int:
    """A reduce function that cannot be undone."""
    return max(a, b)


def joined_stats(a: dict, b: dict) -> dict:
    """A reduce function on structs that cannot be undone."""
    return {"n": a["n"] + b["n"], "total": a["total"] + b["total"], "low": min(a["low"], b["low"]), "high": max(a["high"], b["high"])}


def joined_sums(a: dict, b: dict) -> dict:
    return {"n": a["n"] + b["n"], "total": a["total"] + b["total"]}


def parted_sums(whole: dict, part: dict) -> dict:
    """The inverse of ``joined_sums``."""
    return {"n": whole["n"] - part["n"], "total": whole["total"] - part["total"]}


def _bytes_by_status(spark, sf):
    lines = W.parse_log(weblog_dense(spark, sf), keep=("event_id", "ts"))
    return (lines.select("status", F.col("bytes").try_cast("bigint").alias("bytes"), floor_to(to_micros("ts"), US).alias("_b"))
            .where("bytes is not null").groupBy("status", "_b"))


def _window_oracle(*columns: str) -> str:
    return D.with_(D.WEBLOG_DENSE, f"""p as (select {D.grp(6)} as status, try_cast({D.grp(7)} as bigint) as bytes,
  epoch_us(ts) - epoch_us(ts) % 1000000 as b from weblog where {D.matched()})""") + f"""
, t as (select distinct status, unnest([b + 1000000, b + {(WINDOW_S + 1) * 1_000_000}]) as t from p where bytes is not null)
select t.status, make_timestamp(t) as window_end, {', '.join(columns)}
from t left join p on p.status = t.status and b >= t - {WINDOW_S * 1_000_000} and b < t group by t.status, t"""


_SUMS = ("nullif(count(bytes), 0) as n", "cast(sum(bytes) as bigint) as total")


@query("reduce_window_max", _window_oracle("max(bytes) as bytes"))
def q_reduce_window_max(spark, sf):
    per = _bytes_by_status(spark, sf).agg(F.max("bytes").alias("bytes"))
    return reduce_windows(per, ["status"], "bytes", longer, WINDOW_S, 1)


@query("reduce_window_stats", _window_oracle(*_SUMS, "min(bytes) as low", "max(bytes) as high"))
def q_reduce_window_stats(spark, sf):
    stats = F.struct(F.count("bytes").alias("n"), F.sum("bytes").alias("total"), F.min("bytes").alias("low"), F.max("bytes").alias("high"))
    out = reduce_windows(_bytes_by_status(spark, sf).agg(stats.alias("s")), ["status"], "s", joined_stats, WINDOW_S, 1)
    return out.select("status", "window_end", "s.*")


@query("reduce_window_sums", _window_oracle(*_SUMS))
def q_reduce_window_sums(spark, sf):
    sums = F.struct(F.count("bytes").alias("n"), F.sum("bytes").alias("total"))
    out = reduce_windows(_bytes_by_status(spark, sf).agg(sums.alias("s")), ["status"], "s", joined_sums, WINDOW_S, 1, parted_sums)
    return out.select("status", "window_end", "s.*")
