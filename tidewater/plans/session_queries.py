"""Session queries (keyed state with a 30-minute idle timeout, batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import sessions as S
from tidewater.operators import weblog as W
from tidewater.plans import duck as D
from tidewater.plans.log_queries import _RECORD_SQL
from tidewater.plans.registry import query
from tidewater.sources.tables import weblog

T_US = S.SESSION_TIMEOUT_S * 1_000_000
K = S.CLICKSTREAM_MAX

_SESS = f"""r as (select event_id, ts, ip, url from ({_RECORD_SQL})),
g as (select *, case when lag(ts) over w is null
                       or epoch_us(ts) - epoch_us(lag(ts) over w) > {T_US} then 1 else 0 end as new
      from r window w as (partition by ip order by ts, event_id)),
s as (select *, sum(new) over (partition by ip order by ts, event_id
                               rows between unbounded preceding and current row) as sid from g),
n as (select *, row_number() over (partition by ip, sid order by ts, event_id) as session_length,
             min(ts) over (partition by ip, sid) as session_start from s),
f as (select ip, sid, list(url order by session_length) filter (where session_length <= {K}) as urls,
             min(ts) as session_start, max(ts) as session_end, count(*) as session_length
      from n group by ip, sid)"""


def _requests(spark, sf):
    return W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts"))


def _join(c):
    return F.array_join(c, ",")


@query("session_running", D.with_(D.WEBLOG, _SESS) + f"""
select n.ip, n.event_id, n.ts, n.session_start, n.session_length,
       array_to_string(f.urls[1:least(n.session_length, {K})], ',') as clickstream
from n join f on n.ip is not distinct from f.ip and n.sid = f.sid""")
def q_session_running(spark, sf):
    r = S.running_sessions(_requests(spark, sf))
    return r.select("ip", "event_id", "ts", "session_start", "session_length",
                    _join("clickstream").alias("clickstream"))


@query("sessions_gap30", D.with_(D.WEBLOG, _SESS) + """
select ip, session_start, session_end, session_length, array_to_string(urls, ',') as clickstream from f""")
def q_sessions_gap30(spark, sf):
    s = S.sessions(_requests(spark, sf))
    return s.select("ip", "session_start", "session_end", "session_length",
                    _join("clickstream").alias("clickstream"))


@query("session_snapshot", D.with_(D.WEBLOG, _SESS) + """
select ip, session_start, session_end, session_length, array_to_string(urls, ',') as clickstream from (
  select *, row_number() over (partition by ip order by sid desc) as rn from f) where rn = 1""")
def q_session_snapshot(spark, sf):
    s = S.session_snapshot(_requests(spark, sf))
    return s.select("ip", "session_start", "session_end", "session_length",
                    _join("clickstream").alias("clickstream"))


# -- SCL9: the state update of one request (append the URL, keep the first ten) --------
@query("session_clickstream", D.with_(D.WEBLOG, _SESS) + f"""
, b as (select n.ip, n.event_id, n.url, f.urls[1:least(n.session_length - 1, {K})] as before
        from n join f on n.ip is not distinct from f.ip and n.sid = f.sid)
select ip, event_id, array_to_string(before, ',') as clickstream_before,
       array_to_string(list_concat(before, [url])[1:{K}], ',') as clickstream
from b""")
def q_session_clickstream(spark, sf):
    r = S.running_sessions(_requests(spark, sf))
    before = F.slice("clickstream", 1, F.least(F.col("session_length") - 1, F.lit(K)).cast("int"))
    r = r.select("ip", "event_id", "url", before.alias("before"))
    return r.select("ip", "event_id", _join("before").alias("clickstream_before"),
                    _join(S.append_keep_first("before", "url", K)).alias("clickstream"))
