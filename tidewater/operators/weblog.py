"""Access-log operators: parse, URL rules, status classes, alarm, store.

Each takes a DataFrame with a ``line`` column (plus whatever columns the
caller keeps, e.g. ``event_id`` and ``ts``) and works on a bounded or a
streaming DataFrame alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import logparse as lp
from tidewater.functions.text import jvm_split
from tidewater.operators.windows import (
    bucket_counts,
    from_micros,
    running_deltas,
    sliding_counts,
    tumbling_counts,
)

# Fixed values of the alarm (reference settings).
ALARM_FLOOR = 100       # no verdict unless more than this many rows
ALARM_RATIO = 0.5       # failures / successes above this raise the alarm


def _packed(df: DataFrame, line: str, keep) -> DataFrame:
    """The kept columns and the packed fields ``_f``: the regex runs once per
    line, whatever is read from it later."""
    return df.select(*keep, lp.packed_fields(line).alias("_f"))


def _matching(df: DataFrame, line: str, keep) -> DataFrame:
    """As ``_packed`` for the lines that match. They are exploded from an
    array of none or one: a filter on ``_f`` would be moved below the
    projection by Spark, which then runs the regex for both."""
    found = F.filter(F.array(lp.packed_fields(line)), lp.is_packed)
    return df.select(*keep, F.explode(found).alias("_f"))


def parse_log(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """Nine string fields per matching line; other lines are dropped."""
    keep = [c for c in keep if c in df.columns]
    return _matching(df, line, keep).select(*keep, *[lp.field("_f", f).alias(f) for f in lp.FIELDS])


def _requests_or_unit(df: DataFrame, line: str, keep, name: str) -> DataFrame:
    return _packed(df, line, keep).select(*keep, F.when(lp.is_packed("_f"), lp.field("_f", "request"))
                                          .otherwise(F.lit(lp.UNMATCHED_REQUEST)).alias(name))


def extract_request(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    return _requests_or_unit(df, line, [c for c in keep if c in df.columns], "request")


def strict_urls(df: DataFrame, line: str = "line", keep=("event_id", "ts")) -> DataFrame:
    """URL per line by the strict rule; unmatched lines give '[error]'."""
    keep = [c for c in keep if c in df.columns]
    t = _requests_or_unit(df, line, keep, "_req").select(*keep, jvm_split("_req").alias("_toks"))
    return t.select(*keep, lp.url_strict_of_tokens("_toks").alias("url"))


def request_records(df: DataFrame, line: str = "line", keep=("event_id", "ts"),
                    with_ip: bool = False) -> DataFrame:
    """(ip,) url, status int, agent per line; unmatched lines give the
    default row ('error', 0, 'error')."""
    keep = [c for c in keep if c in df.columns]
    m, err = lp.is_packed("_f"), F.lit(lp.RECORD_ERROR)
    fields = [F.when(m, lp.field("_f", "request")).alias("_req"), m.alias("_m"),
              F.when(m, lp.field("_f", "status").try_cast("int")).otherwise(F.lit(0)).alias("status"),
              F.when(m, lp.field("_f", "agent")).otherwise(err).alias("agent")]
    if with_ip:
        fields.insert(0, F.when(m, lp.field("_f", "ip")).otherwise(err).alias("ip"))
    g = _packed(df, line, keep).select(*keep, *fields)
    url = F.when(F.col("_m"), lp.url_lenient_of_tokens(jvm_split("_req"))).otherwise(err).alias("url")
    return g.select(*keep, *(["ip"] if with_ip else []), url, "status", "agent")


def lenient_urls(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    return request_records(df, line, keep).select(*[c for c in keep if c in df.columns], "url")


def status_classes(df: DataFrame, line: str = "line", keep=("event_id", "ts")) -> DataFrame:
    keep = [c for c in keep if c in df.columns]
    status = F.when(lp.is_packed("_f"), lp.field("_f", "status")).otherwise(F.lit(lp.STATUS_ERROR))
    return (_packed(df, line, keep).select(*keep, status.alias("_status"))
            .select(*keep, lp.status_class("_status").alias("status_class")))


def log_times(df: DataFrame, line: str = "line", keep=("event_id",)) -> DataFrame:
    """Request time of each matching line (null when the date is unreadable)."""
    keep = [c for c in keep if c in df.columns]
    return _matching(df, line, keep).select(*keep, lp.log_time(lp.field("_f", "date_time")).alias("log_time"))


def status_times(df: DataFrame, line: str = "line") -> DataFrame:
    """(status, log_time) of each matching line."""
    return (_matching(df, line, [])
            .select(lp.field("_f", "status").alias("status"), lp.log_time(lp.field("_f", "date_time")).alias("log_time")))


def status_hourly(df: DataFrame, line: str = "line") -> DataFrame:
    """Count by (status, 1-hour window of the request time), by window."""
    return tumbling_counts(status_times(df, line), "log_time", ["status"], 3600)


def status_sliding_counts(df: DataFrame, length_s: int = 300, slide_s: int = 60,
                          line: str = "line", ts: str = "ts") -> DataFrame:
    """Rows per (window, status class); zero counts do not appear."""
    return sliding_counts(status_classes(df, line, keep=(ts,)), ts, ["status_class"],
                          length_s, slide_s)


def alarm_totals(df: DataFrame, length_s: int = 300, slide_s: int = 60,
                 line: str = "line", ts: str = "ts") -> DataFrame:
    """Success and failure totals of every window (3xx/4xx count in neither)."""
    c = status_sliding_counts(df, length_s, slide_s, line, ts)
    return (c.groupBy("window_start", "window_end")
            .agg(F.sum(F.when(F.col("status_class") == lp.SUCCESS, F.col("n")).otherwise(0))
                 .cast("bigint").alias("n_success"),
                 F.sum(F.when(F.col("status_class") == lp.FAILURE, F.col("n")).otherwise(0))
                 .cast("bigint").alias("n_failure")))


def alarm_verdict(ok, err) -> F.Column:
    """'insufficient' unless more than 100 rows; 'alarm' when the error
    ratio err/ok is above 0.5 (no successes counts as infinite); else 'ok'."""
    ok = F.col(ok) if isinstance(ok, str) else ok
    err = F.col(err) if isinstance(err, str) else err
    return (F.when(ok + err <= ALARM_FLOOR, F.lit("insufficient"))
            .when(err > F.lit(ALARM_RATIO) * ok, F.lit("alarm"))
            .otherwise(F.lit("ok")))


def error_alarm(df: DataFrame, length_s: int = 300, slide_s: int = 60,
                line: str = "line", ts: str = "ts") -> DataFrame:
    t = alarm_totals(df, length_s, slide_s, line, ts)
    return t.withColumn("verdict", alarm_verdict("n_success", "n_failure"))


def alarm_change_points(buckets: DataFrame, length_s: int, slide_s: int) -> DataFrame:
    """Alarm verdicts at every change, for a window as fine as wanted.

    ``buckets`` is (_b, status_class, n): rows per slide bucket. The signed
    success and failure counts of a bucket enter and leave the window once;
    one running sum of both gives the totals, with no copies per window.
    Output: window_end, n_success, n_failure, verdict.
    """
    hit = {"n_success": lp.SUCCESS, "n_failure": lp.FAILURE}
    per = buckets.groupBy("_b").agg(*[F.sum(F.when(F.col("status_class") == c, F.col("n")).otherwise(0)).alias(o)
                                      for o, c in hit.items()])
    run = running_deltas(per, [], list(hit), length_s, slide_s)
    out = run.select(from_micros("_t").alias("window_end"), *[F.col(o).cast("bigint").alias(o) for o in hit])
    return out.withColumn("verdict", alarm_verdict("n_success", "n_failure"))


def error_alarm_compact(df: DataFrame, length_s: int = 300, slide_s: int = 1, line: str = "line",
                        ts: str = "ts") -> DataFrame:
    classes = status_classes(df, line, keep=(ts,))
    return alarm_change_points(bucket_counts(classes, ts, ["status_class"], slide_s), length_s, slide_s)


def latest_by_key(df: DataFrame, key, order_cols, value_cols) -> DataFrame:
    """Latest row per key (one column or several) by ``order_cols`` (an
    upsert's end state).

    A ``max`` of a struct led by the order columns is an ordinary
    aggregate: partial aggregation in the map tasks reduces a hot key to
    one row per task before the shuffle, where a ``row_number`` window
    would sort the whole key in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    packed = F.struct(*[F.col(c).alias(c) for c in order_cols],
                      *[F.col(c).alias(c) for c in value_cols])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_m"))
    return agg.select(*keys, *[F.col("_m." + c).alias(c) for c in order_cols + list(value_cols)])


def requests_by_ip(df: DataFrame, line: str = "line", keep=("event_id", "ts")) -> DataFrame:
    """(ip, url, status, agent) per line, default row for bad lines."""
    return request_records(df, line, keep, with_ip=True)
