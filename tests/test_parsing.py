"""Edge rows for the log parser, the JVM split rule, dates, status classes
and the alarm thresholds (SURVEY 5 (3), 7.4)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import logparse as lp
from tidewater.functions.text import jvm_split, lines, utf16_length
from tidewater.operators import weblog as W

GOOD = '10.0.0.1 - u1 [01/Jan/2024:00:00:05 +0000] "GET /a HTTP/1.1" 200 12 "-" "agent-1"'
NO_IP = ' - u1 [01/Jan/2024:00:00:05 +0000] "GET /b HTTP/1.1" 500 12 "-" "agent-2"'
TWO_TOKENS = '10.0.0.2 - u2 [01/Jan/2024:00:00:05 +0000] "GET /c" 404 0 "-" "agent-3"'
DASH = '10.0.0.3 - u3 [01/Jan/2024:00:00:05 +0000] "-" 302 0 "-" "agent-4"'
BAD = "garbage line 7"
BAD_DATE = '10.0.0.4 - u4 [99/Foo/2024:00:00:05 +0000] "GET /d HTTP/1.1" 200 1 "-" "a"'


def _lines(spark, *ls):
    return spark.createDataFrame([(i, l) for i, l in enumerate(ls)], "event_id long, line string")


def test_parse_drops_unmatched(spark):
    out = W.parse_log(_lines(spark, GOOD, BAD, NO_IP)).orderBy("event_id").collect()
    assert [r.event_id for r in out] == [0, 2]
    assert out[0].ip == "10.0.0.1" and out[0].status == "200" and out[0].agent == "agent-1"
    assert out[1].ip is None  # optional group absent -> null, its own key


def test_request_unit_and_url_rules(spark):
    df = _lines(spark, GOOD, TWO_TOKENS, DASH, BAD)
    r = W.extract_request(df).withColumnRenamed("request", "req").select(
        "event_id", "req", lp.url_strict("req").alias("strict"), lp.url_lenient("req").alias("lenient"))
    got = {x.event_id: (x.req, x.strict, x.lenient) for x in r.collect()}
    assert got[0] == ("GET /a HTTP/1.1", "/a", "/a")
    assert got[1] == ("GET /c", "[error]", "/c")
    assert got[2] == ("-", "[error]", "[error]")
    assert got[3] == ("()", "[error]", "[error]")


def test_request_record_default_row(spark):
    r = W.requests_by_ip(_lines(spark, BAD, GOOD), keep=("event_id",)).orderBy("event_id").collect()
    assert (r[0].ip, r[0].url, r[0].status, r[0].agent) == ("error", "error", 0, "error")
    assert (r[1].ip, r[1].url, r[1].status, r[1].agent) == ("10.0.0.1", "/a", 200, "agent-1")


@pytest.mark.parametrize("text,expected", [
    ("a b c", ["a", "b", "c"]),
    ("a  b", ["a", "", "b"]),
    (" a", ["", "a"]),
    ("a b  ", ["a", "b"]),
    ("", [""]),
    ("   ", []),
])
def test_jvm_split(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(jvm_split("s").alias("t")).first().t
    assert got == expected


def test_lines_and_utf16(spark):
    r = spark.createDataFrame([("a\r\nb\nc\n", "a\U0001F600")], "t string, e string").select(
        lines("t").alias("l"), utf16_length("e").alias("u"), F.length("e").alias("cp")).first()
    assert r.l == ["a", "b", "c"]
    assert (r.u, r.cp) == (3, 2)


def test_log_time_ignores_zone_and_bad_dates_are_null(spark):
    df = _lines(spark, GOOD.replace("+0000", "+0200"), BAD_DATE)
    got = [x.t for x in W.log_times(df).orderBy("event_id").select(F.col("log_time").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 5), None]


@pytest.mark.parametrize("status,cls", [
    ("200", "Success"), ("299", "Success"), ("300", "Other"), ("404", "Other"),
    ("500", "Failure"), ("599", "Failure"), ("600", "Other"), ("[error]", "Other"), ("x", "Other"),
])
def test_status_class(spark, status, cls):
    got = spark.createDataFrame([(status,)], "s string").select(lp.status_class("s").alias("c")).first().c
    assert got == cls


@pytest.mark.parametrize("ok,err,verdict", [
    (50, 50, "insufficient"),   # 100 rows: not above the floor
    (60, 41, "alarm"),          # 101 rows, ratio 0.68
    (80, 40, "ok"),             # ratio exactly 0.5 is not an alarm
    (79, 40, "alarm"),
    (0, 101, "alarm"),          # no successes
    (101, 0, "ok"),
])
def test_alarm_thresholds(spark, ok, err, verdict):
    got = spark.createDataFrame([(ok, err)], "ok long, err long").select(
        W.alarm_verdict("ok", "err").alias("v")).first().v
    assert got == verdict


def test_lines_equal_regex_rule_on_random_texts(spark):
    """Literal CR/LF rewriting equals the CRLF|CR|LF rule with one final
    break dropped, on texts dense in breaks."""
    import random
    import re
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab \r\n") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += ["\r", "\n", "\r\n", "\r\r\n", "\n\r", "x\r\r\n", "\r\n\n"]

    def rule(t):
        if t == "":
            return []
        return re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", t, count=1))

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.l for r in df.select("i", lines("t").alias("l")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == rule(t), repr(t)


def test_packed_fields_equal_the_pattern(spark):
    """One regex run gives what the match test and nine extractions give,
    for lines with the separator too."""
    lines = ['1.2.3.4 - u [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 5 "-" "agent"',
             ' - u [01/Jan/2024:00:00:00 +0000] "" 200 5 "" ""', "garbage", "", None, "\x1f" * 8,
             '1.2.3.4 - u [x] "a\x1fb" 200 5 "-" "agent"', 'x 1.2.3.4 - u [x] "a" 200 5 "-" "agent"']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "event_id long, line string")
    got = {r.event_id: tuple(r)[1:] for r in W.parse_log(df).collect()}
    want = {r.event_id: tuple(r)[1:] for r in df.where(lp.matches("line")).select(
        "event_id", *[lp.group("line", f) for f in lp.FIELDS]).collect()}
    assert got == want and sorted(got) == [0, 1, 6]


def test_log_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("[10/Mar/2024:02:30:00 -0500]",), ("[bad]",)], "d string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):  # 02:30 does not exist there on that day
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(lp.log_time("d").cast("string").alias("t"), lp.log_time_with_offset("d").cast("string").alias("o")).collect()
            assert [tuple(x) for x in r] == [("2024-03-10 02:30:00", "2024-03-10 07:30:00"), (None, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_word_count_of_a_text_file(spark, tmp_path):
    from tidewater.operators.text import word_count
    from tidewater.sources.tables import text_lines
    (tmp_path / "a.txt").write_text("One two\ntwo  one\n")
    assert {r.word: r.n for r in word_count(text_lines(spark, str(tmp_path))).collect()} == {"one": 2, "two": 2, "": 1}


def test_lookup_of_a_repeated_key_does_not_multiply_rows(spark):
    from tidewater.operators.lookups import key_present, lookup_with_default
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (None, "n")], "d int, v string")
    assert sorted((r.k or 0, r.v) for r in lookup_with_default(df, dim, "k", "d", "v", "none").collect()) == [(0, "none"), (1, "a"), (2, "none")]
    assert key_present(df, dim, "k", "d").count() == 1


def test_session_settings():
    from tidewater.session import session_conf
    on_a_cluster = session_conf()
    assert not {"spark.master", "spark.driver.host", "spark.driver.bindAddress", "spark.driver.memory", "spark.sql.shuffle.partitions"} & set(on_a_cluster)
    assert session_conf("local[2]", 4)["spark.driver.host"] == "127.0.0.1"
