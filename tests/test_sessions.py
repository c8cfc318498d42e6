"""Sessions against a brute-force walk of each key's requests: a hot key
spanning several time blocks, a null key, a gap of exactly 30 minutes,
and sessions longer than the ten URLs kept."""
import datetime as dt

import pytest

from tidewater.operators import sessions as S

T0 = dt.datetime(2024, 1, 1)


def _fixture():
    rows, eid = [], 0
    # hot key: 3 days of requests every 7 minutes, with breaks of 31 minutes
    t = T0
    for i in range(700):
        t += dt.timedelta(minutes=31 if i % 97 == 0 else 7)
        rows.append((eid, t, "1.1.1.1", f"/h{i % 13}")); eid += 1
    # exactly-30-minute gap stays in the session; 30 min + 1 s opens one
    for m in (0, 30, 60, 90, 120.0167):
        rows.append((eid, T0 + dt.timedelta(minutes=m), "2.2.2.2", f"/e{eid}")); eid += 1
    # null key and ties on ts (broken by event_id)
    for k in range(12):
        rows.append((eid, T0 + dt.timedelta(minutes=k // 3), None, f"/n{k}")); eid += 1
    return rows


def _brute(rows, timeout_s=S.SESSION_TIMEOUT_S, keep=S.CLICKSTREAM_MAX):
    by_key = {}
    for r in sorted(rows, key=lambda r: (str(r[2]), r[1], r[0])):
        by_key.setdefault(r[2], []).append(r)
    out = {}
    for key, rs in by_key.items():
        last, start, n, urls = None, None, 0, []
        for eid, ts, _, url in rs:
            if last is None or (ts - last).total_seconds() > timeout_s:
                start, n, urls = ts, 0, []
            n += 1
            if len(urls) < keep:
                urls.append(url)
            out[eid] = (key, start, n, ",".join(urls))
            last = ts
    return out


@pytest.mark.parametrize("block_s", [86_400, 3_600, 600, 60])
def test_running_sessions_equal_brute_force(spark, block_s):
    """Small blocks put session starts, first-ten lists and long sessions
    across many block edges (the carried state between blocks)."""
    rows = _fixture()
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, ip string, url string")
    got = S.running_sessions(df, block_s=block_s).collect()
    want = _brute(rows)
    assert len(got) == len(want)
    for r in got:
        assert (r.ip, r.session_start, r.session_length, ",".join(r.clickstream)) == want[r.event_id], r


@pytest.mark.parametrize("block_s", [86_400, 600])
def test_sessions_and_snapshot(spark, block_s):
    rows = _fixture()
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, ip string, url string")
    want = _brute(rows)
    per_session = {}
    for eid, (key, start, n, urls) in want.items():
        cur = per_session.get((key, start))
        if cur is None or n > cur[0]:
            per_session[(key, start)] = (n, urls)
    got = {(r.ip, r.session_start): (r.session_length, ",".join(r.clickstream))
           for r in S.sessions(df, block_s=block_s).collect()}
    assert got == per_session
    e = sorted(k for k in per_session if k[0] == "2.2.2.2")
    assert len(e) == 2 and per_session[e[0]][0] == 4
    snap = {r.ip: r.session_start for r in S.session_snapshot(df).collect()}
    assert snap == {k: max(s for kk, s in per_session if kk == k) for k in {k for k, _ in per_session}}


def test_append_keep_first(spark):
    r = spark.createDataFrame([(["a"] * 9, "b"), (["a"] * 10, "b"), ([], "b")], "xs array<string>, x string")
    got = [x.y for x in r.select(S.append_keep_first("xs", "x").alias("y")).collect()]
    assert got == [["a"] * 9 + ["b"], ["a"] * 10, ["b"]]
