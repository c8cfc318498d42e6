"""Sliding windows: bucket-then-fan-out counts equal Spark's own
``window()``; change points equal a brute-force scan; top-k breaks ties."""
import datetime as dt
import random

from pyspark.sql import functions as F

from tidewater.operators import windows as Wn

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=400):
    rows = [(i, T0 + dt.timedelta(seconds=(i * 37) % 1800), f"k{i % 5 if i % 3 else 0}") for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, key string"), rows


def test_sliding_counts_equal_builtin_window(spark):
    df, _ = _events(spark)
    ours = Wn.sliding_counts(df, "ts", ["key"], 300, 60)
    ref = (df.groupBy(F.window("ts", "300 seconds", "60 seconds"), "key").count()
           .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                   F.col("window.end").cast("timestamp_ntz").alias("window_end"), "key",
                   F.col("count").alias("n")))
    a = sorted(tuple(r) for r in ours.collect())
    b = sorted(tuple(r) for r in ref.collect())
    assert a == b


def test_change_points_equal_brute_force(spark):
    df, rows = _events(spark)
    length, slide = 300, 1
    got = {(r.window_end, r.key): r.n for r in Wn.sliding_change_points(df, "ts", ["key"], length, slide).collect()}
    keys = {r[2] for r in rows}
    ends = sorted({e for e, _ in got})
    # every window [end - length, end) on the slide grid, checked at the change points and between them
    for key in keys:
        ts = sorted(r[1] for r in rows if r[2] == key)
        last = None
        t = min(ts) + dt.timedelta(seconds=slide)
        stop = max(ts) + dt.timedelta(seconds=length + slide)
        while t <= stop:
            n = sum(1 for x in ts if t - dt.timedelta(seconds=length) <= x < t)
            if (t, key) in got:
                assert got[(t, key)] == n, (t, key)
                last = n
            else:
                assert last == n, (t, key)   # a count holds until the next change
            t += dt.timedelta(seconds=slide)
        assert last == 0
    assert ends


def test_top_k_ties_broken_by_key(spark):
    c = spark.createDataFrame([(1, 2, "b", 5), (1, 2, "a", 5), (1, 2, "c", 7), (1, 2, "d", 1)],
                              "window_start int, window_end int, url string, n long")
    got = [(r.url, r.rank) for r in Wn.top_k_per_window(c, "url", 3).orderBy("rank").collect()]
    assert got == [("c", 1), ("a", 2), ("b", 3)]


def test_keyed_running_sum_across_blocks(spark):
    rows = [("x", i, 1) for i in range(50)] + [("y", i, 2) for i in range(0, 50, 5)] + [(None, 3, 4), (None, 9, 1)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.s for r in Wn.keyed_running(df, ["k"], "o", {"s": ("sum", "v")}, block=7).collect()}
    for k in ("x", "y", None):
        run = 0
        for kk, o, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            run += v
            assert got[(k, o)] == run


def test_running_sum_and_max_without_key_across_blocks(spark):
    rows = [(o, (o * 37) % 11, (o * 53) % 17) for o in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "o long, a long, b long")
    got = {r.o: (r.s, r.m) for r in Wn.keyed_running(df, [], "o", {"s": ("sum", "a"), "m": ("max", "b")},
                                                      block=20).collect()}
    s = m = None
    for o, a, b in rows:
        s = a if s is None else s + a
        m = b if m is None else max(m, b)
        assert got[o] == (s, m), o


def _brute_top(events, length, k):
    """{time of change: first k (key, n)} of one-second slides; events are (second, key)."""
    ends, out = set(), {}
    for t in sorted({t + 1 for t, _ in events} | {t + 1 + length for t, _ in events}):
        now, before = ({key: sum(x == key and t - length <= s < t for s, x in events) for key in {x for _, x in events}}
                       for t in (t, t - 1))
        if now != before:
            ends.add(t)
            out[t] = sorted(((key, n) for key, n in now.items() if n), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))[:k]
    return out


def test_top_k_at_every_change_equals_brute_force(spark):
    rng = random.Random(8)
    events = [(rng.randrange(900), rng.choice([None, *"abcdefghij"])) for _ in range(120)]
    events += [(400, f"k{i:03d}") for i in range(60)]                     # a burst: no key holds through its blocks
    events += [(500 + i, "busy") for i in range(0, 200, 2)] + [(0, "back"), (300, "back"), (700, "back")]
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), x) for s, x in events], "ts timestamp_ntz, key string")
    got = {}
    for r in Wn.top_k_change_points(Wn.bucket_counts(df, "ts", "key", 1), "key", 300, 1, 4).collect():
        got.setdefault(int((r.window_end - T0).total_seconds()), []).append((r["rank"], r.key, r.n))
    want = {t: [(i + 1, *x) for i, x in enumerate(top)] for t, top in _brute_top(events, 300, 4).items() if top}
    assert {t: sorted(x) for t, x in got.items()} == want


def test_few_rows_reach_the_top_k_of_many_sparse_keys(spark):
    n, k = 30_000, 10
    rows = spark.range(n).select(F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % n).cast("string"), 6, "0")).alias("key"),
                                 (F.col("id") * Wn.US).alias("_b"), F.lit(1).cast("long").alias("n"))
    intervals, times = Wn.count_intervals(rows, "key", 300, 1)
    counts = Wn.leading_counts(intervals, times, "key", 300, 1, k)
    assert counts.count() <= 20 * k * times.count()
    # one second holds all keys: no bound helps before that second
    burst = rows.withColumn("_b", F.lit(0).cast("long"))
    intervals, times = Wn.count_intervals(burst, "key", 300, 1)
    assert times.count() == 2 and Wn.leading_counts(intervals, times, "key", 300, 1, k).count() <= 20 * n
