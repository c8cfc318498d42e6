"""Windows of a reduce function given by the user, against brute force."""
import datetime as dt
import random
import sys
from functools import reduce

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewater.operators import windows as Wn
from tidewater.operators.reduce_windows import reduce_windows, reduced_buckets

T0 = dt.datetime(2024, 1, 1)
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Python workers cannot import the tests


def _events(spark, rng, n=250):
    rows = [(T0 + dt.timedelta(seconds=rng.randrange(1500)), rng.choice(["a", "b", None]), rng.randrange(-50, 50)) for _ in range(n)]
    rows += [(T0, "edge", 1), (T0 + dt.timedelta(seconds=300), "edge", 2), (T0 + dt.timedelta(seconds=599), "edge", 3)]
    rows += [(None, "a", 1000), (T0, "nulls", None)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, key string, v long"), [r for r in rows if r[0] and r[2] is not None]


def _brute(rows, fn, length):
    out = {}
    for key in {k for _, k, _ in rows}:
        own = sorted((int((t - T0).total_seconds()), v) for t, k, v in rows if k == key)
        for t in {s + 1 for s, _ in own} | {s + 1 + length for s, _ in own}:
            inside = [v for s, v in own if t - length <= s < t]
            out[key, t] = reduce(fn, inside) if inside else None
    return out


@pytest.mark.parametrize("fn, inverse", [(max, None), (lambda a, b: a + b, None), (lambda a, b: a + b, lambda whole, part: whole - part)])
def test_windows_of_a_reduce_function(spark, fn, inverse):
    df, rows = _events(spark, random.Random(3))
    per = reduced_buckets(df, "ts", ["key"], "v", 1, fn)
    got = {(r.key, int((r.window_end - T0).total_seconds())): r.v
           for r in reduce_windows(per, ["key"], "v", fn, 300, 1, inverse).collect()}
    assert got == _brute(rows, fn, 300)


def _joined(a, b):
    """Not commutative, without an inverse: the earliest first, the latest last."""
    return {"first": a["first"], "last": b["last"], "n": a["n"] + b["n"], "low": min(a["low"], b["low"])}


def test_order_and_structs(spark):
    df, rows = _events(spark, random.Random(4), 150)
    own = df.withColumn("s", F.struct(F.col("v").alias("first"), F.col("v").alias("last"), F.lit(1).cast("long").alias("n"), F.col("v").alias("low")))
    # one value a bucket, so that the order of rows inside it does not matter
    per = (own.where("ts is not null and v is not null").withColumn("_b", Wn.to_micros("ts")).groupBy("key", "_b")
           .agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("n"))
           .select("key", "_b", F.struct(F.col("a").alias("first"), F.col("b").alias("last"), "n", F.col("a").alias("low")).alias("s")))
    values = {}
    for t, k, v in rows:
        values.setdefault((t, k), []).append(v)
    rows = [(t, k, {"first": min(v), "last": max(v), "n": len(v), "low": min(v)}) for (t, k), v in values.items()]
    want = {}
    for key in {k for _, k, _ in rows}:
        own = sorted(((int((t - T0).total_seconds()), v) for t, k, v in rows if k == key), key=lambda r: r[0])
        for t in {s + 1 for s, _ in own} | {s + 1 + 300 for s, _ in own}:
            inside = [v for s, v in own if t - 300 <= s < t]
            want[key, t] = reduce(_joined, inside) if inside else None
    got = {(r.key, int((r.window_end - T0).total_seconds())): None if r.s is None else r.s.asDict()
           for r in reduce_windows(per, ["key"], "s", _joined, 300, 1).collect()}
    assert got == want


def test_each_bucket_is_reduced_a_constant_number_of_times(spark):
    calls = spark.sparkContext.accumulator(0)
    n = 2000

    def counted(a, b):
        calls.add(1)
        return max(a, b)
    per = spark.range(n).select(F.lit("k").alias("key"), (F.col("id") * Wn.US).alias("_b"), F.col("id").alias("v"))
    assert reduce_windows(per, ["key"], "v", counted, 300, 1).count() == n + 300
    reduce_windows(per, ["key"], "v", counted, 300, 1).agg(F.max("v")).collect()
    assert calls.value <= 2 * 3 * (n + 300)     # two runs of prefixes, suffixes and changes; by window it would be 300 calls each


def test_empty_input(spark):
    none = spark.createDataFrame([], "key string, _b long, v long")
    assert reduce_windows(none, ["key"], "v", max, 300, 1).count() == 0
