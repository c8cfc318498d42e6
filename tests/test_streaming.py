"""Streams: replays and restarts change nothing, limits lose nothing, and
the streaming forms equal the batch forms."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import sessions as S
from tidewater.operators.learning import KMeansModel, LinearModel
from tidewater.operators.windows import sliding_counts
from tidewater.session import fresh_dir
from tidewater.sources.replay import order_bounds, replay_in_batches
from tidewater.sources.staging import stage_parts
from tidewater.streaming.apps import SlidingCounts, event_time, to_console
from tidewater.streaming.learners import KMeansStream, RegressionStream, labeled_of, vectors_of
from tidewater.streaming.runner import checkpoint_for, file_stream, run_available, run_every
from tidewater.streaming.sessions import SessionStream
from tidewater.streaming.sinks import RECORD_SEP, KeyedStore, LimitReached, SaveUntil, per_batch, print_batch
from tidewater.streaming.stateful import sessions_with_state
from tidewater.streaming.store import numbered


def test_replayed_batch_is_idempotent(spark):
    out = fresh_dir(spark, "t/idem")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    body = per_batch(out, lambda d, bid: d)
    body(df, 3)
    body(df, 3)          # the same batch again after a failure
    body(df.limit(0), 4)  # empty batches write nothing
    back = spark.read.parquet(out)
    assert back.count() == 10
    assert [r.batch_id for r in back.select("batch_id").distinct().collect()] == [3]


def _texts(spark, n):
    return spark.range(n).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))


def test_save_counts_a_replayed_batch_once_and_refuses_the_batch_past_the_limit(spark):
    out = fresh_dir(spark, "t/save")
    sink = SaveUntil(spark, out, limit=25, files_per_batch=1)
    sink(_texts(spark, 10), 0)
    sink(_texts(spark, 10), 1)
    again = SaveUntil(spark, out, limit=25, files_per_batch=1)  # after a restart batch 1 comes again
    again(_texts(spark, 10), 1)
    assert again.saved() == 20 and not again.done
    again(_texts(spark, 10), 2)
    assert again.saved() == 30 and again.done
    with pytest.raises(LimitReached):
        again(_texts(spark, 10), 3)
    assert spark.read.option("lineSep", RECORD_SEP).text(out).count() == 30
    assert SaveUntil(spark, fresh_dir(spark, "t/none")).saved() == 0


def test_save_stops_the_query_and_a_higher_limit_goes_on(spark):
    df = spark.range(80).select(F.col("id").alias("post_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    parts = stage_parts(spark, df, "post_id", 8, "t/save_parts")
    out, ckpt = fresh_dir(spark, "t/save_run"), checkpoint_for(spark, "t_save_run")

    def run(limit):
        sink = SaveUntil(spark, out, limit)
        s = file_stream(spark, parts.path, df.schema, files_per_trigger=parts.files)
        run_every(s.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt), "0 seconds", lambda: sink.done)
        return sorted(int(r.value[1:]) for r in spark.read.option("lineSep", RECORD_SEP).text(out).select("value").collect())
    assert run(25) == list(range(30))        # 10, 20, 30: above the limit; batch 3 is not committed
    assert run(None) == list(range(80))      # nothing was lost


def test_keyed_store_upsert_keeps_latest(spark):
    out = fresh_dir(spark, "t/keyed")
    store = KeyedStore(out, "ip", ["ts", "event_id"], ["url"], mode="upsert")
    s = "ip string, ts long, event_id long, url string"
    store(spark.createDataFrame([("a", 1, 1, "/1"), ("a", 5, 2, "/2"), ("b", 3, 3, "/3")], s), 0)
    store(spark.createDataFrame([("a", 4, 4, "/4"), ("b", 3, 5, "/5"), (None, 1, 6, "/6")], s), 1)
    store(spark.createDataFrame([("a", 4, 4, "/4"), ("b", 3, 5, "/5"), (None, 1, 6, "/6")], s), 1)
    got = {r.ip: r.url for r in store.read(spark).collect()}
    assert got == {"a": "/2", "b": "/5", None: "/6"}


def test_keyed_store_merges_and_clears(spark):
    out = fresh_dir(spark, "t/merge")
    store = KeyedStore(out, "k", ["o"], ["v"], merge_every=3)
    want = {}
    for b in range(10):
        rows = [(f"k{(b + i) % 4}", b, f"{b}.{i}") for i in range(2)]
        want.update({k: v for k, _, v in rows})
        df = spark.createDataFrame(rows, "k string, o long, v string")
        store(df, b)
        if b in (2, 5, 6):
            store(df, b)  # replayed, also right after a merge
        assert {r.k: r.v for r in store.read(spark).collect()} == want
    assert len(numbered(spark, out, "batch_id")) <= 7 and len(numbered(spark, store.snapshots.path, "version")) <= 2


@pytest.mark.parametrize("rows_per_file", [250_000, 10])
def test_file_stream_parts_arrive_in_order(spark, rows_per_file):
    df = spark.range(100).withColumnRenamed("id", "event_id")
    path = stage_parts(spark, df, "event_id", 4, "t/parts", rows_per_file=rows_per_file)
    assert path.files == (1 if rows_per_file > 100 else 2)
    s = file_stream(spark, path.path, df.schema, files_per_trigger=path.files)
    out = fresh_dir(spark, "t/parts_out")
    body = per_batch(out, lambda d, bid: d.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
                     .withColumn("batch_id", F.lit(bid).cast("bigint")))
    run_available(s.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_for(spark, "t_parts")))
    got = [(r.batch_id, r.lo, r.hi) for r in spark.read.parquet(out).orderBy("batch_id").collect()]
    assert got == [(0, 0, 24), (1, 25, 49), (2, 50, 74), (3, 75, 99)]


def test_long_rows_are_staged_in_files_of_bounded_bytes(spark):
    """A file a task, however long its rows are; ids of one residue leave no
    file out, as a part would else be admitted with the next one's."""
    df = spark.range(80).select((F.col("id") * 4).alias("event_id"), F.repeat(F.lit("x"), F.lit(1000)).alias("text"))
    path = stage_parts(spark, df, "event_id", 4, "t/long", bytes_per_file=5_000)
    assert path.files == 4
    held = spark.read.parquet(path.path).groupBy("_part", "_file").count().collect()
    assert {(r["_part"], r["count"]) for r in held} == {(p, 20) for p in range(4)}   # all ids are 0 modulo 4
    odd = df.withColumn("event_id", (F.col("event_id") / 4).cast("long"))
    path = stage_parts(spark, odd, "event_id", 4, "t/long_odd", bytes_per_file=5_000)
    held = spark.read.parquet(path.path).groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(held) == 16 and all(r["count"] == 5 for r in held)
    s = file_stream(spark, stage_parts(spark, df, "event_id", 4, "t/long", bytes_per_file=5_000).path, df.schema, files_per_trigger=4)
    out = fresh_dir(spark, "t/long_out")
    body = per_batch(out, lambda d, bid: d.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
                     .withColumn("batch_id", F.lit(bid).cast("bigint")))
    run_available(s.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_for(spark, "t_long")))
    got = [(r.batch_id, r.lo, r.hi) for r in spark.read.parquet(out).orderBy("batch_id").collect()]
    assert got == [(0, 0, 76), (1, 80, 156), (2, 160, 236), (3, 240, 316)]


def test_each_staged_file_is_written_by_a_task_of_its_own(spark):
    df = spark.range(800).withColumnRenamed("id", "event_id")
    path = stage_parts(spark, df, "event_id", 8, "t/own_task")
    files = [r.f for r in spark.read.parquet(path.path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert len({f.rsplit("/part-", 1)[1][:5] for f in files}) == len(files) == 8


def test_rows_without_an_order_are_an_error(spark, sf):
    df = spark.createDataFrame([(1,), (None,)], "event_id long")
    with pytest.raises(ValueError):
        stage_parts(spark, df, "event_id", 2, "t/null")
    with pytest.raises(ValueError):
        order_bounds(df, "event_id")


def test_replay_in_batches_from_the_checkpoint(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    out, ckpt = fresh_dir(spark, "t/replay"), checkpoint_for(spark, "t_replay")
    body = per_batch(out, lambda d, bid: d.withColumn("batch_id", F.lit(bid).cast("bigint")))
    n = replay_in_batches(spark, f"{sf}/events.parquet", "event_id", ev.schema, 300, lambda s:
                          s.writeStream.foreachBatch(body).option("checkpointLocation", ckpt), ids_per_partition=70)
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == n > 2
    assert sorted(map(tuple, got.select("event_id", "event_type").collect())) == sorted(map(tuple, ev.collect()))


def _requests(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, ip string, url string")


T0 = dt.datetime(2024, 1, 1)


def test_stream_sessions_equal_batch(spark):
    rows, t = [], T0
    for i in range(120):
        t += dt.timedelta(minutes=7 if i % 5 else 41)   # in order; some gaps above 30 min
        rows.append((i, t, [None, "ip1", "ip2"][i % 3], f"/u{i}"))
    df = _requests(spark, rows)
    shown = []
    sink = SessionStream(fresh_dir(spark, "t/sess"), on_snapshot=lambda s, b: shown.append((b, s.count())))
    for b in range(4):  # whatever passes between two batches; the third comes twice
        for _ in range(2 if b == 2 else 1):
            sink(df.where((F.col("event_id") >= b * 30) & (F.col("event_id") < b * 30 + 30)), b)
    got = {r.event_id: (r.ip, r.session_start, r.session_length, list(r.clickstream)) for r in spark.read.parquet(sink.rows).collect()}
    want = {r.event_id: (r.ip, r.session_start, r.session_length, list(r.clickstream)) for r in S.running_sessions(df).collect()}
    assert got == want
    order = ["ip", "session_start", "session_end", "session_length", "clickstream"]
    assert sorted(map(str, sink.snapshot(spark).select(order).collect())) == sorted(map(str, S.session_snapshot(df).select(order).collect()))
    assert shown == [(0, 3), (1, 3), (2, 3), (2, 3), (3, 3)] and spark.table("sessions").count() == 3


def test_late_requests_join_the_open_session_and_state_is_cleared(spark):
    sink = SessionStream(fresh_dir(spark, "t/late"), keep_s=3600)
    at = lambda m: T0 + dt.timedelta(minutes=m)
    sink(_requests(spark, [(0, at(0), "a", "/0"), (1, at(20), "a", "/1"), (2, at(0), "b", "/2")]), 0)
    sink(_requests(spark, [(3, at(10), "a", "/3"), (4, at(45), "a", "/4")]), 1)
    got = {r.event_id: r.session_length for r in spark.read.parquet(sink.rows).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 3, 4: 4}
    sink(_requests(spark, [(5, at(100), "a", "/5")]), 2)
    assert {r.ip: r.session_length for r in sink.snapshot(spark).collect()} == {"a": 1}  # b was last seen 100 min ago


def _stream(spark, df, order, parts, name, **options):
    path = stage_parts(spark, df, order, parts, f"t/{name}", **options)
    return file_stream(spark, path.path, df.schema, files_per_trigger=path.files)


def test_state_function_equals_batch(spark):
    rows, t = [], T0
    for i in range(60):
        t += dt.timedelta(minutes=9 if i % 4 else 35)
        rows.append((i, t, f"ip{i % 2}", f"/u{i}"))
    df = _requests(spark, rows)
    out = fresh_dir(spark, "t/sess_event")
    run_available(sessions_with_state(event_time(_stream(spark, df, "event_id", 3, "sess_event"))).writeStream.outputMode("append")
                  .format("parquet").option("path", out).option("checkpointLocation", checkpoint_for(spark, "sess_event")))
    got = {r.event_id: (r.session_length, list(r.clickstream)) for r in spark.read.parquet(out).collect()}
    assert got == {r.event_id: (r.session_length, list(r.clickstream)) for r in S.running_sessions(df).collect()}


@pytest.mark.parametrize("permute", [False, True])
@pytest.mark.parametrize("slide", [60, 1])
def test_sliding_counts_of_a_stream_hold_every_window(spark, permute, slide):
    """In order and out of order (parts that each span the whole time)."""
    rows = [(i, T0 + dt.timedelta(seconds=i * 13), f"k{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, key string")
    counts = SlidingCounts(fresh_dir(spark, f"t/slide{permute}{slide}"), "key", slide, watermark="1 hour")
    s = event_time(_stream(spark, df, "event_id", 3, f"slide{permute}{slide}", permute=permute))
    run_available(counts.stream(s).option("checkpointLocation", checkpoint_for(spark, f"slide{permute}{slide}")))
    got = counts.windows(spark, 300)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sliding_counts(df, "ts", "key", 300, slide).collect()))


def test_console_and_show(spark, capsys):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(6)], "id long, k string")
    counts = _stream(spark, df, "id", 2, "console").groupBy("k").count()
    run_available(to_console(counts).option("checkpointLocation", checkpoint_for(spark, "console")))
    print_batch(3)(df, 7)
    assert "batch 7" in capsys.readouterr().out


def test_kmeans_goes_on_after_a_restart_and_leaves_bad_lines_out(spark):
    lines = [(i, f"[{i % 2 * 10 + i % 3 * 0.1},{i % 2 * 10}]") for i in range(40)] + [(40, "[1,x]"), (41, None), (42, "[1]"), (43, "[1,2,3]")]
    df = vectors_of(spark.createDataFrame(lines, "id long, line string"), ["a", "b"])
    part = lambda b: df.where(F.floor(F.col("id") / 11) == b)
    out, start = fresh_dir(spark, "t/km"), [[0.0, 0.0], [10.0, 10.0]]
    whole = KMeansModel.from_centres(start)
    for b in range(4):
        sink = KMeansStream(out, ["a", "b"], start)  # a new process each time
        sink(part(b), b)
        if b == 2:
            sink(part(b), b)  # replayed
        whole.train_batch(part(b).dropna(), ["a", "b"])
    model = KMeansStream(out, ["a", "b"], start).model(spark)
    np.testing.assert_allclose(model.centres, whole.centres)
    np.testing.assert_allclose(model.weights, whole.weights)
    assert {r.n_bad for r in sink.models.read(spark).collect()} == {4}
    assert [r.cluster for r in sink.score(df).where("id in (0, 1, 40)").orderBy("id").collect()] == [0, 1, None]


def test_regression_goes_on_after_a_restart(spark):
    lines = [(i, f"{3 * (i % 7) + 1},{i % 7}") for i in range(70)] + [(70, "nonsense")]
    df = labeled_of(spark.createDataFrame(lines, "id long, line string"), "y", ["x"])
    out = fresh_dir(spark, "t/reg")
    whole = LinearModel.zeros(1, step=0.05)
    for b in range(3):
        sink = RegressionStream(out, ["x"], "y", step=0.05)
        for _ in range(2 if b == 1 else 1):
            sink(df.where(F.col("id") % 3 == b), b)
        whole.train_batch(df.where(F.col("id") % 3 == b).dropna(), ["x"], "y")
    model = RegressionStream(out, ["x"], "y", step=0.05).model(spark)
    np.testing.assert_allclose([*model.weights, model.intercept], [*whole.weights, whole.intercept])
    assert sink.score(df).where("id = 70").first().y_hat is None
