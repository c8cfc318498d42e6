"""Folder sink with commits, counts taken while writing, and scoring beside
training."""
import os

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.session import fresh_dir
from tidewater.streaming.folder_sink import FolderWriter, commits, folder_writer, read_committed
from tidewater.streaming.learners import KMeansStream, PinnedScorer, readable
from tidewater.streaming.runner import run_available
from tidewater.streaming.sinks import SaveUntil, write_counted
from tidewater.streaming.store import VersionedTable

SCHEMA = "id long, text string"


def _stream(spark, tmp_path, batches, schema=SCHEMA):
    for i, rows in enumerate(batches):
        path = f"{tmp_path}/in/{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (1_600_000_000 + i, 1_600_000_000 + i))
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))


ROWS = [[(b * 10 + i, f"t{i}") for i in range(4 + b)] for b in range(3)]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_committed_batches_are_read(spark, tmp_path, file_format):
    out, ck = f"{tmp_path}/out", fresh_dir(spark, "test-ck")
    run_available(folder_writer(_stream(spark, tmp_path, ROWS), out, file_format).option("checkpointLocation", ck))
    assert [(c["batch_id"], c["rows"]) for c in commits(out)] == [(0, 4), (1, 5), (2, 6)]
    got = read_committed(spark, out, SCHEMA, file_format)
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for b in ROWS for r in b)


def test_failed_tasks_leave_no_rows_and_the_batch_runs_again(spark, tmp_path):
    out, ck, s = f"{tmp_path}/out", fresh_dir(spark, "test-ck"), _stream(spark, tmp_path, ROWS)

    def broken(batches):
        for batch in batches:
            yield batch                                     # rows reach the writer, then the task fails
            if pa.compute.max(batch.column("id")).as_py() >= 10:
                raise RuntimeError("task lost")
    with pytest.raises(StreamingQueryException, match="task lost"):
        run_available(folder_writer(s.mapInArrow(broken, SCHEMA), out).option("checkpointLocation", ck))
    assert [c["batch_id"] for c in commits(out)] == [0] and read_committed(spark, out, SCHEMA).count() == 4
    run_available(folder_writer(s.mapInArrow(lambda batches: batches, SCHEMA), out).option("checkpointLocation", ck))
    assert sorted(tuple(r) for r in read_committed(spark, out, SCHEMA).collect()) == sorted(r for b in ROWS for r in b)


def test_a_replayed_commit_replaces_its_batch_and_an_abort_removes(tmp_path):
    w = FolderWriter(str(tmp_path), "parquet")
    batch = pa.RecordBatch.from_pydict({"id": [1, 2]})
    first, again, lost = w.write(iter([batch])), w.write(iter([batch, batch])), w.write(iter([batch]))
    w.commit([first, None], 7)
    w.commit([again, w.write(iter([]))], 7)
    assert [(c["batch_id"], c["rows"], c["files"]) for c in commits(str(tmp_path))] == [(7, 4, again.files)]
    assert all(os.path.exists(f"{tmp_path}/{f}") for f in lost.files)
    w.abort([lost, None], 8)
    assert not any(os.path.exists(f"{tmp_path}/{f}") for f in lost.files)
    with pytest.raises(ValueError):
        FolderWriter(str(tmp_path), "avro")


def test_nothing_committed_is_an_empty_table(spark, tmp_path):
    assert read_committed(spark, f"{tmp_path}/none", SCHEMA).count() == 0


def _counting(spark, rows, calls):
    """Rows whose reading is counted."""
    @F.udf("long")
    def read(i):
        calls.add(1)
        return i
    return spark.createDataFrame(rows, "id long, x double").withColumn("seen", read.asNondeterministic()("id"))


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    df = _counting(spark, [(i, float(i)) for i in range(50)], calls)
    assert write_counted(df, f"{tmp_path}/out", 3) == 50 and calls.value == 50
    assert spark.read.parquet(f"{tmp_path}/out/batch_id=3").count() == 50
    assert write_counted(df.where("id < 0"), f"{tmp_path}/out", 4) == 0


def test_bad_rows_are_counted_in_the_training_pass(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    rows = [(i, None if i % 5 == 0 else float("nan") if i % 7 == 0 else float(i)) for i in range(1, 60)]
    df = _counting(spark, rows, calls)
    good, seen = readable(df, ["x"])
    n = good.agg(F.count("x").alias("n"), F.sum("seen")).first()["n"]
    bad = sum(x is None or x != x for _, x in rows)
    assert (n, seen.get["n_bad"], calls.value) == (len(rows) - bad, bad, len(rows))


def test_saved_totals_go_on_and_a_replay_counts_once(spark, tmp_path):
    sink = SaveUntil(spark, f"{tmp_path}/out", limit=8)
    batch = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "text string")
    for b in (0, 0, 1, 1):
        sink(batch, b)
    assert sink.saved() == 8 and not sink.done
    sink(batch.where("text = 'x'"), 2)
    assert not os.path.exists(f"{tmp_path}/out/batch_id=2")
    sink(batch.limit(1), 3)
    assert sink.saved() == 9 and sink.done
    with pytest.raises(Exception, match="more than 8"):
        sink(batch, 4)


def test_a_scoring_batch_keeps_the_model_it_used(spark, tmp_path):
    trainer = KMeansStream(f"{tmp_path}/model", ["x"], [[0.0], [10.0]], weight=1.0, keep=10)
    scorer = PinnedScorer(trainer, f"{tmp_path}/scores", ["id", "cluster"])
    rows = spark.createDataFrame([(1, 4.0), (2, 6.0), (3, None)], "id long, x double")
    scorer(rows, 0)                                          # before any training: the starting model
    trainer(spark.createDataFrame([(1, 1.0), (2, 90.0), (3, 80.0)], "id long, x double"), 0)
    scorer(rows, 1)

    def scores(b):
        return {r.id: (r.cluster, r.model_batch) for r in spark.read.parquet(f"{tmp_path}/scores/batch_id={b}").collect()}
    assert scores(0) == {1: (0, -1), 2: (1, -1), 3: (None, -1)}
    assert scores(1) == {1: (0, 0), 2: (0, 0), 3: (None, 0)}
    trainer(spark.createDataFrame([(1, 500.0)], "id long, x double"), 1)
    before = scores(0), scores(1)
    scorer(rows, 0)                                          # replayed after training went on
    scorer(rows, 1)
    assert (scores(0), scores(1)) == before
    assert VersionedTable(f"{tmp_path}/scores/_pins").at(spark, 1).first()["model_batch"] == 0


def test_training_and_scoring_at_once(spark, tmp_path):
    """Two running queries; every score is that of the model it names."""
    start = [[0.0], [10.0]]
    schema = "id long, x double"
    trainer = KMeansStream(f"{tmp_path}/model", ["x"], start, keep=50)
    scorer = PinnedScorer(trainer, f"{tmp_path}/scores", ["id", "x", "cluster"])
    batches = [[(b * 10 + i, float(b * 5 + i)) for i in range(6)] for b in range(3)]
    s = _stream(spark, tmp_path, batches, schema)
    queries = [s.writeStream.foreachBatch(sink).option("checkpointLocation", fresh_dir(spark, "test-ck")).trigger(processingTime="0 seconds").start()
               for sink in (trainer, scorer)]
    try:
        assert all(q.isActive for q in queries)
        for q in reversed(queries):
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    models = {-1: [c[0] for c in start]}
    for r in spark.read.parquet(f"{tmp_path}/model").orderBy("batch_id", "cluster").collect():
        models.setdefault(r.batch_id, []).append(r.c0)
    got = spark.read.parquet(f"{tmp_path}/scores").collect()
    assert len(got) == 18
    for r in got:
        assert r.cluster == min(range(2), key=lambda c: (abs(models[r.model_batch][c] - r.x), c))
