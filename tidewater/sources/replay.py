"""Replay source: a parquet table streamed in order of an id column.

A user-written source (the reference's custom receiver) re-aimed as a
replayable Structured Streaming source: the offset is a position on an
ordered integer column.  A micro-batch covers the ids from the last
committed offset up to ``stop_at`` (default: the largest id) and is read by
a task per ``ids_per_partition`` ids, each scanning its own id range, a
record batch at a time.  Because the offsets are plain
numbers the query restarts exactly from its checkpoint.

Usage::

    register(spark)
    df = (spark.readStream.format("tidewater_replay")
          .option("path", ".../events.parquet").option("order", "event_id")
          .option("start", 0).option("stop_at", 10_000).option("ids_per_partition", 5_000)
          .schema(schema).load())
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamReader,
    InputPartition,
)

from tidewater.streaming.runner import run_available

FORMAT = "tidewater_replay"
IDS_PER_PARTITION = 250_000


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class ReplayStreamReader(DataSourceStreamReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.path = options["path"]
        self.order = options["order"]
        self.ids = int(options["ids_per_partition"])
        self.first, self.end = int(options["start"]), int(options["stop_at"])

    def initialOffset(self):
        return {"pos": self.first}

    def latestOffset(self):
        # Everything up to ``stop_at`` is available.  New data "arrives"
        # when the query is restarted from its checkpoint with a larger
        # ``stop_at``: the next batch starts at the checkpointed offset.
        return {"pos": self.end}

    def partitions(self, start, end):
        lo, hi = int(start["pos"]), int(end["pos"])
        return [_Range(a, min(a + self.ids, hi)) for a in range(lo, hi, self.ids)]

    def commit(self, end):
        pass

    def read(self, partition: _Range):
        import pyarrow.dataset as ds

        names = [f.name for f in self.schema.fields]
        inside = (ds.field(self.order) >= partition.lo) & (ds.field(self.order) < partition.hi)
        # a batch at a time, the filter pushed into the parquet reader
        for batch in ds.dataset(self.path, format="parquet").to_batches(columns=names, filter=inside):
            if batch.num_rows:
                yield batch


class ReplayDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        raise ValueError("the replay source needs .schema(...)")

    def streamReader(self, schema):
        return ReplayStreamReader(schema, self.options)


def register(spark) -> None:
    spark.dataSource.register(ReplayDataSource)


def order_bounds(table: DataFrame, order: str) -> tuple[int, int]:
    """(first id, last id + 1), by one Spark aggregate; rows without an id
    have no place in the order and are an error."""
    lo, hi, null = table.agg(F.min(order), F.max(order), F.count(F.when(F.col(order).isNull(), 1))).first()
    if null:
        raise ValueError(f"{null} rows have no {order}")
    return (0, 0) if lo is None else (int(lo), int(hi) + 1)


def replay_stream(spark, path: str, order: str, schema, stop_at: int | None = None,
                  ids_per_partition: int = IDS_PER_PARTITION):
    """Streaming DataFrame replaying ``path`` up to id ``stop_at``."""
    register(spark)
    first, end = order_bounds(spark.read.parquet(path), order)
    return (spark.readStream.format(FORMAT).schema(schema)
            .option("path", path).option("order", order).option("ids_per_partition", ids_per_partition)
            .option("start", first).option("stop_at", end if stop_at is None else min(stop_at, end)).load())


def replay_in_batches(spark, path: str, order: str, schema, ids_per_batch: int, write,
                      ids_per_partition: int = IDS_PER_PARTITION) -> int:
    """Replay in micro-batches of ``ids_per_batch`` ids: this Spark's Python
    sources have no admission limit of their own, so each batch is a run from
    the checkpoint with a further ``stop_at``. ``write(stream)`` gives the
    writer. Returns the number of batches."""
    first, end = order_bounds(spark.read.parquet(path), order)
    stops = [*range(first + ids_per_batch, end, ids_per_batch), end] if end > first else []
    for stop in stops:
        run_available(write(replay_stream(spark, path, order, schema, stop, ids_per_partition)))
    return len(stops)
