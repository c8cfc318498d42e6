"""Streaming sinks.

Writes inside ``foreachBatch`` go to a folder named by the batch id with
``overwrite``, so a batch that is replayed after a failure replaces its
own output instead of adding a copy (exactly-once effect).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.weblog import latest_by_key
from tidewater.streaming.store import VersionedTable, numbered, remove


# Texts may hold line breaks; text files written here separate records
# with the ASCII record separator instead, and are read back with it.
RECORD_SEP = "\u001e"


def batch_path(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, out: str, batch_id: int, fmt: str = "parquet",
                files: int | None = None) -> None:
    """Idempotent write of one batch's rows."""
    if files is not None:
        df = df.coalesce(files)
    w = df.write.mode("overwrite")
    if fmt == "text":
        w = w.option("lineSep", RECORD_SEP)
    getattr(w, fmt)(batch_path(out, batch_id))


def write_counted(df: DataFrame, out: str, batch_id: int, fmt: str = "parquet", files: int | None = None) -> int:
    """As ``write_batch``; the number of rows, counted while they are written."""
    seen = Observation()
    write_batch(df.observe(seen, F.count(F.lit(1)).alias("n")), out, batch_id, fmt, files)
    return seen.get["n"]


def per_batch(out: str, fn: Callable[[DataFrame, int], DataFrame], fmt: str = "parquet",
              skip_empty: bool = True, cache: bool | None = None):
    """``foreachBatch`` body: ``fn(batch_df, batch_id)`` then an idempotent
    write of its result.  Skipping empty batches takes a second action on
    the batch, so by default the batch is then persisted: its plan (a
    stateful operator included) runs once, not once per action."""
    cache = skip_empty if cache is None else cache

    def body(df: DataFrame, batch_id: int) -> None:
        if cache:
            df = df.persist()
        try:
            if skip_empty and df.isEmpty():
                return
            write_batch(fn(df, batch_id), out, batch_id, fmt)
        finally:
            if cache:
                df.unpersist()
    return body


def skip_empty(sink: Callable[[DataFrame, int], None]):
    """``sink`` for the batches that have rows."""
    def body(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():
                sink(df, batch_id)
        finally:
            df.unpersist()
    return body


def sql_per_batch(out: str, view: str, sql: str, fmt: str = "parquet"):
    """Run a SQL text on every batch exposed as a temp view; the result
    gets the batch id as a column and is written idempotently."""
    def fn(df: DataFrame, batch_id: int) -> DataFrame:
        df.createOrReplaceTempView(view)
        return df.sparkSession.sql(sql).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return per_batch(out, fn, fmt)


def print_batch(num_rows: int = 10, heading: bool = True):
    """``DataFrame.show()`` of each batch under a batch heading."""
    def body(df: DataFrame, batch_id: int) -> None:
        if heading:
            print(f"========= batch {batch_id} =========")
        df.show(num_rows, truncate=False)
    return body


class LimitReached(Exception):
    """Raised for the first batch past a save limit, so that it is not
    committed: a later run with a higher limit starts with it."""


class SaveUntil:
    """Save each non-empty batch as text in its own folder, until the total
    passes ``limit`` (strict ``>``, looked at after each write; None: no
    limit). The batch after that raises ``LimitReached``: the query ends, its
    offsets stay uncommitted and nothing is lost.

    The running total is kept with the batch (``_totals`` below the folder), so
    a batch that is replayed counts once and saved texts are never read again.
    ``files_per_batch=1`` merges each batch into one file; ``None`` keeps one
    file per partition.
    """

    def __init__(self, spark: SparkSession, out: str, limit: int | None = None,
                 files_per_batch: int | None = 1, column: str = "text"):
        self.spark, self.out, self.limit = spark, out, limit
        self.files, self.column = files_per_batch, column
        self.totals = VersionedTable(f"{out.rstrip('/')}/_totals")
        self.done = False

    def saved(self, before: int | None = None) -> int:
        """Texts saved (by batches before ``before``)."""
        held = self.totals.read(self.spark, before)
        return held.first()["total"] if held is not None else 0

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        total = self.saved(batch_id)
        if self.limit is not None and total > self.limit:
            self.done = True
            raise LimitReached(f"more than {self.limit} texts are saved")
        n = write_counted(df.select(F.col(self.column).cast("string").alias("value")), self.out, batch_id, "text", self.files)
        if not n:
            remove(self.spark, batch_path(self.out, batch_id))
        self.totals.write(self.spark.createDataFrame([(total + n,)], "total long").coalesce(1), batch_id)
        self.done = self.limit is not None and total + n > self.limit


class KeyedStore:
    """Rows stored by key, appended or upserted, batch by batch.

    ``append``: every row of the batch is kept.  ``upsert``: a batch writes
    its latest row per key as a delta; after ``merge_every`` deltas they are
    merged into a snapshot (a partial-aggregate ``max``, no key is gathered
    in one task) and those that no replay can ask for are removed.  Reading
    folds the snapshot and the few deltas after it, however many batches ran.
    """

    def __init__(self, out: str, key, order_cols, value_cols, mode: str = "upsert", merge_every: int = 8):
        if mode not in ("append", "upsert"):
            raise ValueError(mode)
        self.out, self.key, self.mode, self.merge_every = out.rstrip("/"), key, mode, merge_every
        self.order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
        self.value_cols = list(value_cols)
        self.snapshots = VersionedTable(f"{self.out}/snapshots")

    def _latest(self, df: DataFrame) -> DataFrame:
        return latest_by_key(df, self.key, self.order_cols, self.value_cols)

    def _deltas(self, spark: SparkSession, after: int, upto: int | None = None) -> list[str]:
        return [batch_path(self.out, b) for b in numbered(spark, self.out, "batch_id")
                if b > after and (upto is None or b <= upto)]

    def _merged_upto(self, spark: SparkSession, before: int | None = None) -> int:
        have = [v for v in numbered(spark, self.snapshots.path, "version") if before is None or v < before]
        return have[-1] if have else -1

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        write_batch(self._latest(df) if self.mode == "upsert" else df, self.out, batch_id)
        if self.mode == "append":
            return
        base = self._merged_upto(spark, batch_id)
        deltas = self._deltas(spark, base, batch_id)
        if len(deltas) >= self.merge_every:
            rows = spark.read.parquet(*deltas)
            held = self.snapshots.read(spark, batch_id)
            self.snapshots.write(self._latest(rows if held is None else rows.unionByName(held)), batch_id)
            for b in numbered(spark, self.out, "batch_id"):
                if b <= base:
                    remove(spark, batch_path(self.out, b))

    def read(self, spark: SparkSession) -> DataFrame:
        if self.mode == "append":
            return spark.read.parquet(self.out)
        held = self.snapshots.read(spark)
        deltas = self._deltas(spark, self._merged_upto(spark))
        if not deltas:
            return held
        rows = spark.read.parquet(*deltas)
        return self._latest(rows if held is None else rows.unionByName(held))
