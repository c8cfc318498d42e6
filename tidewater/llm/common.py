"""Helpers shared by the training-data operators: reading the given tables,
writing a step's rows to the shared folder, text units."""

from __future__ import annotations

import contextlib
import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import fresh_dir

#: A word of every operator here: a run of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch: texts are long, and a batch is held on both sides of a Python worker.
ARROW_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have ``ARROW_ROWS`` rows at most."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession):
    """Executions in the block remove their shuffle files when they end. What
    they have written is read from then on; else the files would stay until
    the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def saved(df: DataFrame, kind: str) -> DataFrame:
    """The rows of ``df`` as a table written once below the session's shared
    checkpoint folder and read again: it cuts the lineage, survives the loss
    of an executor, and later steps do not repeat the work behind it."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{kind}")
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run, written below the session's shared folder; leaving
    the block removes them, so what is returned must have been read by then."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.path = spark, fresh_dir(spark, f"llm-{kind}")
        self.names = (f"t{i}" for i in itertools.count())

    def fresh(self) -> str:
        return f"{self.path}/{next(self.names)}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self.fresh()
        with dropping_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (other letters stay as they are)."""
    return F.translate(c, UPPER, UPPER.lower())


def word_count(c: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that any other column of the input cannot
    clash with the columns an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def as_rows(df: DataFrame, **keys: Column) -> DataFrame:
    """Every row of ``df`` as one struct ``_doc`` beside the given keys, so
    its columns cannot clash with what is joined to it."""
    return df.select(F.struct("*").alias("_doc"), *[c.alias(k) for k, c in keys.items()])


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    """How many parts hold ``rows`` at ``per_partition`` each."""
    return max(least, -(-int(rows) // per_partition))
