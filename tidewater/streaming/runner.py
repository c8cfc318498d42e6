"""Start a streaming query, run it over all available input, wait."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from tidewater.session import fresh_dir

STREAM_TIMEOUT_S = 1800


def run_available(writer, timeout_s: int = STREAM_TIMEOUT_S):
    """``availableNow`` trigger: process everything there is (in as many
    micro-batches as the source's admission limits give), then stop."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming query did not finish")
    if q.exception() is not None:
        raise q.exception()
    return q


def run_every(writer, interval: str = "1 second", ended: Callable[[], bool] = lambda: False):
    """``processingTime`` trigger: a micro-batch per ``interval`` until the
    input there is has been processed, or until the sink has ``ended`` and
    refuses the next batch, which then stays uncommitted."""
    q = writer.trigger(processingTime=interval).start()
    try:
        q.processAllAvailable()
    except StreamingQueryException:
        if not ended():
            raise
    finally:
        q.stop()
    return q


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_trigger: int = 1) -> DataFrame:
    """Stream the staged parts under ``path`` in order, ``files_per_trigger``
    files per batch."""
    r = (spark.readStream.format(fmt).option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", files_per_trigger))
    if fmt != "text":
        r = r.schema(schema)
    return r.load(path)


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return fresh_dir(spark, f"checkpoints/{name}")
