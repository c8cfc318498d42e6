"""Line sources for streaming queries, and payload decoding.

Every transport of the reference ends in a stream of text lines; here
each is a ``readStream`` whose result has a ``line`` string column (plus
an arrival ``ts`` where the transport gives one), so one query function
serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def decode_bytes(value: Column | str, charset: str = "UTF-8") -> Column:
    """Bytes message -> text line (the reference used the platform
    charset; UTF-8 is fixed here)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.decode(value, charset)


def kafka_options(bootstrap_servers: str, topics, group_id: str | None = None,
                  starting_offsets: str = "latest", extra: dict | None = None) -> dict:
    """Options of ``readStream.format("kafka")`` from the reference's
    parameters (broker list and topic set)."""
    topics = [topics] if isinstance(topics, str) else list(topics)
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": ",".join(topics),
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def kafka_lines(records: DataFrame) -> DataFrame:
    """Kafka records (key, value, topic, partition, offset, timestamp) ->
    message text as ``line``, keeping the position and the broker time."""
    return records.select("topic", "partition", "offset",
                          F.col("timestamp").alias("ts"), decode_bytes("value").alias("line"))


def read_lines(spark: SparkSession, kind: str, **opts) -> DataFrame:
    """Streaming DataFrame of text lines from one transport.

    kind: ``text_dir`` (path, max_files_per_trigger), ``socket`` (host,
    port; not replayable, for demos), ``kafka`` (bootstrap_servers, topics;
    needs the Kafka connector on the classpath), ``replay`` (path, order,
    schema, line expression built by the caller).
    """
    if kind == "text_dir":
        r = spark.readStream.format("text").option("recursiveFileLookup", "true")
        if opts.get("max_files_per_trigger"):
            r = r.option("maxFilesPerTrigger", int(opts["max_files_per_trigger"]))
        return r.load(opts["path"]).select(F.col("value").alias("line"))
    if kind == "socket":
        df = (spark.readStream.format("socket").option("host", opts.get("host", "127.0.0.1"))
              .option("port", int(opts.get("port", 9999))).option("includeTimestamp", True).load())
        return df.select(F.col("value").alias("line"), F.col("timestamp").alias("ts"))
    if kind == "kafka":
        o = kafka_options(opts["bootstrap_servers"], opts["topics"], opts.get("group_id"),
                          opts.get("starting_offsets", "latest"))
        return kafka_lines(spark.readStream.format("kafka").options(**o).load())
    raise ValueError(f"unknown line source {kind!r}")


def as_kafka_records(df: DataFrame, line: str = "line", topic: str = "weblog",
                     offset: str = "event_id", ts: str = "ts", partitions: int = 4) -> DataFrame:
    """A table of lines in the shape the Kafka source returns (for tests
    and replays): key, value bytes, topic, partition, offset, timestamp."""
    return df.select(F.lit(None).cast("binary").alias("key"),
                     F.encode(F.col(line), "UTF-8").alias("value"),
                     F.lit(topic).alias("topic"),
                     F.pmod(F.col(offset), F.lit(partitions)).cast("int").alias("partition"),
                     F.col(offset).cast("bigint").alias("offset"),
                     F.col(ts).cast("timestamp").alias("timestamp"))
