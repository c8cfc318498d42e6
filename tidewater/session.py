"""Session construction and the shared folder for checkpoints and state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library relies on.  They are applied by
# ``get_session`` (tests, bench) and are otherwise left to the cluster.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit a change log per batch instead of uploading a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Only for a session of one machine, asked for by a local master.
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Build (or return) a session with the library defaults.

    On a cluster call it without ``master``: master, addresses, memory and
    the number of shuffle partitions then stay those of spark-submit. A local
    ``master`` also gets the settings of a session of one machine.
    """
    builder = SparkSession.builder.appName(app_name)
    for k, v in session_conf(master, shuffle_partitions, extra).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_conf(master: str | None = None, shuffle_partitions: int | None = None, extra: dict | None = None) -> dict:
    """The settings ``get_session`` applies."""
    conf = dict(DEFAULT_CONF)
    if master:
        conf["spark.master"] = master
        if master.startswith("local"):
            conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The folder named by ``spark.checkpoint.dir`` is read from the session;
    only when it is unset (local tests) is a private temporary folder
    created and recorded in the session, so later calls agree.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not base and not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique folder below the shared directory (one per run)."""
    return shared_dir(spark, kind, uuid.uuid4().hex)
