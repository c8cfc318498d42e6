"""Small tables kept by batch id below a sink's folder.

``VersionedTable`` holds one version per batch (a model, a table of state):
batch b reads the newest version before b and writes version b, so a batch
that is replayed after a failure starts from the same version again and
replaces its own. Versions that no replay can ask for are removed.

Folders are listed and removed through Hadoop's file system, so they may lie
wherever Spark can write.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers b of the finished folders ``<name>=<b>`` in ``path``, in order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for st in fs.listStatus(p):
        m = re.fullmatch(rf"{name}=(-?\d+)", st.getPath().getName())
        if m and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append(int(m[1]))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files below ``path``."""
    fs, p = _fs(spark, path)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next().getPath()
        if not f.getName().startswith(("_", ".")):
            found.append(f.toString())
    return found


def set_times(spark: SparkSession, path: str, order) -> None:
    """Give every data file below ``path`` the modification time
    ``order(path)`` (ms): the order in which a file stream admits them."""
    fs, _ = _fs(spark, path)
    for f in data_files(spark, path):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f), order(f), -1)


class VersionedTable:
    def __init__(self, path: str, keep: int = 2):
        self.path, self.keep = path.rstrip("/"), keep

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self, spark: SparkSession) -> list[int]:
        return numbered(spark, self.path, "version")

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The version of one batch."""
        return spark.read.parquet(self._at(batch_id)) if batch_id in self.versions(spark) else None

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest version (before batch ``before``); None if there is none."""
        have = [v for v in numbered(spark, self.path, "version") if before is None or v < before]
        return spark.read.parquet(self._at(have[-1])) if have else None

    def write(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(self._at(batch_id))
        for old in [v for v in numbered(spark, self.path, "version") if v <= batch_id][:-self.keep]:
            remove(spark, self._at(old))
