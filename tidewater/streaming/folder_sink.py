"""A streaming sink of our own: files in a folder, by batch, with a commit.

A Python Data Source (``format("tidewater_folder")``): tasks write their Arrow
batches to files of names of their own, and the driver's commit lists the
files of all tasks in one manifest per batch, written beside and renamed. Only
files of a manifest are data. So the files of a task that failed, or was run
twice, are never read; a batch that is replayed replaces its manifest; an
abort removes what its tasks have written. ``read_committed`` reads it.

Options: ``path`` (anything that ``pyarrow.fs`` opens, seen by all executors)
and ``file_format`` (parquet or csv).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "tidewater_folder"
FORMATS = ("parquet", "csv")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class FolderWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, file_format: str):
        if file_format not in FORMATS:
            raise ValueError(f"file_format is one of {', '.join(FORMATS)}")
        self.path, self.file_format = path, file_format

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One task's rows, to a file per task and attempt."""
        files, rows = [], 0
        first = next(iterator, None)
        if first is not None:
            filesystem, base = _opened(self.path)
            name = f"data/{uuid.uuid4().hex}"
            filesystem.create_dir(f"{base}/data", recursive=True)

            def counted():
                nonlocal rows
                for batch in (first, *iterator):
                    rows += batch.num_rows
                    yield batch
            ds.write_dataset(counted(), f"{base}/{name}", schema=first.schema, filesystem=filesystem, format=self.file_format,
                             basename_template="part-{i}." + self.file_format)
            files = [f"{name}/{f.base_name}" for f in filesystem.get_file_info(fs.FileSelector(f"{base}/{name}")) if f.is_file]
        return Written(files, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803 (Spark's name)
        filesystem, base = _opened(self.path)
        filesystem.create_dir(f"{base}/commits", recursive=True)
        done = [m for m in messages if m is not None]
        body = json.dumps({"batch_id": batchId, "rows": sum(m.rows for m in done), "files": sorted(f for m in done for f in m.files)})
        draft = f"{base}/commits/.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(draft) as out:
            out.write(body.encode())
        filesystem.move(draft, f"{base}/commits/{batchId}.json")  # whole or not at all

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        filesystem, base = _opened(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            filesystem.delete_file(f"{base}/{f}")


class FolderSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> FolderWriter:  # noqa: N802
        return FolderWriter(self.options["path"], self.options.get("file_format", "parquet"))


def folder_writer(df: DataFrame, path: str, file_format: str = "parquet"):
    """Writer of a streaming ``df`` into ``path``."""
    df.sparkSession.dataSource.register(FolderSink)
    return df.writeStream.format(FORMAT).option("path", path).option("file_format", file_format)


def commits(path: str) -> list[dict]:
    """The manifests, by batch."""
    filesystem, base = _opened(path)
    found = []
    for f in filesystem.get_file_info(fs.FileSelector(f"{base}/commits", allow_not_found=True)):
        if f.extension == "json":
            with filesystem.open_input_stream(f.path) as body:
                found.append(json.loads(body.read()))
    return sorted(found, key=lambda c: c["batch_id"])


def read_committed(spark: SparkSession, path: str, schema, file_format: str = "parquet") -> DataFrame:
    """The rows of all committed batches."""
    files = [f"{path.rstrip('/')}/{f}" for c in commits(path) for f in c["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.option("header", "true")
    return reader.format(file_format).load(files)
