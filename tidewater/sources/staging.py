"""Write a derived table as ordered parts, to be replayed as a file stream.

One distributed write makes all parts, each of the same number of files, and
each file in a task of its own; the files' modification times then follow the
parts, so a file stream with ``maxFilesPerTrigger`` set to that number admits
a part per batch. The input is read twice: for the bounds of the order column,
the count and the length of the rows, and to write.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidewater.session import fresh_dir

ROWS_PER_FILE = 250_000
BYTES_PER_FILE = 64 << 20


@dataclass
class Staged:
    """Folder of the parts, and the number of files of each."""
    path: str
    files: int = 1


def stage_parts(spark: SparkSession, df: DataFrame, order_col: str, n_parts: int, kind: str,
                fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE, permute: bool = False,
                columns: list[str] | None = None, bytes_per_file: int = BYTES_PER_FILE) -> Staged:
    """Write ``df`` into ``n_parts`` folders by ranges of ``order_col``
    (or, with ``permute``, by ``(order_col * 7) % n_parts`` so each part
    spans the whole range: out-of-order arrival).  Rows without an order
    value cannot be placed and are an error.  Returns the folder
    with its files per part: as many as keep a file of a part of middle size
    below ``rows_per_file`` rows and ``bytes_per_file`` bytes."""
    from tidewater.streaming.store import data_files, set_times
    out = Staged(fresh_dir(spark, kind))
    o = F.col(order_col)
    names = columns or df.columns
    lo, hi, n, null, size = df.agg(F.min(o), F.max(o), F.count(F.lit(1)), F.count(F.when(o.isNull(), 1)), _bytes(df, names)).first()
    if null:
        raise ValueError(f"{null} rows have no {order_col}")
    if lo is None:
        return out
    part = F.pmod(o * 7, F.lit(n_parts)) if permute else F.floor((o - lo) / F.lit((hi - lo) // n_parts + 1))
    out.files = max(1, n // (n_parts * rows_per_file), min(size // (n_parts * bytes_per_file), n // n_parts))
    rows = df.withColumns({"_part": part.cast("int"), "_file": F.pmod(o, F.lit(out.files)).cast("int")})
    w = (rows.repartitionById(n_parts * out.files, F.col("_part") * F.lit(out.files) + F.col("_file"))
         .sortWithinPartitions("_part", "_file", order_col).select(*names, "_part", "_file").write.partitionBy("_part", "_file"))
    getattr(w, fmt)(out.path)
    if out.files > 1:
        _fill(spark, df.select(*names), out, fmt, data_files(spark, out.path))
    begin = 1_600_000_000_000
    set_times(spark, out.path, lambda f: begin + 1000 * int(re.search(r"_part=(\d+)", f)[1]))
    return out


def _bytes(df: DataFrame, names: list[str]) -> Column:
    """Sum of the lengths of the strings and binaries, 8 for any other value."""
    own = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) if isinstance(f.dataType, (StringType, BinaryType)) else F.lit(8)
           for f in df.schema if f.name in names]
    return F.coalesce(F.sum(sum((c.cast("long") for c in own), F.lit(0).cast("long"))), F.lit(0).cast("long"))


def _fill(spark: SparkSession, df: DataFrame, staged: Staged, fmt: str, written: list[str]) -> None:
    """Write an empty file where a part got no rows for one, so that each part
    has as many files as the stream admits at once."""
    have = {tuple(map(int, re.search(r"_part=(\d+)/_file=(\d+)", f).groups())) for f in written}
    for p in sorted({p for p, _ in have}):
        for f in range(staged.files):
            if (p, f) not in have:
                w = spark.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite")
                getattr(w, fmt)(f"{staged.path}/_part={p}/_file={f}")
