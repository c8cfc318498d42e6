"""User-function hooks: vectorised (Arrow) functions over columns, groups
and tables.

Built-in column expressions come first everywhere in this library; these
are the open hooks for logic that has no built-in form.  Each works on
whole Arrow batches, never row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DataType


def vectorized_map(fn: Callable[[pd.Series], pd.Series], return_type: DataType | str) -> Callable[..., Column]:
    """Wrap a Series -> Series function as a scalar pandas UDF."""
    return pandas_udf(fn, return_type)


def _status_class(s: pd.Series) -> pd.Series:
    code = pd.to_numeric(s, errors="coerce").fillna(0).astype("int64")
    out = np.where((code >= 200) & (code < 300), "Success",
                   np.where((code >= 500) & (code < 600), "Failure", "Other"))
    return pd.Series(out, index=s.index)


def status_class_udf(col) -> Column:
    """Status class of a status text, computed in pandas (the UDF1 hook)."""
    return vectorized_map(_status_class, "string")(col)


def partial_sums(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per key as a user aggregate with a partial step (the UDF2 hook):
    a Python function folds each Arrow batch to one row per key, and a
    built-in sum adds those up, so no group is gathered in Python."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, part long"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(key).aggregate([(value, "sum")])
            yield from t.select([key, f"{value}_sum"]).rename_columns([key, "part"]).to_batches()
    parts = df.select(key, F.col(value).cast("long").alias(value)).mapInArrow(fold, schema)
    return parts.groupBy(key).agg(F.sum("part").alias("total"))


#: Bytes of the texts that are split at once: their words take many times as much in Python.
SPLIT_BYTES = 1 << 20


def pieces(rows: pa.RecordBatch, text: int, most: int = SPLIT_BYTES) -> Iterator[pa.RecordBatch]:
    """``rows`` cut where the texts of a piece would pass ``most`` bytes (a longer text is a piece of its own)."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(rows.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a, done = 0, 0
    while a < rows.num_rows:
        b = max(a + 1, int(np.searchsorted(upto, done + most, side="right")))
        yield rows.slice(a, b - a)
        a, done = b, int(upto[b - 1])


def make_word_udtf():
    """Arrow table function over a table of (id, text): one row per
    space-separated word (JVM split rule), a piece of a batch at a time."""
    from pyspark.sql.functions import arrow_udtf

    @arrow_udtf(returnType="id long, pos int, word string")
    class SplitWords:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            for piece in pieces(rows, 1):
                yield self.split(piece)

        def split(self, rows: pa.RecordBatch) -> pa.Table:
            ids, words, pos = [], [], []
            for i, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                if text is None:
                    continue
                own = text.rstrip(" ").split(" ") if text.strip(" ") else ([""] if text == "" else [])
                ids += [i] * len(own)
                words += own
                pos += range(len(own))
            return pa.table({"id": pa.array(ids, pa.int64()), "pos": pa.array(pos, pa.int32()), "word": pa.array(words, pa.string())})

    return SplitWords
