"""Sliding windows of a reduce function that the user supplies, with or
without an inverse.

``reduce(a, b)`` is any associative Python function on the values of one
column (a struct's value is a dict). Values are first one per key and slide
bucket (by Spark's own aggregates, or by ``reduced_buckets``). Time is cut into
blocks of the window's length, so a window is the end of one block and the
beginning of the next:

* the beginnings are the prefixes of a block, reduced from its first bucket on;
* the ends are, without an inverse, the suffixes of the block before, reduced
  from its last bucket back; with ``inverse(whole, part)``, the block's total
  without the prefix that has left, so suffixes are never computed.

Each bucket goes through ``reduce`` at most twice, and a change of a window
costs one more call, whatever the window's length and slide. A task's group is a
block of one key (at most length / slide buckets), so no key is a single task.

Defined results: rows without a time are left out; a null value is no value
(a bucket of nulls alone is none). A window has a row at every time at which a
bucket of its key enters or leaves it; the value is null when it is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tidewater.operators.windows import US, floor_to, from_micros, to_micros

Reduce = Callable[[Any, Any], Any]


def reduced_buckets(df: DataFrame, ts: str, keys: list[str], value: str, slide_s: int, reduce: Reduce) -> DataFrame:
    """(``*keys``, _b, value): the rows of each key and slide bucket reduced,
    in the tasks that read them and then once more. For a reduce function that
    no built-in aggregate expresses."""
    rows = (df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
            .select(*keys, floor_to(to_micros(ts), slide_s * US).alias("_b"), value))
    schema = to_arrow_schema(rows.schema)

    def merged(table: pa.Table) -> pa.Table:
        held: dict[tuple, Any] = {}
        for r in table.to_pylist():
            at = tuple(r[k] for k in keys) + (r["_b"],)
            held[at] = reduce(held[at], r[value]) if at in held else r[value]
        return pa.Table.from_pylist([dict(zip([*keys, "_b"], at)) | {value: v} for at, v in held.items()], schema=schema)

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from merged(pa.Table.from_batches([batch])).to_batches()
    return rows.mapInArrow(partly, rows.schema).groupBy(*keys, "_b").applyInArrow(merged, rows.schema)


def to_arrow_schema(schema: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])


def _scans(value: str, reduce: Reduce, both: bool, schema: pa.Schema):
    """One block of a key: each bucket with its prefix, and with its suffix or the total."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_b")
        values = rows.column(value).to_pylist()
        up = list(accumulate(values, reduce))
        down = list(accumulate(reversed(values), lambda a, b: reduce(b, a)))[::-1] if both else [up[-1]] * len(up)
        kind = schema.field("_up").type
        rows = rows.drop_columns([value])
        return rows.append_column("_up", pa.array(up, kind)).append_column("_down", pa.array(down, kind)).cast(schema)
    return run


def reduce_windows(per_bucket: DataFrame, keys: list[str], value: str, reduce: Reduce, length_s: int, slide_s: int,
                   inverse: Reduce | None = None) -> DataFrame:
    """(``*keys``, window_end, value): the reduced value of the window at every
    time at which it changes. ``per_bucket`` has a row per key and slide
    bucket ``_b`` (microseconds)."""
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    length, slide = length_s * US, slide_s * US
    kind = per_bucket.schema[value].dataType
    rows = (per_bucket.select(*keys, "_b", value).where(F.col(value).isNotNull())
            .withColumn("_blk", F.floor(F.col("_b") / F.lit(length))))
    scanned_schema = StructType([f for f in rows.schema if f.name != value]).add("_up", kind).add("_down", kind)
    scanned = rows.groupBy(*keys, "_blk").applyInArrow(
        _scans(value, reduce, inverse is None, to_arrow_schema(scanned_schema)), scanned_schema)

    inside = Window.partitionBy(*keys, "_blk").orderBy("_b")
    last = F.lead("_b").over(inside).isNull()
    # what is left of a block once a bucket has left the window
    left = F.struct(F.lead("_down").over(inside).alias("whole"), F.lit(None).cast(kind).alias("gone"), last.alias("empty"))
    if inverse is not None:
        left = F.struct(F.col("_down").alias("whole"), F.col("_up").alias("gone"), last.alias("empty"))
    scanned = scanned.withColumn("_left", left).withColumn("_first", F.row_number().over(inside) == 1)
    old = scanned.schema["_left"].dataType

    def event(block, at, new, rest, changes: bool) -> F.Column:
        return F.struct(block.alias("_blk"), at.alias("_t"), new.cast(kind).alias("_new"), rest.cast(old).alias("_old"),
                        F.lit(changes).alias("_changes"))
    # a block's windows: all of the block before is there at first, its buckets leave, the block's own enter
    here, after, none = F.col("_blk"), F.col("_blk") + 1, F.lit(None)
    whole = F.struct(F.col("_down").alias("whole"), F.lit(None).cast(kind).alias("gone"), F.lit(False).alias("empty"))
    moves = [event(here, F.col("_b") + slide, F.col("_up"), none, True),
             event(after, F.col("_b") + slide + length, none, F.col("_left"), True)]
    first = event(after, after * length, none, whole, False)
    # exploded, not joined from three readings: the scans run once
    every = (scanned.select(*keys, F.explode(F.when(F.col("_first"), F.array(*moves, first)).otherwise(F.array(*moves))).alias("e"))
             .select(*keys, "e.*"))
    order = Window.partitionBy(*keys, "_blk").orderBy("_t")
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    state = (every.select(*keys, "_t", "_changes", F.last("_new", True).over(upto).alias("new"), F.last("_old", True).over(upto).alias("old"),
                          F.lead("_t").over(order).alias("_next"))
             .where(F.col("_changes") & ~F.col("_t").eqNullSafe(F.col("_next"))))  # one row of those at one time
    own = to_arrow_type(kind)

    def rest(held):
        """What is left of the block before; None for nothing."""
        if held is None or held["empty"]:
            return None
        return held["whole"] if held["gone"] is None else inverse(held["whole"], held["gone"])

    @F.arrow_udf(kind)
    def joined(state: pa.Array) -> pa.Array:
        out = []
        for s in state.to_pylist():
            before = rest(s["old"])
            out.append(before if s["new"] is None else s["new"] if before is None else reduce(before, s["new"]))
        return pa.array(out, own)
    return state.select(*keys, from_micros("_t").alias("window_end"), joined(F.struct("new", "old")).alias(value))
