"""Time-bucketed and sliding-window counts, change points and top-k.

All forms count per slide bucket first (partial + final aggregation keeps
the first shuffle to one row per key and bucket), and only the bucket
counts are copied into the ``length/slide`` windows that contain them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _epoch():
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

US = 1_000_000


def to_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", _epoch(), ts.cast("timestamp_ntz"))


def from_micros(us: Column | str) -> Column:
    us = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", us, _epoch())


def floor_to(us: Column, step_us: int) -> Column:
    return us - F.pmod(us, F.lit(step_us))


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def bucket_counts(df: DataFrame, ts: str, keys, slide_s: int, count_col: str = "n") -> DataFrame:
    """Rows per (keys, slide bucket); bucket start as microseconds ``_b``."""
    ks = _keys(keys)
    b = floor_to(to_micros(ts), slide_s * US)
    return (df.where(F.col(ts).isNotNull())
            .groupBy(*ks, b.alias("_b"))
            .agg(F.count(F.lit(1)).alias(count_col)))


def windows_of_buckets(per_bucket: DataFrame, keys, length_s: int, slide_s: int,
                       count_col: str = "n") -> DataFrame:
    """Sliding-window counts from counts per (keys, slide bucket ``_b``):
    only those counts are copied into the ``length/slide`` windows."""
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    ks = _keys(keys)
    ratio = length_s // slide_s
    if ratio == 1:
        out = per_bucket.withColumn("_w", F.col("_b"))
    else:
        fanned = (per_bucket
                  .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(ratio - 1))))
                  .withColumn("_w", F.col("_b") - F.col("_k") * F.lit(slide_s * US)))
        out = fanned.groupBy("_w", *ks).agg(F.sum(count_col).alias(count_col))
    return out.select(from_micros("_w").alias("window_start"),
                      from_micros(F.col("_w") + F.lit(length_s * US)).alias("window_end"),
                      *ks, F.col(count_col).cast("bigint").alias(count_col))


def sliding_counts(df: DataFrame, ts: str, keys, length_s: int, slide_s: int,
                   count_col: str = "n") -> DataFrame:
    """Rows per (window, keys) for windows of ``length_s`` every ``slide_s``.

    Windows are ``[start, start + length)`` on the slide grid, as Spark's
    ``window(ts, length, slide)``; only windows holding rows appear.
    Output: ``window_start, window_end, *keys, n`` (``n`` bigint).
    """
    return windows_of_buckets(bucket_counts(df, ts, keys, slide_s, count_col), keys, length_s, slide_s, count_col)


def tumbling_counts(df: DataFrame, ts: str, keys, length_s: int, count_col: str = "n") -> DataFrame:
    return sliding_counts(df, ts, keys, length_s, length_s, count_col)


def keyed_running(df: DataFrame, keys, order_col: str, aggs: dict, block: int) -> DataFrame:
    """Running sums and maxima per key in ``order_col`` order.

    ``aggs`` maps an output column to ``("sum" | "max", input column)``.
    A plain ``sum() over (partition by key)`` puts a whole key into one
    task (and with no key, the whole table); a key holding a third of the
    rows would then run alone.  The running values are computed instead
    per (key, block of ``order_col``), and each block is combined with the
    totals of the earlier blocks of its key, read from a table of block
    totals (one row per key and block).  The join is on the non-null
    columns the rows are partitioned by, so the rows are not shuffled again
    for it.  ``order_col`` must be unique within a key.
    """
    ks = _keys(keys)
    kcols = []
    for i, k in enumerate(ks):
        kcols += [F.col(k).isNull().alias(f"_kn{i}"),
                  F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_kv{i}")]
    part = [c for i in range(len(ks)) for c in (f"_kn{i}", f"_kv{i}")] + ["_blk"]
    d = df.select("*", *kcols,
                  F.coalesce(F.floor(F.col(order_col) / F.lit(block)), F.lit(0)).alias("_blk"))
    fns = {"sum": F.sum, "max": F.max}
    w_local = (Window.partitionBy(*part).orderBy(order_col)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.select("*", *[fns[kind](c).over(w_local).alias(f"_l_{o}") for o, (kind, c) in aggs.items()])
    # Block totals are aggregated partially in each task before their own
    # (small) shuffle; the rows under both branches are the same plan, so
    # Spark reuses its exchange and the input is read once.
    totals = d.groupBy(*part).agg(*[fns[kind](c).alias(f"_t_{o}") for o, (kind, c) in aggs.items()])
    w_blocks = (Window.partitionBy(*part[:-1]).orderBy("_blk")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*part, *[fns[kind](f"_t_{o}").over(w_blocks).alias(f"_o_{o}")
                                     for o, (kind, _) in aggs.items()])
    j = local.join(offsets, part)
    outs = []
    for o, (kind, _) in aggs.items():
        lo, off = F.col(f"_l_{o}"), F.col(f"_o_{o}")
        outs.append((lo + F.coalesce(off, F.lit(0)) if kind == "sum" else F.greatest(lo, off)).alias(o))
    return j.select(*df.columns, *outs)


def running_deltas(per_bucket: DataFrame, keys, cols: list[str], length_s: int, slide_s: int,
                   block_s: int = 86_400, keep_zero: bool = False) -> DataFrame:
    """Counts per (keys, bucket ``_b``) as running totals ``cols`` at every
    time ``_t`` where one changes (the add/subtract form).

    Each bucket count enters the windows ending at ``bucket + slide`` and
    leaves at ``bucket + slide + length``.  Summing the signed deltas per
    (key, end) and running them per key gives the count of every window
    ending at a change point.  Rows: ``2 x`` the number of (key, bucket)
    pairs at most, however small the slide.  Times whose deltas cancel are
    left out unless ``keep_zero``.  Output: ``*keys, _t, *cols`` and the
    deltas ``_d_<col>``.
    """
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    ks = _keys(keys)
    enter = F.col("_b") + F.lit(slide_s * US)
    deltas = per_bucket.select(
        *ks, F.explode(F.array(
            F.struct(enter.alias("t"), *[F.col(c).alias(c) for c in cols]),
            F.struct((enter + F.lit(length_s * US)).alias("t"), *[(-F.col(c)).alias(c) for c in cols]),
        )).alias("e"))
    changed = None
    for c in cols:
        changed = (F.col(c) != 0) if changed is None else changed | (F.col(c) != 0)
    summed = (deltas.groupBy(*ks, F.col("e.t").alias("_t"))
              .agg(*[F.sum(f"e.{c}").alias(c) for c in cols]))
    summed = summed if keep_zero else summed.where(changed)
    named = summed.select(*ks, "_t", *[F.col(c).alias(f"_d_{c}") for c in cols])
    run = keyed_running(named, ks, "_t", {c: ("sum", f"_d_{c}") for c in cols}, block_s * US)
    return run.select(*ks, "_t", *cols, *[f"_d_{c}" for c in cols])


def sliding_change_points(df: DataFrame, ts: str, keys, length_s: int, slide_s: int,
                          count_col: str = "n", block_s: int = 86_400) -> DataFrame:
    """Sliding-window counts as change points (see ``running_deltas``): a
    count holds until the key's next change, zero rows mark where a key
    leaves the window.  Output: ``window_end, *keys, n``."""
    run = running_deltas(bucket_counts(df, ts, keys, slide_s, count_col), keys, [count_col], length_s, slide_s, block_s)
    return run.select(from_micros("_t").alias("window_end"), *_keys(keys),
                      F.col(count_col).cast("bigint").alias(count_col))


#: Blocks of time in a window's length, by which ``top_k_change_points`` prunes keys.
TOP_K_BLOCKS = 5
#: Parts of a block's keys (by hash) that meet its bound in different tasks.
TOP_K_SALTS = 4


def count_intervals(per_bucket: DataFrame, key: str, length_s: int, slide_s: int, count_col: str = "n") -> tuple[DataFrame, DataFrame]:
    """(key, n, _from, _to): the stretches of time in which a key's windowed
    count holds, above zero; and (_t): the times at which any count changes.

    A count holds from one of its changes to its next, which comes within the
    window's length (changes that cancel out included)."""
    run = running_deltas(per_bucket, [key], [count_col], length_s, slide_s, keep_zero=True)
    kn, kv = F.col(key).isNull(), F.coalesce(F.col(key).cast("string"), F.lit(""))
    # the next change of a key: within its block, or the first of its next block
    block = F.floor(F.col("_t") / F.lit(length_s * US))
    r = run.select(key, "_t", count_col, (F.col(f"_d_{count_col}") != 0).alias("_moves"), kn.alias("_kn"), kv.alias("_kv"), block.alias("_blk"))
    inside = F.lead("_t").over(Window.partitionBy("_kn", "_kv", "_blk").orderBy("_t"))
    firsts = r.groupBy("_kn", "_kv", "_blk").agg(F.min("_t").alias("_after")).withColumn("_blk", F.col("_blk") - 1)
    held = (r.withColumn("_in", inside).join(firsts, ["_kn", "_kv", "_blk"], "left")
            .where(F.col(count_col) > 0).withColumn("_to", F.coalesce("_in", "_after")))
    return (held.select(key, F.col(count_col).alias("n"), F.col("_t").alias("_from"), "_to"),
            r.where("_moves").select("_t").distinct())


def _in_blocks(intervals: DataFrame, key: str, width: int) -> DataFrame:
    """Per block of ``width`` and key: its pieces inside the block (an array,
    at most two per slide), its largest and smallest count, and whether it
    holds through the whole block."""
    first, last = (F.floor(c / F.lit(width)) for c in (F.col("_from"), F.col("_to") - 1))
    cut = (intervals.withColumn("_blk", F.explode(F.sequence(first, last)))
           .select(key, "_blk", F.struct(F.greatest("_from", F.col("_blk") * width).alias("_from"),
                                         F.least("_to", (F.col("_blk") + 1) * width).alias("_to"), "n").alias("p")))
    return cut.groupBy("_blk", key).agg(F.collect_list("p").alias("_pieces"), F.max("p.n").alias("_high"), F.min("p.n").alias("_low"),
                                        (F.sum(F.col("p._to") - F.col("p._from")) == width).alias("_whole"))


def _salted(key: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(TOP_K_SALTS)).cast("int")


def _may_lead(blocks: DataFrame, key: str, k: int) -> DataFrame:
    """The keys of each block that can be among its ``k`` first at any time.

    Keys that hold through the block are above their smallest count all the
    time; the k-th of them, by that count and the key, is a bound: a key whose
    largest count is worse comes behind k others throughout. Blocks without k
    such keys have no bound. Every salt of a block has a copy of its bound (a
    row), so a block's keys meet it in ``TOP_K_SALTS`` tasks."""
    order = Window.partitionBy("_blk").orderBy(F.desc("_low"), F.asc_nulls_first(key))
    bound = (blocks.where("_whole").select("_blk", key, "_low").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
             .where(F.col("_r") == k).select("_blk", F.col("_low").alias("_bound"), F.col(key).alias("_bound_key"),
                                             F.explode(F.sequence(F.lit(0), F.lit(TOP_K_SALTS - 1))).alias("_salt")))
    tie = F.col(key).isNull() | (F.col("_bound_key").isNotNull() & (F.col(key) <= F.col("_bound_key")))
    return (blocks.withColumn("_salt", _salted(key)).join(bound, ["_blk", "_salt"], "left")
            .where(F.col("_bound").isNull() | (F.col("_high") > F.col("_bound")) | ((F.col("_high") == F.col("_bound")) & tie))
            .select(key, "_blk", "_pieces"))


def leading_counts(intervals: DataFrame, times: DataFrame, key: str, length_s: int, slide_s: int, k: int) -> DataFrame:
    """(_t, key, n) of the keys that can be among the ``k`` first at a time of
    change: pruned by blocks of time before any count meets the times."""
    width = max(length_s // TOP_K_BLOCKS, slide_s) * US
    pieces = _may_lead(_in_blocks(intervals, key, width), key, k)
    every = F.explode(F.sequence(F.lit(0), F.lit(TOP_K_SALTS - 1)))
    at = times.groupBy(F.floor(F.col("_t") / F.lit(width)).alias("_blk")).agg(F.collect_list("_t").alias("_times")).withColumn("_salt", every)
    met = pieces.withColumn("_salt", _salted(key)).join(at, ["_blk", "_salt"])
    return (met.select(key, "_pieces", F.explode("_times").alias("_t"))
            .select("_t", key, F.explode(F.filter("_pieces", lambda p: (p["_from"] <= F.col("_t")) & (p["_to"] > F.col("_t")))).alias("p"))
            .select("_t", key, "p.n"))


def top_k_change_points(per_bucket: DataFrame, key: str, length_s: int, slide_s: int, k: int = 10,
                        count_col: str = "n") -> DataFrame:
    """The ``k`` largest counts of the window at every time one changes.
    Output: ``window_end, key, n, rank``."""
    intervals, times = count_intervals(per_bucket, key, length_s, slide_s, count_col)
    counts = leading_counts(intervals, times, key, length_s, slide_s, k)
    counts = counts.select(from_micros("_t").alias("window_end"), key, F.col("n").cast("bigint").alias(count_col))
    return top_k_per_window(counts, key, k, count_col, ("window_end",))


def top_k_per_window(counts: DataFrame, key: str, k: int = 10, count_col: str = "n",
                     window_cols=("window_start", "window_end")) -> DataFrame:
    """The ``k`` largest counts of every window, ties broken by key.

    ``row_number`` with a limit lets Spark cut each window to ``k`` rows
    inside the map tasks before the shuffle (window group limit).
    """
    w = Window.partitionBy(*window_cols).orderBy(F.desc(count_col), F.asc_nulls_first(key))
    return (counts.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))
