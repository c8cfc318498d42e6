"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts lie together. The
splitters between shards are found without sorting: every round counts the
exact bytes below a few probe keys around each open splitter (each partition
adds its rows up per probe interval, Spark sums the partials), then narrows
the splitter's bracket to the interval that holds its target. A splitter is
done when a probe is within tolerance. A bracket that narrows down to one
hash value holds a group of equal texts larger than the tolerance: it is
split further by id in the same way. With all splitters known, the rows go
through one exchange.

The driver holds probes and sums only: ``shards * probes`` numbers a round,
whatever the number of rows.

Defined results: a null text has no bytes (its size is ``overhead``); null
ids order as the smallest. Rows equal in both text and id cannot be told
apart and stay in one shard. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import own_columns, partitions_for, saved

SHARDS = 24
OVERHEAD = 8             # bytes a row counts beside its text
TOLERANCE = 0.002        # of a shard's mean bytes
PROBES = 64              # per open splitter and round
ROWS_PER_TASK = 100_000  # rows numbered together in one shard
KEY_MIN, KEY_MAX = -2**63, 2**63 - 1


def _partial(probes: np.ndarray, hot: np.ndarray):
    """Bytes per probe interval of one partition. ``probes`` are sorted keys;
    with ``hot``, interval numbers are kept apart per hot hash value."""
    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, int] = {}
        for part in parts:
            if hot.size:
                at = np.searchsorted(hot, part["h"].to_numpy())
                mine = (at < hot.size) & (hot[np.minimum(at, hot.size - 1)] == part["h"].to_numpy())
                part, at = part[mine], at[mine]
                group = at * (probes.shape[1] + 1)
                place = np.array([np.searchsorted(probes[g], k, side="right") for g, k in zip(at, part["k"].to_numpy())],
                                 dtype=np.int64)
                slot = group + place
            else:
                slot = np.searchsorted(probes, part["h"].to_numpy(), side="right")
            found, back = np.unique(slot, return_inverse=True)
            total = np.zeros(found.size, dtype=np.int64)
            np.add.at(total, back, part["size"].to_numpy())
            for s, b in zip(found.tolist(), total.tolist()):
                sums[s] = sums.get(s, 0) + b
        yield pd.DataFrame({"slot": list(sums), "bytes": list(sums.values())}, dtype="int64")
    return add


def _sums(keys: DataFrame, probes: np.ndarray, hot: np.ndarray, slots: int) -> np.ndarray:
    rows = (keys.select("h", "k", "size").mapInPandas(_partial(probes, hot), "slot long, bytes long")
            .groupBy("slot").agg(F.sum("bytes").alias("bytes")).collect())
    out = np.zeros(slots, dtype=np.int64)
    for r in rows:
        out[r["slot"]] = r["bytes"]
    return out


def _spread(lo: int, hi: int, probes: int) -> list[int]:
    """Up to ``probes`` keys evenly over (lo, hi]."""
    n = min(probes, hi - lo)
    return [lo + (hi - lo) * i // n for i in range(1, n + 1)]


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
              probes: int = PROBES) -> list[tuple[int, int]]:
    """``shards - 1`` composite keys (h, k): a row below the i-th belongs to
    shard i or an earlier one. ``keys`` is (h, k, size)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    goal = [total * i // shards for i in range(1, shards)]
    slack = max(1, int(total / shards * tolerance))
    found: dict[int, tuple[int, int]] = {}
    # bracket of a splitter: bytes below lo <= goal, bytes below hi >= goal
    bracket = {i: [KEY_MIN, KEY_MAX, 0, total] for i in range(len(goal))}
    while open_ := [i for i in bracket if i not in found and bracket[i][1] - bracket[i][0] > 1]:
        at = sorted({p for i in open_ for p in _spread(bracket[i][0], bracket[i][1], probes)} - {KEY_MAX})
        below = np.cumsum(_sums(keys, np.array(at, dtype=np.int64), np.empty(0, np.int64), len(at) + 1))[:len(at)]
        for i in open_:
            lo, hi, lo_b, hi_b = bracket[i]
            for p, b in zip(at, below.tolist()):
                if abs(b - goal[i]) <= slack and (i not in found or abs(b - goal[i]) < best):
                    found[i], best = (p, KEY_MIN), abs(b - goal[i])
                if lo < p < hi and b <= goal[i]:
                    lo, lo_b = p, b
                elif lo < p < hi and b > goal[i]:
                    hi, hi_b = p, b
                    break
            bracket[i] = [lo, hi, lo_b, hi_b]
    rest = {i: bracket[i] for i in bracket if i not in found}
    if rest:
        found.update(_split_groups(keys, goal, rest, slack, probes))
    return [found[i] for i in range(len(goal))]


def _split_groups(keys: DataFrame, goal: list[int], rest: dict, slack: int, probes: int) -> dict:
    """Splitters that fall inside one hash value (a large group of equal
    texts): the same search over the ids of those groups."""
    found = {}
    hot = np.array(sorted({b[0] for b in rest.values()}), dtype=np.int64)
    where = {int(h): n for n, h in enumerate(hot)}
    bracket = {i: [KEY_MIN, KEY_MAX, b[2], b[3]] for i, b in rest.items()}
    while open_ := [i for i in bracket if i not in found]:
        each: dict[int, set] = {n: set() for n in range(hot.size)}
        for i in open_:
            each[where[rest[i][0]]].update(_spread(bracket[i][0], bracket[i][1], probes))
        width = max(len(e) for e in each.values())
        grid = np.array([sorted(e) + [KEY_MAX] * (width - len(e)) for e in each.values()], dtype=np.int64)
        sums = _sums(keys, grid, hot, hot.size * (width + 1)).reshape(hot.size, width + 1)
        for i in open_:
            g, (lo, hi, lo_b, hi_b) = where[rest[i][0]], bracket[i]
            below = rest[i][2] + np.cumsum(sums[g])[:width]
            for p, b in zip(grid[g].tolist(), below.tolist()):
                if abs(b - goal[i]) <= slack:
                    found[i] = (rest[i][0], p)
                    break
                if lo < p < hi and b <= goal[i]:
                    lo, lo_b = p, b
                elif lo < p < hi:
                    hi, hi_b = p, b
            if i not in found and hi - lo <= 1:
                # single rows are larger than the slack: take the nearer side
                found[i] = (rest[i][0], lo if goal[i] - lo_b <= hi_b - goal[i] else hi)
            bracket[i] = [lo, hi, lo_b, hi_b]
    return found


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, h, k, size, text_crc32) of every row; the text is read once."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return (own_columns(docs, id_col, text_col).toDF("doc_id", "text")
            .select("doc_id", F.xxhash64(body).alias("h"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(KEY_MIN)).alias("k"),
                    (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
                    F.crc32(F.encode(body, "UTF-8")).alias("text_crc32")))


def _placed(bounds: list[tuple[int, int]]):
    """Shard of each row, from the sorted splitters."""
    h = np.array([b[0] for b in bounds], dtype=np.int64)
    k = np.array([b[1] for b in bounds], dtype=np.int64)

    @F.pandas_udf("int")
    def shard_of(hs: pd.Series, ks: pd.Series) -> pd.Series:
        first = np.searchsorted(h, hs.to_numpy(), side="left")
        last = np.searchsorted(h, hs.to_numpy(), side="right")
        out = first.copy()
        kv = ks.to_numpy()
        for row in np.nonzero(last > first)[0]:  # rows of a hash value that splitters name
            out[row] = first[row] + np.searchsorted(k[first[row]:last[row]], kv[row], side="right")
        return pd.Series(out.astype(np.int32))
    return shard_of


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                   overhead: int = OVERHEAD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (its place
    in the shard, gapless from 0)."""
    keys = saved(keyed(docs, id_col, text_col, overhead), "shard-keys")
    bounds = splitters(keys, shards, tolerance)
    parts = partitions_for(keys.count(), ROWS_PER_TASK * shards)
    dealt = keys.withColumns({"shard": _placed(bounds)(F.col("h"), F.col("k")),
                              "part": F.pmod(F.xxhash64("h", "k"), F.lit(parts)).cast("int")})
    order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("begin")))
    place = Window.partitionBy("shard", "part").orderBy("h", "k")
    return (dealt.withColumn("place", F.row_number().over(place) - 1).join(begins, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("place")).alias("slot")))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shards: int = SHARDS, overhead: int = OVERHEAD, tolerance: float = TOLERANCE) -> None:
    """Write the documents themselves, one folder ``shard=i`` per shard, all
    columns kept, after the same search and one exchange."""
    bounds = splitters(saved(keyed(docs, id_col, text_col, overhead), "shard-keys"), shards, tolerance)
    h = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    k = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(KEY_MIN))
    name = "shard"
    while name in docs.columns:
        name += "_"
    docs.withColumn(name, _placed(bounds)(h, k)).repartition(name, F.pmod(h, F.lit(8))).write.partitionBy(name).parquet(path)
