"""Centroid clustering by a progressive search over Walsh-Hadamard
coefficients.

1. Every vector of ``WIDTH`` components becomes integers floor(SCALE * x) and
   their Walsh-Hadamard transform, in integers, its coefficients in order of
   sequency (coarse to fine). The transform is orthogonal up to the factor
   ``WIDTH``, so differences of all coefficients give exactly WIDTH times the
   squared distance, and those of the first ones a bound from below.
2. The search of a vector adds coefficient differences band by band (1, 1, 2,
   4, ... 32). A centroid whose sum is above what another one can reach at
   most is strictly worse and goes; once ``LEAD`` coefficients are in, the one
   in front is completed and its exact distance is the mark for the others.
   Centroids that stay are summed over all coefficients; of equal ones the
   smaller number wins, as only strictly worse ones went.
3. Sums and counts per centroid are added in the tasks and by Spark; the
   driver gets at most centroids x (WIDTH + 1) numbers a round. A sum of
   transforms goes back to the sum of vectors exactly.

Defined results: vectors that are null, of another length or that hold a null
or non-finite component take no part and get no row. Repeated rows (also of
one id) are vectors each. Centroids start as the kept vectors of the smallest
hashes; ids that are null have none and come last; of equal hashes the vector
smaller in its transform comes first. With fewer vectors than centroids there
are as many centroids as vectors. An empty table, or one without a kept
vector, gives no rows. Other columns of the table are not looked at. Integers
of 2**23 and more are an error: beyond them sums do not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Scratch, own_columns, saved
from tidewater.llm.words import releasing

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LEAD = 8           # coefficients after which the centroid in front is completed
LIMIT = 1 << 23    # integers from here on are an error
BLOCK = 2048       # vectors searched at a time
BANDS = [(0, 1)] + [(1 << i, 2 << i) for i in range(WIDTH.bit_length() - 1)]


def _butterfly(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of each row, in natural order."""
    y, half = x, 1
    while half < WIDTH:
        pairs = y.reshape(len(y), WIDTH // (2 * half), 2, half)
        y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(y), WIDTH)
        half *= 2
    return y


#: Natural number of the coefficient of each sequency (sign changes of its basis row).
_ORDER = np.argsort((np.diff(_butterfly(np.eye(WIDTH, dtype=np.int64)), axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse to fine."""
    return _butterfly(x)[:, _ORDER]


def inverse(y: np.ndarray) -> np.ndarray:
    """The integer rows with these coefficients."""
    natural = np.empty_like(y)
    natural[:, _ORDER] = y
    return _butterfly(natural) // WIDTH


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the kept rows, their integers) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), WIDTH), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, WIDTH)  # nulls become not-a-number
    whole = np.isfinite(values).all(axis=1)
    scaled = np.floor(SCALE * values[whole])
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component beyond {LIMIT // SCALE} does not fit exact sums")
    return rows[whole], scaled.astype(np.int64)


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, x = integers(batch.column("vector"))
        y = transform(x).astype("<i4")
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(rows)), pa.array([r.tobytes() for r in y], pa.binary())], names=["id", "y"])


def _tails(y: np.ndarray) -> np.ndarray:
    """Energy of each row's coefficients behind each band."""
    energy = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
    return np.stack([energy[:, b] if b < WIDTH else np.zeros(len(y), np.int64) for _, b in BANDS], axis=1)


def nearest(y: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, squared distance) of every row; both
    sides as coefficients."""
    n, k = len(y), len(centres)
    row, own = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total = np.zeros(n * k, np.int64)
    mark = np.full(n, np.iinfo(np.int64).max)
    tail_y, tail_c = _tails(y), _tails(centres)
    for band, (a, b) in enumerate(BANDS):
        step = y[row, a:b] - centres[own, a:b]
        total += np.einsum("ij,ij->i", step, step)
        # what is left is at most twice the energy left on both sides
        np.minimum.at(mark, row, total + 2 * (tail_y[row, band] + tail_c[own, band]))
        if b == LEAD:
            first = np.lexsort((own, total, row))[np.flatnonzero(np.diff(row, prepend=-1))]
            rest = y[row[first], b:] - centres[own[first], b:]
            mark[row[first]] = np.minimum(mark[row[first]], total[first] + np.einsum("ij,ij->i", rest, rest))
        left = total <= mark[row]
        row, own, total = row[left], own[left], total[left]
    best = np.lexsort((own, total, row))[np.flatnonzero(np.diff(row, prepend=-1))]
    return own[best], total[best] // WIDTH


def _searched(batches: Iterator[pa.RecordBatch], centres: np.ndarray):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            y = np.frombuffer(b"".join(part.column("y").to_pylist()), "<i4").reshape(-1, WIDTH).astype(np.int64)
            yield part.column("id"), y, *nearest(y, centres)


def _sums(centres: np.ndarray):
    """Rows (centre, place, sum) of a task's vectors; place -1 counts them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres)
        sums, count = np.zeros((k, WIDTH), np.int64), np.zeros(k, np.int64)
        for _, y, own, _ in _searched(batches, centres):
            count += np.bincount(own, minlength=k)
            for c in np.unique(own):
                sums[c] += y[own == c].sum(axis=0)
        held = np.concatenate((count[:, None], sums), axis=1)[count > 0]
        number = np.repeat(np.flatnonzero(count), WIDTH + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(np.tile(np.arange(-1, WIDTH), len(held)), pa.int32()), pa.array(held.ravel())],
            names=["cluster", "place", "total"])
    return run


def _assigned(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, own, distance in _searched(batches, centres):
            yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), pa.array(distance)], names=["id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS,
            rounds: int = ROUNDS, seed: str = "1") -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every kept vector; the final centroids). The hash of a start is that of
    ``<seed>:<id>``."""
    spark = vectors.sparkSession
    with Scratch(spark, "centroids") as keep:
        kind = vectors.schema[id_col].dataType.simpleString()
        y = keep.save(own_columns(vectors, id_col, vector_col).toDF("id", "vector").mapInArrow(releasing(_transformed), f"id {kind}, y binary"))
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
        first = y.orderBy(order.asc_nulls_last(), "y").select("y").limit(centroids).collect()  # as many rows as centroids
        now = inverse(np.array([np.frombuffer(r["y"], "<i4") for r in first], dtype=np.int64).reshape(-1, WIDTH))
        for _ in range(rounds if len(now) else 0):
            sums = y.mapInArrow(releasing(_sums(transform(now))), "cluster int, place int, total long")
            new = np.zeros((len(now), WIDTH + 1), np.int64)
            for r in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
                new[r["cluster"], r["place"] + 1] = r["total"]
            some = new[:, 0] > 0
            now[some] = inverse(new[some, 1:]) // new[some, :1]
        out = saved(y.mapInArrow(releasing(_assigned(transform(now))), f"id {kind}, cluster int, distance long")
                    if len(now) else y.selectExpr("id", "0 as cluster", "0L as distance"), "centroid-vectors")
    inertia = {r["cluster"]: int(r["s"]) for r in
               out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    about = [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, now[c].tolist())).encode()).hexdigest())
             for c, s in inertia.items()]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (out.join(F.broadcast(facts), "cluster")  # a row per centroid
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), now.tolist())
