"""Approximate nearest neighbours: a hierarchical k-means tree searched best
bin first.

The tree is fitted on a bounded sample (``SAMPLE`` vectors, the first by a
hash of their id) and sent to the tasks; its size depends on the sample, not
on the table. Every vector is then put into its leaf. A query opens the
nodes of the tree in order of their centres' distance, through a priority
queue, and visits the first leaves it meets. How many is calibrated: for up
to ``CALIBRATION`` queries the true neighbours are found by a scan of all
vectors, and the visits are widened until ``TARGET`` of them are reached.

Equal vectors: of each, only the k + 1 rows of smallest id can ever be among
a query's k nearest others, so the index holds those; equal query vectors
are searched once. Leaves are compared in groups of about ``BLOCK`` rows, a
query with the leaves of a group that it visits; a larger leaf is cut into
blocks.

Distances are Euclidean in double precision on the original vectors. Ties go
to the smaller id.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, neither do rows without an
id. Repeated rows (same id, same vector) count once. With fewer than k other
vectors, all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import own_columns, partitions_for, saved

K = 10
SAMPLE = 50_000
BRANCHING = 8
LEAF_SAMPLE = 40      # a node with this many sampled vectors or fewer is a leaf
CALIBRATION = 100
TARGET = 0.97
BLOCK = 4096          # indexed rows compared in one task, about
SEARCHES = 64          # queries searched by a task


@dataclass
class Tree:
    """``children[n]`` are the nodes below n (empty: a leaf), ``centres[n]``
    its centre."""
    centres: np.ndarray
    children: list[list[int]]

    @property
    def leaves(self) -> list[int]:
        return [n for n, c in enumerate(self.children) if not c]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of ``x``: down the nearest centres."""
        at = np.zeros(x.shape[0], dtype=np.int64)
        todo = [0] if self.children[0] else []
        while todo:
            node = todo.pop()
            rows = np.flatnonzero(at == node)
            if not rows.size:
                continue
            below = np.array(self.children[node])
            at[rows] = below[_nearest(x[rows], self.centres[below])]
            todo += [c for c in self.children[node] if self.children[c]]
        return at

    def best_first(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in the order a best-bin-first search meets them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
                continue
            for d, c in zip(((self.centres[below] - q) ** 2).sum(1).tolist(), below):
                heapq.heappush(queue, (d, c))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1) - 2.0 * (x @ centres.T)).argmin(1)


def fit_tree(x: np.ndarray, branching: int = BRANCHING, leaf: int = LEAF_SAMPLE, rounds: int = 8, seed: int = 7) -> Tree:
    """Hierarchical k-means over the sample's rows."""
    rng = np.random.default_rng(seed)
    centres, children = [x.mean(0) if x.size else np.zeros(x.shape[1])], [[]]
    todo = [(0, np.arange(x.shape[0]))]
    while todo:
        node, rows = todo.pop()
        if rows.size <= leaf:
            continue
        own = x[rows]
        c = own[rng.choice(rows.size, branching, replace=False)]
        for _ in range(rounds):
            label = _nearest(own, c)
            size = np.bincount(label, minlength=branching)
            total = np.zeros_like(c)
            np.add.at(total, label, own)
            c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        label = _nearest(own, c)
        parts = [rows[label == j] for j in range(branching)]
        if max(p.size for p in parts) == rows.size:  # equal vectors cannot be parted
            continue
        for j, part in enumerate(parts):
            if part.size:
                children[node].append(len(centres))
                centres.append(c[j])
                children.append([])
                todo.append((len(centres) - 1, part))
    return Tree(np.array(centres), children)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part; v holds the bytes of their
    doubles."""
    v = F.col("v")
    inf = float("inf")
    good = (F.col("vec_id").isNotNull() & v.isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0))
    rows = (own_columns(vectors, id_col, vector_col).toDF("vec_id", "v")
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v")).filter(good))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (most["n"] if most else 0)).mapInArrow(_bytes, "vec_id long, v binary")


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their doubles (a negative zero as zero)."""
    for batch in batches:
        x = batch.column("v").flatten().to_numpy() + 0.0
        size = 8 * (x.size // batch.num_rows) if batch.num_rows else 0
        ends = pa.py_buffer(np.arange(batch.num_rows + 1, dtype=np.int32) * np.int32(size))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(x)])], names=["vec_id", "v"])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column of ``_bytes``, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.float64).reshape(len(column), -1)


def _vector(v: bytes) -> np.ndarray:
    return np.frombuffer(v, np.float64)


def _table(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(1))


def _best(ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest by (distance, id)."""
    if d.size > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        return near[np.lexsort((ids[near], d[near]))][:k]
    return np.lexsort((ids, d))[:k]


def brute_force(vectors: DataFrame, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """(query, vec_id, v, d): for each of the given queries, its k nearest
    rows of ``vectors`` other than itself, by a scan of all."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, names = _matrix(batch.column("v")), batch.column("vec_id").to_numpy()
            out = []
            for q, own in zip(queries, ids):
                rows = np.flatnonzero(names != own)
                d = _distances(x[rows], q)
                near = _best(names[rows], d, k)
                out += [(own, names[r], x[r].tobytes(), e) for r, e in zip(rows[near].tolist(), d[near].tolist())]
            yield _table(out, ["query", "vec_id", "v", "d"], [pa.int64(), pa.int64(), pa.binary(), pa.float64()])
    first = Window.partitionBy("query").orderBy("d", "vec_id")
    return (vectors.mapInArrow(scan, "query long, vec_id long, v binary, d double")
            .withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k).drop("_r"))


def calibrate(vectors: DataFrame, queries: DataFrame, tree: Tree, k: int = K, target: float = TARGET,
              calibration: int = CALIBRATION) -> int:
    """Leaf visits that reach ``target`` of the true neighbours."""
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(calibration).collect()
    if not asked:
        return 1
    points = np.array([_vector(r["v"]) for r in asked])
    truth = brute_force(vectors, [r["vec_id"] for r in asked], points, k).collect()  # calibration * k rows
    place = {r["vec_id"]: {leaf: n for n, leaf in enumerate(tree.best_first(q))} for r, q in zip(asked, points)}
    if not truth:
        return 1
    leaf = tree.leaf_of(np.array([_vector(r["v"]) for r in truth]))
    visits = np.sort([place[r["query"]][x] for r, x in zip(truth, leaf.tolist())])
    return int(visits[max(0, int(np.ceil(target * visits.size)) - 1)]) + 1


def _grouped(in_leaf: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """(group of each leaf, blocks of each group): small leaves share a group
    of about ``BLOCK`` rows, a larger leaf is a group of several blocks."""
    group, total = {}, {}
    now = -1
    for leaf in sorted(in_leaf):
        if now < 0 or total[now] + in_leaf[leaf] > BLOCK:
            now += 1
            total[now] = 0
        group[leaf] = now
        total[now] += in_leaf[leaf]
    return group, {g: -(-n // BLOCK) for g, n in total.items()}


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``is_query`` (a
    condition on vec_id) selects, against all rows."""
    spark = vectors.sparkSession
    rows = saved(usable(vectors, id_col, vector_col).dropDuplicates(["vec_id", "v"]), "vectors")
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not taken:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(np.array([_vector(r["v"]) for r in taken]))
    del taken
    queries = rows.filter(is_query)
    visits = calibrate(rows, queries, tree, k, target)

    same = Window.partitionBy("v").orderBy("vec_id")
    held = rows.withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k + 1).drop("_r")

    @F.arrow_udf("long")
    def leaf_of(v: pa.Array) -> pa.Array:
        return pa.array(tree.leaf_of(_matrix(v)) if len(v) else [], pa.int64())

    index = saved(held.withColumn("leaf", leaf_of("v")), "ann-index")
    in_leaf = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one per leaf
    group, blocks = _grouped(in_leaf)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, v in zip(batch.column("key").to_pylist(), batch.column("v").to_pylist()):
                at: dict[int, list[int]] = {}
                seen = 0
                for met, leaf in enumerate(tree.best_first(_vector(v)), 1):
                    if leaf in in_leaf:
                        seen += in_leaf[leaf]
                        at.setdefault(group[leaf], []).append(leaf)
                    if met >= visits and seen > k:
                        break
                out = [(g, b, key, v, leaves) for g, leaves in at.items() for b in range(blocks[g])]
                yield _table(out, ["group", "block", "key", "v", "leaves"],
                             [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())])

    # a search costs much more than its bytes, by which Spark would put all into one task
    searches = partitions_for(queries.count(), SEARCHES)
    asked = queries.groupBy("v").agg(F.min("vec_id").alias("key")).select("key", "v").repartition(searches)
    visiting = asked.mapInArrow(visit, "group long, block long, key long, v binary, leaves array<long>")
    groups = np.array(sorted(group.items()), dtype=np.int64)
    split = np.array([blocks[g] for g in groups[:, 1]], dtype=np.int64)

    @F.arrow_udf("group long, parts long")
    def group_of(leaf: pa.Array) -> pa.Array:
        at = np.searchsorted(groups[:, 0], leaf.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(groups[at, 1]), pa.array(split[at])], names=["group", "parts"])

    dealt = (index.withColumn("_g", group_of("leaf"))
             .select("vec_id", "v", "leaf", F.col("_g.group").alias("group"),
                     F.pmod(F.xxhash64("vec_id"), F.col("_g.parts")).alias("block")))

    def compare(found: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        if len(found) and len(asking):
            x, names, leaf = _matrix(found.column("v")), found.column("vec_id").to_numpy(), found.column("leaf").to_numpy()
            for key, q, leaves in zip(*(asking.column(c).to_pylist() for c in ("key", "v", "leaves"))):
                rows = np.flatnonzero(np.isin(leaf, leaves))
                d = _distances(x[rows], _vector(q))
                near = _best(names[rows], d, k + 1)
                out += [(key, n, e) for n, e in zip(names[rows[near]].tolist(), d[near].tolist())]
        return pa.Table.from_batches([_table(out, ["key", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()])])

    found = (dealt.groupBy("group", "block").cogroup(visiting.groupBy("group", "block"))
             .applyInArrow(compare, "key long, vec_id long, score double"))
    first = Window.partitionBy("key").orderBy("score", "vec_id")
    # k + 1 nearest of every distinct query vector; a query then leaves itself out
    best = found.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k + 1)
    named = queries.select(F.col("vec_id").alias("query_id"), F.min("vec_id").over(Window.partitionBy("v")).alias("key"))
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (named.join(best, "key").filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
