"""Near-duplicate texts: an exact Jaccard join on word shingles by partition
of the universe and pigeonhole.

Sets of distinct ``SHINGLE``-word shingles fall into bands by size (a band's
largest size is a power of two). In a band the universe of shingles is
hash-partitioned into segments. Two sets that link differ in at most H
shingles, H known from their sizes, so of any H + 1 segments at least one is
alike in both; a segment that may differ by one counts twice.

1. Map: a set is indexed by the hash of its part of each segment ("unit"),
   and in some segments (all of a small band, every ``SPARSE``-th of others)
   also by that part with any one shingle left out. It is indexed in its own
   band and in the next if its size can link there. Rows are packed per hash
   range, and a hash that several sets of a piece of a batch share goes on
   once.
2. Reduce: hashes that only one set has are dropped. What is left says how
   many sets share each unit.
3. Allocation: a set needs H + 1 units. Units that no other set shares cost
   nothing and find nothing; a set with enough of them has no partner and is
   done. The others take their cheapest units until they have enough, so
   units shared with many (a common line) are left out where others do.
4. Candidates are verified exactly on their shingles. Only what components
   need is verified: first every set against one partner, the sets linked so
   far become components (contracted by min-label propagation in Spark), and
   later rounds look at a few partners in other components, the last at all
   of these whose parity bitmaps (an exact lower bound of the difference) do
   not rule a link out. So a group of n near copies costs about n pairs, not n squared.
   Sets with too few units (possible only when their shingles crowd into few
   segments) are compared with all sets of their sizes.

Equal sets are one node: copies are never expanded into pairs.

Defined results: words are runs of bytes other than space and \\x09-\\x0D,
A-Z as a-z. A text of fewer words than a shingle has one shingle of all its
words; without words the set is empty and linked with nothing. Null ids are
allowed; a component's id is its smallest id that is not null. Repeated rows
share a component (their own id, if their set is empty). An empty table gives
no rows. Shingles are compared by 64-bit hashes.

Not in the result: links. Pairs of sets that are in one component already are
not verified, so links inside a component are neither listed nor counted, and
there is no number of links of a document. Components are not affected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import as_rows, bounded_batches, own_columns, saved
from tidewater.llm.substring_dedup import pack_hashes, unpack_hashes
from tidewater.llm.words import mix, pieces, releasing, whole_rows, windows

SHINGLE = 5
PERCENT = 80             # link at 100 * intersection >= PERCENT * union
ROOM = 1.2               # segments of a band over the H + 1 its largest sets need
SPARSE = 32              # one segment in so many has one-deletion units
SMALL_BAND = 32          # bands up to this size have them in every segment
RANGE_ROWS = 1 << 20
LEAST_RANGES = 256
STAR_ROUNDS = 3
BLOCK = 4096             # sets of a group compared in one task
PARITY = 8               # bits of a bitmap per shingle of its band's largest set
LEADERS = 4              # sets of a hash that others are compared with in a round

# role of an index row (two low bits of its node): own band or next, whole or one left out
OWN, NEXT, OWN_LESS, NEXT_LESS = range(4)


def most_apart(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Largest symmetric difference of a set of size n with a set, no larger,
    that it links with."""
    n = np.asarray(n, dtype=np.int64)
    low = -(-n * percent // 100)
    best = np.zeros_like(n)
    for back in range(0, 2 * (100 + percent)):  # sums of sizes, from 2n down, over a period of the rounding
        both = 2 * n - back
        common = -(-both * percent // (100 + percent))
        best = np.where((both - n >= low) & (both > n), np.maximum(best, both - 2 * common), best)
        if back > 12 and percent == PERCENT:     # 9 for 80 percent
            break
    return best


def band_of(n: np.ndarray) -> np.ndarray:
    """Number of the band: its sets have up to 2 ** band shingles."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def segments_of(band: np.ndarray, percent: int = PERCENT, room: float = ROOM) -> np.ndarray:
    top = np.int64(1) << np.asarray(band, dtype=np.int64)
    return np.maximum(np.ceil(room * (most_apart(top, percent) + 1)).astype(np.int64), 16)


def shingle_sets(piece, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, by row and hash."""
    h, n = windows(piece, shingle)
    counts = piece.counts
    row = np.repeat(np.arange(n.size), n)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    if short.size:
        row, h = np.concatenate((row, short)), np.concatenate((h, whole_rows(piece, short)))
    order = np.argsort(h)
    order = order[np.argsort(row[order], kind="stable")]
    row, h = row[order], h[order]
    new = np.ones(h.size, dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _digest(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, two 64-bit sums) that name each row's set."""
    at = np.searchsorted(row, np.arange(rows + 1))
    n = np.diff(at)
    out = []
    for seed in (21, 22):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h, seed), dtype=np.uint64)))
        out.append(mix(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64), seed))
    return n, out[0], out[1]


def _unit_rows(row: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int):
    """Index rows of the given sets: (row, hash, role), and per row the number
    of units and of units' deletions in its own band."""
    at = np.searchsorted(row, np.arange(n.size + 1))
    band = band_of(n)
    out = []
    units = np.zeros((2, n.size), dtype=np.int64)
    for role, bands in ((OWN, band), (NEXT, band + 1)):
        rows = np.flatnonzero(n > 0)
        if role == NEXT:  # the smallest set of the next band it could link with
            least = (np.int64(1) << band) + 1
            rows = rows[n[rows] * 100 >= percent * least[rows]]
        if not rows.size:
            continue
        own = n[rows]
        token = np.repeat(at[rows] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        of = np.repeat(np.arange(rows.size), own)
        m = segments_of(bands[rows], percent)
        base = np.concatenate(([0], np.cumsum(m)))
        seed = mix(bands[rows].astype(np.uint64), 23)
        value = mix(h[token], 24)
        segment = (mix(value ^ seed[of], 25) % m[of].astype(np.uint64)).astype(np.int64)
        cell = base[of] + segment
        size = np.bincount(cell, minlength=base[-1])
        low = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), base[-1]).astype(np.uint64)
        high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), base[-1]).astype(np.uint64)
        total = low + (high << np.uint64(32))
        full = np.flatnonzero(size)
        owner = np.searchsorted(base, full, side="right") - 1
        name = mix(seed[owner] + (full - base[owner]).astype(np.uint64), 26)
        out.append((rows[owner], mix(total[full] ^ mix(name + size[full].astype(np.uint64), 27), 28), np.full(full.size, role)))
        deep = (size[cell] >= 2) & (((np.int64(1) << bands[rows])[of] <= SMALL_BAND) | (segment % SPARSE == 0))
        cell, of_deep = cell[deep], of[deep]
        name = mix(seed[of_deep] + (cell - base[of_deep]).astype(np.uint64), 26)
        less = mix((total[cell] - value[deep]) ^ mix(name + (size[cell] - 1).astype(np.uint64), 27), 28)
        out.append((rows[of_deep], less, np.full(less.size, role + 2)))
        if role == OWN:
            units[0] = np.bincount(rows[owner], minlength=n.size)
            units[1] = np.bincount(rows[of_deep[np.unique(cell, return_index=True)[1]]], minlength=n.size)
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    row, name, role = (np.concatenate(x) for x in zip(*(out or [empty])))
    return row, name, role, units


_PACKED = ("range int, hashes binary, nodes binary, known binary, doc_id long, fp long, node long, other long, n int, "
           "units int, deep int")
_PACKED_SCHEMA = pa.schema([("range", pa.int32()), ("hashes", pa.binary()), ("nodes", pa.binary()), ("known", pa.binary()),
                            ("doc_id", pa.int64()), ("fp", pa.int64()), ("node", pa.int64()), ("other", pa.int64()),
                            ("n", pa.int32()), ("units", pa.int32()), ("deep", pa.int32())])


def _node(first: np.ndarray) -> np.ndarray:
    """The two low bits of a node carry a row's role."""
    return first & ~np.uint64(3)


def _index(bits: int, shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_id")
            for piece in pieces(batch.column("text"), lower=True):
                rows = piece.rows.stop - piece.rows.start
                row, h = shingle_sets(piece, shingle)
                n, first, other = _digest(row, h, rows)
                node = _node(first)
                _, one = np.unique(np.rec.fromarrays((first, other, n)), return_index=True)
                chosen = np.zeros(rows, dtype=bool)
                chosen[one] = True
                take = chosen[row]
                own = np.where(chosen, n, 0)
                at, name, role, units = _unit_rows(row[take], h[take], own, percent)
                yield _document_rows(names.slice(piece.rows.start, rows), batch.column("fp").slice(piece.rows.start, rows),
                                     node, other, n, chosen, units, bits)
                if not name.size:
                    continue
                who = node[at] | role.astype(np.uint64)
                order = np.argsort(name)
                name, who = name[order], who[order]
                new = np.concatenate(([True], name[1:] != name[:-1]))
                run_ = np.cumsum(new) - 1
                several = np.bincount(run_) > 1
                # a hash that several sets of this piece have: all its rows are kept at once,
                # and only the first goes on, marked
                shared = several[run_]
                if shared.any():
                    yield _packed([(int(name[shared][0] >> np.uint64(64 - bits)), name[shared].astype("<u8").tobytes(),
                                    who[shared].astype("<u8").tobytes(), None)])
                name, who, known = name[new], who[new], several
                cut = np.searchsorted(name >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                yield _packed([(r, pack_hashes(name[cut[r]:cut[r + 1]]), who[cut[r]:cut[r + 1]].astype("<u8").tobytes(),
                                np.packbits(known[cut[r]:cut[r + 1]]).tobytes())
                               for r in np.flatnonzero(np.diff(cut)).tolist()])
    return run


def _packed(rows: list) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _PACKED_SCHEMA.types)]
    rest = [pa.nulls(len(rows), t) for t in _PACKED_SCHEMA.types[len(columns):]]
    return pa.RecordBatch.from_arrays(columns + rest, schema=_PACKED_SCHEMA)


def _document_rows(names, fp, node, other, n, chosen, units, bits) -> pa.RecordBatch:
    rows = len(names)
    part = (mix(node, 29) >> np.uint64(64 - bits)).astype(np.int32)
    counts = [np.where(chosen, u, -1).astype(np.int32) for u in units]  # -1: said by another row of the set
    return pa.RecordBatch.from_arrays(
        [pa.array(part), *[pa.nulls(rows, pa.binary())] * 3, names.cast(pa.int64()), fp.cast(pa.int64()),
         pa.array(node.view(np.int64)), pa.array(other.view(np.int64)), pa.array(n.astype(np.int32)),
         *[pa.array(c) for c in counts]], schema=_PACKED_SCHEMA)


_SHARED = "hash long, who long, doc_id long, fp long, node long, other long, n int, units int, deep int"
_SHARED_SCHEMA = pa.schema([("hash", pa.int64()), ("who", pa.int64()), *list(_PACKED_SCHEMA)[4:]])


def _shared(bits: int):
    """One hash range: index rows whose hash several sets have; rows of
    documents pass."""
    def run(rows: pa.Table) -> pa.Table:
        texts = rows.filter(pc.is_valid(rows.column("node"))).select(_SHARED_SCHEMA.names[2:])
        hashes, nodes, known, keep_h, keep_w = [], [], [], [], []
        packed = rows.filter(pc.is_valid(rows.column("hashes"))).select(["range", "hashes", "nodes", "known"])
        for r in packed.to_pylist():
            who = np.frombuffer(r["nodes"], "<u8")
            if r["known"] is None:  # settled on the map side
                keep_h.append(np.frombuffer(r["hashes"], "<u8"))
                keep_w.append(who)
                continue
            top = np.uint64(r["range"] >> (bits - 8)) << np.uint64(56)
            hashes.append(unpack_hashes(r["hashes"]) | top)
            nodes.append(who)
            known.append(np.unpackbits(np.frombuffer(r["known"], np.uint8), count=who.size).astype(bool))
        if hashes:
            h, w, known = (np.concatenate(x) for x in (hashes, nodes, known))
            order = np.lexsort((~known, w, h))
            h, w, known = h[order], w[order], known[order]
            # equal sets of several pieces are one
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])))
            h, w, known = h[new], w[new], known[new]
            run_ = np.cumsum(np.concatenate(([False], h[1:] != h[:-1])))
            back = (np.bincount(run_) > 1)[run_] & ~known
            keep_h.append(h[back])
            keep_w.append(w[back])
        none = np.zeros(0, np.uint64)
        h, w = np.concatenate([none, *keep_h]), np.concatenate([none, *keep_w])
        index = pa.Table.from_arrays([pa.array(h.view(np.int64)), pa.array(w.view(np.int64)),
                                      *[pa.nulls(h.size, t) for t in _SHARED_SCHEMA.types[2:]]], schema=_SHARED_SCHEMA)
        passed = pa.Table.from_arrays([*[pa.nulls(len(texts), pa.int64())] * 2, *texts.columns], schema=_SHARED_SCHEMA)
        return pa.concat_tables([index, passed]).combine_chunks()
    return run


def _need(n: Column, percent: int) -> Column:
    """H + 1 of a set of size n, as ``most_apart`` gives it."""
    low = F.ceil(n * percent / 100.0)
    options = []
    for back in range(13 if percent == PERCENT else 2 * (100 + percent)):
        both = 2 * n - back
        apart = both - 2 * F.ceil(both * percent / F.lit(100.0 + percent))
        options.append(F.when((both - n >= low) & (both > n), apart).otherwise(F.lit(0)))
    return (F.greatest(*options) + 1).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): every node of ``edges`` (a, b) but the smallest of each
    component, with that smallest node, by alternating large-star and
    small-star steps."""
    edges = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = saved(small, "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b) runs from a node of no other edge to the
    centre of a star: then centres name the components."""
    ends = (edges.select(F.col("a").alias("v"), F.col("b").alias("to"))
            .unionByName(edges.select(F.col("b").alias("v"), F.lit(None).cast("long").alias("to"))))
    return (ends.groupBy("v").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.count(F.lit(1)).alias("all"),
                                  F.count("to").alias("out"))
            .filter((F.col("low") != F.col("high")) | ((F.col("out") > 0) & (F.col("all") > F.col("out")))).isEmpty())


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (node, comp) after links between components (a_comp, b_comp)."""
    root = components(links.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")))
    root = root.select(F.col("node").alias("_old"), F.col("comp").alias("_root"))
    return saved(comps.join(root, F.col("comp") == F.col("_old"), "left")
                 .select("node", F.coalesce("_root", "comp").alias("comp")), "components")


def parity_bits(h: np.ndarray, n: int) -> np.ndarray:
    """Bitmap of ``PARITY`` bits per shingle of the band's largest set: each
    shingle flips one bit. Two bitmaps differ in no more bits than the sets
    differ in shingles; the longer folds onto the shorter by halves."""
    size = PARITY << int(band_of(np.array([n]))[0])
    flips = np.bincount((mix(h, 30) & np.uint64(max(size, 64) - 1)).astype(np.int64), minlength=max(size, 64)) & 1
    return np.packbits(flips.astype(np.uint8))


def _tokens(shingle: int):
    schema = pa.schema([("node", pa.int64()), ("tokens", pa.binary()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text"), lower=True):
                rows = piece.rows.stop - piece.rows.start
                row, h = shingle_sets(piece, shingle)
                at = np.searchsorted(row, np.arange(rows + 1))
                sets = [h[a:b] for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(piece.rows.start, rows), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary()),
                     pa.array([parity_bits(x, x.size).tobytes() for x in sets], pa.binary())], schema=schema)
    return run


def _linked(percent: int):
    schema = pa.schema([("a_comp", pa.int64()), ("b_comp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                common = np.intersect1d(x, y, assume_unique=True).size
                good.append(100 * common >= percent * (x.size + y.size - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in schema.names], schema=schema)
    return run


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The components (a_comp, b_comp) of the pairs (a, b) that link, by
    their whole sets of shingles."""
    x = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return (pairs.join(x, "a").join(y, "b").select("a_comp", "b_comp", "x", "y")
            .mapInArrow(releasing(_linked(percent)), "a_comp long, b_comp long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, fp (hash of the text), n_shingles,
    component_id."""
    texts, named = _named(docs, id_col, text_col, shingle, percent)
    label = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(label, "comp").select("node", "component_id")
    return texts.join(named, "node", "left").select(
        "doc_id", "fp", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _named(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
           percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(every row's doc_id, fp, node, n; every set that is not empty: node,
    comp, least id, and stay: its first row by id, null last, and fp)."""
    bounded_batches(docs.sparkSession)
    keyed = own_columns(docs, id_col, text_col).toDF("doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("fp"))
    total = docs.agg(F.sum(F.octet_length(f"`{text_col}`"))).first()[0] or 0
    ranges = LEAST_RANGES
    while ranges * RANGE_ROWS < total / 11:  # about an index row per two words
        ranges *= 2
    bits = ranges.bit_length() - 1
    table = saved(keyed.mapInArrow(releasing(_index(bits, shingle, percent)), _PACKED)
                  .groupBy("range").applyInArrow(_shared(bits), _SHARED), "jaccard")
    texts = table.filter("node is not null").select("doc_id", "fp", "node", "other", "n", "units", "deep")
    index = saved(table.filter("hash is not null").select("hash", (F.col("who").bitwiseAND(F.lit(-4))).alias("node"),
                                                          (F.col("who").bitwiseAND(F.lit(3))).cast("int").alias("role")).distinct(), "index")
    sets = saved(texts.filter("n > 0").groupBy("node").agg(
        F.max("n").alias("n"), F.max("units").alias("units"), F.max("deep").alias("deep"),
        F.min(F.struct("doc_id", "fp")).alias("rep"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "fp")).alias("stay")), "sets")
    need = sets.select("node", "n", "units", "deep", _need(F.col("n"), percent).alias("need"))

    live = _allocated(index, need)
    nodes = live.select("node")
    crowded = need.filter("units + deep < need").select("node", "n")
    linkable = F.explode(F.sequence(F.ceil(F.col("n") * percent / 100.0).cast("int"), F.col("n")))
    by_size = (crowded.select("node", linkable.alias("n")).join(sets.select(F.col("node").alias("other"), "n"), "n")
               .filter("node <> other").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"),
                                               F.greatest("node", "other").alias("a_comp"), F.least("node", "other").alias("b_comp")))
    some_crowded = not crowded.isEmpty()
    if some_crowded:
        nodes = nodes.unionByName(by_size.select(F.col("a").alias("node"))).unionByName(by_size.select(F.col("b").alias("node")))
    comps = saved(nodes.distinct().select("node", F.col("node").alias("comp")), "components")
    reps = (sets.join(comps, "node", "left_semi")
            .select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.fp").alias("_fp")))
    tokens = saved(keyed.join(reps, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
                   .select("node", "text").mapInArrow(releasing(_tokens(shingle)), "node long, tokens binary, bits binary")
                   .dropDuplicates(["node"]), "tokens")

    for turn in range(STAR_ROUNDS + 1):
        placed = live.join(comps, "node") if turn else live.withColumn("comp", F.col("node"))
        found = _star(placed, turn, percent) if turn < STAR_ROUNDS else _across(placed, tokens, percent)
        if some_crowded and not turn:
            found = found.unionByName(by_size.distinct())
        comps = _merged(comps, _verified(found, tokens, percent))

    return texts, sets.select("node", "least", "stay").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _allocated(index: DataFrame, need: DataFrame) -> DataFrame:
    """(hash, node, n, probe): the index rows of the hashes that any set
    probes; ``probe`` marks the cheapest units that bring a set to its need."""
    cost = index.groupBy("hash").agg(F.count_distinct("node").alias("cost"))
    shared = index.filter(F.col("role").isin(OWN, OWN_LESS))
    held = shared.groupBy("node").agg(F.count(F.when(F.col("role") == OWN, 1)).alias("whole"),
                                      F.count(F.when(F.col("role") == OWN_LESS, 1)).alias("less"))
    # units that no other set shares are enough by themselves, or leave a lack
    free = F.col("units") - F.col("whole") + F.greatest(F.lit(0), F.col("deep") - F.col("less") - F.col("whole"))
    lack = held.join(need, "node").select("node", "whole", (F.col("need") - free).alias("lack")).filter("lack > 0")
    order = Window.partitionBy("node", "role").orderBy("cost", "hash")
    probes = saved(shared.join(lack, "node").join(cost, "hash").withColumn("_r", F.row_number().over(order))
                   .filter(((F.col("role") == OWN) & (F.col("_r") <= F.col("lack")))
                           | ((F.col("role") == OWN_LESS) & (F.col("lack") > F.col("whole")))).select("hash", "node"), "probes")
    # a probe's own index row is among the rows of its hash
    rows = (index.select("hash", "node", F.lit(0).alias("p")).unionByName(probes.select("hash", "node", F.lit(1).alias("p")))
            .groupBy("hash", "node").agg(F.max("p").alias("p")))
    asked = probes.select("hash").distinct()
    return saved(rows.join(asked, "hash", "left_semi").join(need.select("node", "n"), "node")
                 .select("hash", "node", "n", (F.col("p") == 1).alias("probe")), "live")


def _pair(other: str) -> list[Column]:
    """(a, b) with their components, of a row's node and ``other`` (a struct)."""
    first = F.col("node") > F.col(f"{other}.node")
    return [F.greatest("node", f"{other}.node").alias("a"), F.least("node", f"{other}.node").alias("b"),
            F.when(first, F.col("comp")).otherwise(F.col(f"{other}.comp")).alias("a_comp"),
            F.when(first, F.col(f"{other}.comp")).otherwise(F.col("comp")).alias("b_comp")]


def _star(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every live set against a few partners of other components. Each hash
    names ``LEADERS`` of its sets, the first in orders that change by turn (at
    first one, in an order of the components); a set takes those it shares
    most hashes with. Sets of a large component rarely meet a leader of
    another one, sets outside it mostly do. ``placed`` is the live rows with
    components."""
    seeds = range(turn * LEADERS, turn * LEADERS + (LEADERS if turn else 1))
    member = ["comp", "node", "n"]
    ends = (placed.groupBy("hash").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                       *[F.min(F.struct(F.xxhash64("node", F.lit(s)).alias("o"), *member)).alias(f"e{s}") for s in seeds])
            .filter("low <> high")
            .select("hash", F.array_distinct(F.array(*[F.struct(*[F.col(f"e{s}.{m}") for m in member]) for s in seeds])).alias("ends")))
    met = (placed.join(ends, "hash").withColumn("end", F.explode("ends"))
           .filter((F.col("comp") != F.col("end.comp")) & _sizes_link("n", "end.n", percent))
           .groupBy("node", "comp", "end").count())
    first = Window.partitionBy("node").orderBy(F.desc("count"), "end")
    return (met.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= len(seeds)).select(*_pair("end")))


_PAIRS = "a long, b long, a_comp long, b_comp long"
_PAIRS_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("a_comp", pa.int64()), ("b_comp", pa.int64())])


def _near(percent: int):
    """Pairs of one group that may link: of different components, with a
    probe of one at a hash of the other, of sizes and with bitmaps that do
    not rule a link out. The group has a row per set and hash; rows of
    another block than the group's first are compared with the first's only."""
    def run(rows: pa.Table) -> pa.Table:
        col = {c: rows.column(c).to_numpy() for c in ("hash", "node", "n", "comp", "probe", "own", "first", "second")}
        node, one, back = np.unique(col["node"], return_index=True, return_inverse=True)
        n, comp, own = col["n"][one].astype(np.int64), col["comp"][one], col["own"][one]
        order = np.argsort(back, kind="stable")
        begin = np.searchsorted(back[order], np.arange(node.size + 1))
        hashes, probe = col["hash"][order], col["probe"][order]

        def asks(i: int, j: int) -> bool:
            """Whether set i probes a hash of set j."""
            own_rows = slice(begin[i], begin[i + 1])
            return np.isin(hashes[own_rows][probe[own_rows]], hashes[begin[j]:begin[j + 1]]).any()

        raw = [b.as_buffer() for b in rows.column("bits").take(pa.array(one))]
        bits = [np.frombuffer(b, np.uint8) for b in raw]
        while len({b.size for b in bits}) > 1:  # fold the longer bitmaps
            least = min(b.size for b in bits)
            bits = [b if b.size == least else b[:b.size // 2] ^ b[b.size // 2:] for b in bits]
        bits = np.stack(bits).view(np.uint64)
        left = own == col["first"][0]
        right = np.flatnonzero(own == col["second"][0])
        out = []
        for i in np.flatnonzero(left).tolist():
            js = right[comp[right] != comp[i]]
            js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
            if not js.size:
                continue
            both = n[js] + n[i]
            apart = both - 2 * -(-both * percent // (100 + percent))
            js = js[np.bitwise_count(bits[js] ^ bits[i]).sum(1, dtype=np.int64) <= apart]
            out += [(max(node[i], node[j]), min(node[i], node[j]), *((comp[i], comp[j]) if node[i] > node[j] else (comp[j], comp[i])))
                    for j in js.tolist() if asks(i, j) or asks(j, i)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], schema=_PAIRS_SCHEMA)
    return run


def _across(placed: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets of different components of which one probes a hash
    of the other and whose bitmaps do not rule a link out.

    Hashes are grouped by the first of their sets (in an order of hashed
    nodes), so that the many hashes two near sets share meet in few groups;
    groups of more than ``BLOCK`` sets are dealt out in pairs of blocks."""
    mixed = (placed.groupBy("hash").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                        F.min(F.struct(F.xxhash64("node").alias("o"), "node"))["node"].alias("head"))
             .filter("low <> high").select("hash", "head"))
    rows = placed.join(mixed, "hash")
    # an upper bound of the sets of a head, by its rows
    blocks = rows.groupBy("head").agg(F.ceil(F.approx_count_distinct("node") * 1.2 / BLOCK).cast("int").alias("blocks"))
    dealt = (rows.join(blocks, "head").withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")}))
    return (dealt.join(tokens.select("node", "bits"), "node")
            .select("hash", "node", "n", "comp", "probe", "own", "head", "first", "second", "bits")
            .groupBy("head", "first", "second").applyInArrow(_near(percent), _PAIRS).distinct())


def _sizes_link(x: str, y: str, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, of each component only one: of its smallest id
    (null last), by the hash of the text. Of rows without words one of each
    id and text stays."""
    texts, named = _named(docs, id_col, text_col, **options)
    stay = (named.groupBy("comp").agg(F.min("stay").alias("stay")).select("stay.doc_id", "stay.fp")
            .unionByName(texts.filter("n = 0").select("doc_id", "fp").distinct()).toDF("stay_id", "stay_fp"))
    text = F.col(f"`{text_col}`")
    keyed = as_rows(docs, id=F.col(f"`{id_col}`"), t=text, fp=F.xxhash64(text))
    twin = Window.partitionBy("id", "fp").orderBy("t")
    # rows alike in id and text: the join keeps them all, the row number one
    return (keyed.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("fp") == F.col("stay_fp")), "left_semi")
            .withColumn("twin", F.row_number().over(twin)).filter("twin = 1").select("_doc.*"))
