"""Best-two-fit packing of token sequences.

1. Texts are tokenized once, each whole. ``units`` of a text (the last white
   space before a word, and the word) are tokenized by the given tokenizer
   and remembered per Python worker, because a byte-level BPE that splits at
   white space gives a text the ids of its units in turn. Texts in which that
   might not hold (white space beyond ASCII, the text of an added token such
   as ``<|endoftext|>``) are tokenized whole, by the tokenizer as it is loaded.
2. A document longer than a sequence is cut into full pieces; the first takes
   what is left over.
3. Pieces of one length are interchangeable, so the packing is planned on the
   counts per length (at most ``capacity`` numbers, whatever the number of
   rows). A bin is filled greedily with the longest piece that fits; then its
   smallest piece gives way to two unpacked ones that together fill the
   widened gap more tightly. The same pattern is used as often as the counts
   allow, which is what packing one bin after another would do.
4. Every piece gets its number among those of its length (salted, so no
   length meets in one task) and reads its place from the plan.

Defined results: a null text is empty: it has the end token alone. Repeated
rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, own_columns, saved
from tidewater.llm.words import _SPACE, releasing, rolling, row_slices, text_bytes, word_bounds

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
SALTS = 16
TOGETHER = 2000            # units tokenized as one text
REMEMBERED_BYTES = 1 << 25  # of the units' hashes, places and ids that a task keeps
PIECE = 1 << 19            # bytes of text worked on at a time

# White space beyond the bytes that part units, in UTF-8.
_WIDE_SPACE = rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|[\x1c-\x1f]"
_VALUE = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64)


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Units:
    """Token ids of units: unit hashes in order, and their ids in one pool
    (which begins with the end token). A Python worker keeps the tokenizer, a
    task the units."""
    held: dict[tuple[str, int], _Units] = {}

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile(b"|".join([_WIDE_SPACE, *map(re.escape, added)]))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max([end_id, *self.tokenizer.get_vocab().values()]) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a byte-level token has a character for each byte
        for number, t in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[number] = len(t.content.encode())
        self.end_id = end_id
        self.clear()

    @classmethod
    def of(cls, path: str, end_id: int) -> _Units:
        if (path, end_id) not in cls.held:
            cls.held[path, end_id] = cls(path, end_id)
        return cls.held[path, end_id]

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.array([self.end_id], np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_units(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units data[begin:end] in turn, ids per unit). The
        units begin with their white space and end with a word's byte:
        ``TOGETHER`` of them as one text have the same ids, cut apart by the
        tokens' lengths in bytes."""
        length = end - begin
        stop = np.cumsum(length)
        flat = data[np.repeat(begin - (stop - length), length) + np.arange(length.sum())]
        edges = np.concatenate(([0], stop))
        groups = [edges[a:a + TOGETHER + 1] for a in range(0, begin.size, TOGETHER)]
        texts = [flat[g[0]:g[-1]].tobytes().decode() for g in groups]
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for g, own in zip(groups, self.encode(texts)):
            upto = np.concatenate(([0], np.cumsum(self.bytes[own])))
            if upto[-1] != g[-1] - g[0]:
                raise ValueError("the tokenizer is not byte-level: its tokens do not have the text's bytes")
            sizes.append(np.diff(np.searchsorted(upto, g - g[0])))
            ids.append(own)
        return np.concatenate(ids), np.concatenate(sizes)

    def look_up(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in the pool for sorted distinct ``keys``, the hashes
        of data[begin:end]; units not seen before are tokenized."""
        at = np.searchsorted(self.keys, keys)
        new = np.ones(keys.size, dtype=bool)
        inside = at < self.keys.size
        new[inside] = self.keys[at[inside]] != keys[inside]
        if self.keys.size and self.keys.nbytes + self.begin.nbytes + self.size.nbytes + self.pool.nbytes > REMEMBERED_BYTES:
            self.clear()
            new[:] = True
        if new.any():
            whole = np.flatnonzero(new)             # in order of the hashes
            joint = _SPACE[data[begin[whole]]] & ~_SPACE[data[end[whole] - 1]]
            alone = whole[~joint]                   # a text's first word, runs of white space
            ids, size = self.encode_units(data, begin[whole[joint]], end[whole[joint]])
            others = self.encode([data[b:e].tobytes().decode() for b, e in zip(begin[alone], end[alone])])
            size = np.concatenate((size, [i.size for i in others])).astype(np.int32)
            first = self.pool.size + np.concatenate(([0], np.cumsum(size, dtype=np.int64)[:-1]))
            self.pool = np.concatenate([self.pool, ids, *others])
            order = np.argsort(np.concatenate((whole[joint], alone)))  # as the hashes again
            place = np.searchsorted(self.keys, keys[whole])
            self.keys = np.insert(self.keys, place, keys[whole])
            self.begin, self.size = np.insert(self.begin, place, first[order]), np.insert(self.size, place, size[order])
            at = np.searchsorted(self.keys, keys)
        return self.begin[at], self.size[at]


def _segments(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units and the white space between them begin and end."""
    start, end, _ = word_bounds(data, offsets)
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    first = np.zeros(data.size + 1, dtype=bool)
    first[offsets] = True
    edge[end] = True
    edge[np.where(first[start], start, start - 1)] = True
    return np.flatnonzero(edge)


def token_ids(data: np.ndarray, offsets: np.ndarray, units: _Units) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows in turn, each with the end token; tokens per row)."""
    rows = offsets.size - 1
    raw = data.tobytes()
    cut = _segments(data, offsets)
    begin, end = cut[:-1], cut[1:]
    if begin.size:
        keys, one, back = np.unique(rolling(_VALUE[data], begin, end), return_index=True, return_inverse=True)
        at, size = units.look_up(keys, data, begin[one], end[one])
        at, size = at[back], size[back]
    else:
        at, size = np.zeros(0, np.int64), np.zeros(0, np.int32)
    last = np.searchsorted(begin, offsets[1:])       # segments up to the end of each row
    at, size = np.insert(at, last, 0), np.insert(size, last, 1)
    total = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    ids = units.pool[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
    stop = total[last + np.arange(1, rows + 1)]
    counts = np.diff(stop, prepend=0)
    if wide := sorted({int(np.searchsorted(offsets, m.start(), side="right")) - 1 for m in units.whole.finditer(raw)}):
        parts = np.split(ids, stop[:-1])
        whole = units.encode([raw[offsets[r]:offsets[r + 1]].decode() for r in wide])
        for r, own in zip(wide, whole):
            parts[r] = np.append(own, np.uint32(units.end_id))
            counts[r] = parts[r].size
        ids = np.concatenate(parts)
    return ids, counts


_PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                           ("ids", pa.binary())])


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _Units.of(path, end_id)
        try:
            yield from cut(batches, units)
        finally:
            units.clear()

    def cut(batches: Iterator[pa.RecordBatch], units: _Units) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names = batch.column("doc_id").cast(pa.int64())
            for rows in row_slices(offsets, PIECE):
                own = offsets[rows.start:rows.stop + 1]
                ids, counts = token_ids(data[own[0]:own[-1]], own - own[0], units)
                n = -(-counts // capacity)
                row = np.repeat(np.arange(counts.size), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                head = counts - (n - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                at = np.concatenate(([0], np.cumsum(length * 4))).astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), length.size, [None, pa.py_buffer(at), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [names.slice(rows.start, rows.stop - rows.start).take(pa.array(row)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), body], schema=_PIECE_SCHEMA)
    return run


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
              end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of every document; ids
    are unsigned 32-bit little-endian."""
    bounded_batches(docs.sparkSession)
    return (own_columns(docs, id_col, text_col).toDF("doc_id", "text")
            .mapInArrow(releasing(_pieces(path or tokenizer_path(), end_id, capacity)),
                        "doc_id long, piece int, start long, length long, ids binary"))


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(pieces of a bin by length, number of such bins)] for ``counts[l]``
    pieces of length l."""
    left = counts.astype(np.int64).copy()
    bins = []
    while left.any():
        held: dict[int, int] = {}
        gap = capacity
        while gap:
            fits = np.flatnonzero(left[:gap + 1])
            fits = fits[[left[x] > held.get(x, 0) for x in fits.tolist()]] if held else fits
            if not fits.size:
                break
            longest = int(fits[-1])
            n = min(int(left[longest]) - held.get(longest, 0), gap // longest)
            held[longest] = held.get(longest, 0) + n
            gap -= n * longest
        smallest = min(held)
        if gap and (pair := _tighter_pair(left, held, smallest, gap + smallest)):
            held[smallest] -= 1
            if not held[smallest]:
                del held[smallest]
            for x in pair:
                held[x] = held.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in held.items())
        for x, n in held.items():
            left[x] -= n * times
        bins.append((held, times))
    return bins


def _tighter_pair(left: np.ndarray, held: dict[int, int], smallest: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths of the largest sum within ``room``, if it is more
    than ``smallest``."""
    free = [x for x in np.flatnonzero(left[:room]).tolist() if left[x] > held.get(x, 0)]
    best, pair, lo, hi = smallest, None, 0, len(free) - 1
    while lo <= hi:
        both = free[lo] + free[hi]
        if both > room:
            hi -= 1
            continue
        if both > best and (lo < hi or left[free[lo]] - held.get(free[lo], 0) >= 2):
            best, pair = both, (free[hi], free[lo])
        lo += 1
    return pair


def _places(bins: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, from, per bin, first bin, offset): the pieces of a length
    numbered from ``from`` on lie in the bins from ``first bin`` on."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for held, times in bins:
        offset = 0
        for length in sorted(held, reverse=True):
            n = held[length]
            rows.append((length, used.get(length, 0), n, first, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece, length and any more
    columns) with sequence_id and offset."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    table = _places(plan_bins(counts, capacity))
    length, begin, each, first, offset = table.T
    salts = max(SALTS, int(counts.sum()) // 1_000_000)

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        x, j = lengths.to_numpy(), numbers.to_numpy()
        own = np.searchsorted(length, x)               # the length's first row
        row = np.empty(x.size, dtype=np.int64)
        order = np.lexsort((j, x))
        for lo, hi in zip(*_runs(x[order])):           # one length at a time
            take = order[lo:hi]
            stop = np.searchsorted(length, x[take[0]], side="right")
            row[take] = np.searchsorted(begin[own[take[0]]:stop], j[take], side="right") - 1 + own[take[0]]
        inside = j - begin[row]
        return pd.DataFrame({"sequence_id": first[row] + inside // each[row],
                             "offset": offset[row] + inside % each[row] * length[row]})

    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = (salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
              .select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin")))
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1
    return (salted.withColumn("_number", number).join(begins, ["length", "_salt"])
            .withColumn("_at", place("length", F.col("_begin") + F.col("_number")))
            .select(*pieces.columns, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset")))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if values.size else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], values.size) if begin.size else begin


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its token ids and its place: doc_id, piece, start,
    length, ids, sequence_id, offset."""
    return pack(saved(tokenized(docs, id_col, text_col, path, end_id, capacity), "pieces"), capacity)
