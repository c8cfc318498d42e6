"""Removal of repeated passages: every window of ``width`` words whose word
sequence starts anywhere else, in the same text or another, is removed.

1. Map: the Rabin-Karp hash of every window is computed, a piece of a batch
   at a time, and the pieces of a task are put together to blocks of about two
   million windows, as each block makes a row for every hash range. Windows
   that repeat inside the block are settled there; of each distinct hash one
   entry (hash, place) goes on, packed per hash range into a few binary rows.
   So a passage that a third of all texts share reaches a reducer once per
   block, not once per text, and equal texts count once.
2. Reduce, per hash range: entries are counted in one sort, whatever the
   number of blocks; the places of those that occur in more than one block
   return to their block.
3. Per block: repeated windows merge into maximal intervals of words, stored
   per distinct text (its hash and length) that loses anything.
4. The texts meet their intervals by that key and are cut.

Windows are compared by 64-bit hashes of all their bytes' words. Every step
is one linear flow of tasks whose rows depend on the input only, so lost
tasks can run again.

Defined results: a null text has no words; texts of fewer than ``width``
words keep all of them. Repeated rows lose all their windows. Kept words are
joined by one space. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import own_columns, saved
from tidewater.llm.words import mix, pieces, releasing, windows

WIDTH = 35
RANGE_WINDOWS = 1 << 20   # windows per hash range, about
LEAST_RANGES = 256
BLOCK_WINDOWS = 1 << 21   # windows per block, about: a block makes a row for each range

_ENTRY = "range int, block long, keys binary, counts binary, settled binary, hashes binary, places binary, wide boolean, known binary"
_ENTRY_SCHEMA = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
                           ("settled", pa.binary()), ("hashes", pa.binary()), ("places", pa.binary()), ("wide", pa.bool_()),
                           ("known", pa.binary())])


def pack_hashes(h: np.ndarray) -> bytes:
    """The low seven bytes; the highest is that of the range."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def unpack_hashes(b: bytes) -> np.ndarray:
    low = np.frombuffer(b, np.uint8).reshape(-1, 7)
    out = np.zeros((low.shape[0], 8), np.uint8)
    out[:, :7] = low
    return out.view("<u8").ravel()


def pack_places(p: np.ndarray) -> tuple[bytes, bool]:
    """Ascending places as 16-bit steps, or whole where a step is too wide."""
    step = np.diff(p, prepend=0)
    wide = bool(step.size and step.max() > 0xFFFF)
    return (p.astype("<u4") if wide else step.astype("<u2")).tobytes(), wide


def unpack_places(b: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(b, "<u4").astype(np.int64) if wide else np.cumsum(np.frombuffer(b, "<u2"), dtype=np.int64)


def _block(held: list[tuple[np.ndarray, ...]], bits: int) -> pa.RecordBatch:
    """Packed entries of the texts held, which have windows, and one row that
    says which texts the places belong to."""
    fp, size, h, n = (np.concatenate(x) for x in zip(*held))
    held.clear()
    key = np.rec.fromarrays((fp, size))
    _, one, back, copies = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    first = np.zeros(n.size, dtype=bool)
    first[one] = True
    h = h[np.repeat(first, n)]
    mine, twin = n[first], copies[back][first] > 1
    order = np.argsort(h)
    begin = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
    times = np.diff(begin, append=h.size)
    settled = np.repeat(twin, mine)
    settled[order[np.repeat(times > 1, times)]] = True
    places = np.minimum.reduceat(order, begin)
    del order, begin, times
    places.sort()
    told = settled[places]
    ours, lens = key.f0[first], key.f1[first]
    name = int((mix(ours.view(np.uint64)) * np.uint64(3) + lens.astype(np.uint64)).sum(dtype=np.uint64).astype(np.int64))
    h = h[places]
    to = (h >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    by = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[by], np.arange((1 << bits) + 1))
    rows = [(name % (1 << bits), name, np.stack((ours, lens)).astype("<i8").tobytes(),
             mine.astype("<i4").tobytes(), np.packbits(settled).tobytes(), None, None, None, None)]
    for r in np.flatnonzero(np.diff(cut)).tolist():
        part = by[cut[r]:cut[r + 1]]
        packed, wide = pack_places(places[part])
        rows.append((r, name, None, None, None, pack_hashes(h[part]), packed, wide, np.packbits(told[part]).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ENTRY_SCHEMA.types)], schema=_ENTRY_SCHEMA)


def _entries(width: int, bits: int):
    """Map side: the entries of each block of ``BLOCK_WINDOWS`` windows, or of
    what a task has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            fp, size = batch.column("fp").to_numpy(), batch.column("size").to_numpy()
            for piece in pieces(batch.column("text")):
                h, n = windows(piece, width)
                if h.size == 0:
                    continue
                some = n > 0
                held.append((fp[piece.rows][some], size[piece.rows][some], h, n[some]))
                count += h.size
                if count >= BLOCK_WINDOWS:
                    yield _block(held, bits)
                    count = 0
        if held:
            yield _block(held, bits)
    return run


_BACK = "block long, keys binary, counts binary, settled binary, places binary"
_BACK_SCHEMA = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("settled", pa.binary()),
                          ("places", pa.binary())])


def _count(rows: pa.Table) -> pa.Table:
    """One hash range: places whose hash occurs in several entries, and in an
    entry that does not know of more, return to their blocks."""
    out, names, hashes, places, known = [], [], [], [], []
    for row in rows.to_pylist():
        if row["keys"] is not None:
            out.append((row["block"], row["keys"], row["counts"], row["settled"], None))
            continue
        h = unpack_hashes(row["hashes"])
        names.append(row["block"])
        hashes.append(h)
        places.append(unpack_places(row["places"], row["wide"]).astype(np.uint32))
        known.append(np.unpackbits(np.frombuffer(row["known"], np.uint8), count=h.size).astype(bool))
    if hashes:
        ends = np.cumsum([h.size for h in hashes])
        h, places, known = (np.concatenate(x) for x in (hashes, places, known))
        order = np.argsort(h)
        same = np.diff(h[order]) == 0
        again = np.zeros(h.size, dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        # entries lie row by row, so those of a row are one run of the places to return
        at = np.flatnonzero(again & ~known)
        cut = np.searchsorted(at, np.concatenate(([0], ends)))
        back = places[at].astype("<u4")
        for i in np.flatnonzero(np.diff(cut)).tolist():
            out.append((names[i], None, None, None, back[cut[i]:cut[i + 1]].tobytes()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, _BACK_SCHEMA.types)],
                                schema=_BACK_SCHEMA)


_SPANS_SCHEMA = pa.schema([("fp", pa.int64()), ("size", pa.int64()), ("spans", pa.list_(pa.int32()))])


def _intervals(width: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        told = next(r for r in rows if r["keys"] is not None)
        fp, size = np.frombuffer(told["keys"], "<i8").reshape(2, -1)
        counts = np.frombuffer(told["counts"], "<i4").astype(np.int64)
        hit = np.unpackbits(np.frombuffer(told["settled"], np.uint8), count=int(counts.sum())).astype(bool)
        for r in rows:
            if r["places"] is not None:
                hit[np.frombuffer(r["places"], "<u4")] = True
        at = np.flatnonzero(hit)
        ends = np.cumsum(counts)
        text = np.searchsorted(ends, at, side="right")
        place = at - (ends - counts)[text]
        # windows that touch or overlap in one text are one interval
        new = np.ones(at.size, dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (place[1:] > place[:-1] + width)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], at.size) - 1
        flat = np.stack((place[begin], place[stop] + width), axis=1).ravel()
        of, firsts = np.unique(text[begin], return_index=True)
        offsets = np.append(firsts, begin.size) * 2
        spans = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))
        return pa.Table.from_arrays([pa.array(fp[of]), pa.array(size[of]), spans.cast(pa.list_(pa.int32()))],
                                    schema=_SPANS_SCHEMA)
    return run


_CUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                         ("spans", pa.list_(pa.int32()))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            total, removed, kept = [], [], []
            for text, spans in zip(rows.column("text"), rows.column("spans").to_pylist()):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                total.append(len(words))
                if spans:
                    stay, at = [], 0
                    for begin, end in zip(spans[::2], spans[1::2]):
                        stay += words[at:begin]
                        at = end
                    words = stay + words[at:]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string()), rows.column("spans").cast(pa.list_(pa.int32()))], schema=_CUT_SCHEMA)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(fp, size, spans): per distinct text that loses words, the maximal
    intervals (begin, end, begin, end, ...) of its words. ``docs`` has fp,
    size and text."""
    total = docs.agg(F.sum("size")).first()[0] or 0
    ranges = LEAST_RANGES
    while ranges * RANGE_WINDOWS < total / 6:  # about a window per six characters
        ranges *= 2
    bits = ranges.bit_length() - 1
    return (docs.select("fp", "size", "text").mapInArrow(releasing(_entries(width, bits)), _ENTRY)
            .groupBy("range").applyInArrow(_count, _BACK)
            .groupBy("block").applyInArrow(_intervals(width), "fp long, size long, spans array<int>")
            # a text that several blocks hold comes back from each, always whole
            .groupBy("fp", "size").agg(F.max("spans").alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the remaining
    text) and spans (the removed intervals of words)."""
    keyed = own_columns(docs, id_col, text_col).toDF("doc_id", "text").withColumns(
        {"fp": F.coalesce(F.xxhash64("text"), F.lit(0)), "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")})
    found = saved(repeated_spans(keyed, width), "repeats")
    return (keyed.join(found, ["fp", "size"], "left").select("doc_id", "text", "spans")
            .mapInArrow(releasing(_cut), "doc_id long, n_words long, n_removed long, kept string, spans array<int>"))
