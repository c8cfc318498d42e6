"""Personal data: fixed patterns, and terms that disclose them by what the
corpus says.

1. One scan of the texts finds the base spans (mail addresses, IPv4
   addresses, card and phone numbers). Every distinct value of a span is a
   protected entity. A term is a run of letters and digits (A-Z as a-z); those
   of up to ``REACH`` terms on either side of a span, outside all spans, are
   paired with its entity, so pairs grow with the spans and
   not with their square.
2. Spark counts, over all documents, those with an entity, those with a
   pair, and those with a term of any pair. With p as shares of documents, a
   term tells log2(p(entity | term) / p(entity)) of the -log2 p(entity) bits
   that the entity holds. A pair seen in at least ``SUPPORT`` different
   surroundings (copies of a passage are one) that tells ``DISCLOSURE`` of
   them or more discloses its entity: whoever reads the term knows the entity,
   though it is not written there.
3. Disclosing terms are spans of the kind ``term`` wherever they stand, beside
   the base spans. ``sanitised`` generalises base spans to what they share
   with many others (mail and address to their domain and network, numbers to
   their ends), terms with digits to their shape, and removes other terms.

Texts are read for terms in tasks that hold a bitmap of the terms looked for
(``2 ** BITMAP_BITS`` bits whatever their number); what passes it is joined with
the terms themselves, so results do not depend on the bitmap.

Defined results: a null text is empty and has no span. Repeated rows are
documents each. Ids may be null or repeat. Without spans, or without a pair of
enough support, no term discloses. An entity that every document holds tells
nothing and has no terms. An empty table gives no rows. Spans of different
kinds may overlap. Columns of the input are kept by ``sanitised``; those it adds
(``spans``, ``sanitised``) must not be among them.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Scratch, own_columns
from tidewater.llm.words import releasing, rolling, row_slices, text_bytes

KINDS = ("email", "ip", "card", "phone", "term")
TERM = KINDS.index("term")
REACH = 8            # terms on either side of a span
SUPPORT = 3          # different surroundings of a pair
DISCLOSURE = 0.98    # share of an entity's information
BITMAP_BITS = 23
GROUP = 1000         # spans of a text told of in one row
SPAN = "array<struct<kind int, start int, end int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match takes whole runs of digits, so none begins inside one
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")

_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_VALUE = np.random.default_rng(20240411).integers(1, 2**63, 256, dtype=np.uint64)
_VALUE[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ is looked at once: the name before it begins where its
    characters do, or where the match before ended."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in m.group().split("."))):
            yield m.span()


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    double = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in double)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
            yield m.span()


FINDERS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (emails, addresses, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    return [(k, s, e) for k, find in enumerate(FINDERS) for s, e in find(text)]


def entity(kind: int, value: str) -> str:
    """Name of a protected value: a digest of its normal form."""
    value = value.lower() if KINDS[kind] == "email" else _DIGITS.sub("." if KINDS[kind] == "ip" else "", value)
    return hashlib.sha256(f"{kind}:{value}".encode()).hexdigest()[:32]


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the terms of the rows, by byte."""
    if not data.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _TERM_BYTE[data]
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, rolling(_VALUE[data], start, end)


def _lowered(raw: bytes) -> str:
    """A term's text, A-Z as a-z."""
    return re.sub(rb"[A-Z]+", lambda m: m.group().lower(), raw).decode("utf-8", "replace")


def near_pairs(text: str, spans: list[tuple[int, int, int]], reach: int) -> Iterator[tuple[str, str, int, int]]:
    """(entity, term, hash of the term, surroundings) of every term near a
    span; surroundings are a hash of all terms near it."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    at = np.concatenate((np.flatnonzero((data & 0xC0) != 0x80), [data.size]))  # byte of each code point
    start, end, key = term_bounds(data, np.array([0, data.size]))
    free = np.ones(start.size, dtype=bool)
    for _, s, e in spans:
        free[np.searchsorted(end, at[s], side="right"):np.searchsorted(start, at[e])] = False
    start, end, key = start[free], end[free], key[free]
    odd = np.arange(1, 4 * reach, 2, dtype=np.uint64)
    for kind, s, e in spans:
        name = entity(kind, text[s:e])
        left, right = np.searchsorted(end, at[s], side="right"), np.searchsorted(start, at[e])
        near = np.arange(max(left - reach, 0), min(right + reach, start.size))
        place = int((key[near] * odd[:near.size]).sum(dtype=np.uint64).astype(np.int64))
        for i in near.tolist():
            yield name, _lowered(raw[start[i]:end[i]]), int(key[i].astype(np.int64)), place


_PAIRS = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("hash", pa.int64()), ("place", pa.int64())]))
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    column = batch.column("text")
    for i in range(batch.num_rows):
        yield i, column[i].as_py() or ""


def _paired(reach: int):
    """(row, entities, pairs) of the texts that have a base span, in rows of
    at most ``GROUP`` spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in _texts(batch):
                spans = base_spans(text)
                pairs = near_pairs(text, spans, reach) if spans else iter(())
                for a in range(0, len(spans), GROUP):
                    names = sorted({entity(k, text[s:e]) for k, s, e in spans[a:a + GROUP]})
                    last = a + GROUP >= len(spans)
                    own = set(pairs if last else itertools.islice(pairs, GROUP * reach))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(i, 1), pa.array([names], pa.list_(pa.string())),
                         pa.array([[dict(zip(("entity", "term", "hash", "place"), p)) for p in own]], _PAIRS)],
                        names=["row", "entities", "pairs"])
    return run


class Bitmap:
    """Bits of the hashes of a table of terms: whether a hash may be one."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, terms: DataFrame) -> Bitmap:
        """Built from at most ``2 ** (BITMAP_BITS - 6)`` rows, whatever the size of ``terms``."""
        bits = BITMAP_BITS
        low = F.expr(f"hash & {(1 << bits) - 1}L")
        rows = (terms.select(F.shiftright(low, 6).alias("w"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("b"))
                .groupBy("w").agg(F.bit_or("b").alias("b")).collect())
        words = np.zeros(1 << (bits - 6), np.int64)
        for r in rows:
            words[r["w"]] = r["b"]
        return cls(words.view(np.uint64))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        low = hashes & np.uint64(self.words.size * 64 - 1)
        return ((self.words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)).astype(bool)


def _term_rows(batch: pa.RecordBatch, bitmap: Bitmap) -> Iterator[tuple[np.ndarray, ...]]:
    """(row of the batch, start, end, hash, bytes, first byte of each row) of
    the terms that pass, a piece of the batch at a time."""
    data, offsets = text_bytes(batch.column("text"))
    for rows in row_slices(offsets):
        own = offsets[rows.start:rows.stop + 1]
        body = data[own[0]:own[-1]]
        start, end, key = term_bounds(body, own - own[0])
        hit = bitmap.may_hold(key)
        start, end, key = start[hit], end[hit], key[hit]
        row = np.searchsorted(own - own[0], start, side="right") - 1
        yield row + rows.start, start, end, key, body, own - own[0], rows.start


def _documents_with(bitmap: Bitmap):
    """(hash, term, documents of this task's piece that have it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, end, key, body, *_ in _term_rows(batch, bitmap):
                if not row.size:
                    continue
                each = pd.DataFrame({"key": key, "row": row, "start": start, "end": end}).drop_duplicates(["key", "row"])
                n = each.groupby("key").agg(start=("start", "first"), end=("end", "first"), n=("row", "size")).reset_index()
                terms = [_lowered(body[a:b].tobytes()) for a, b in zip(n["start"], n["end"])]
                yield pa.RecordBatch.from_arrays([pa.array(n["key"].to_numpy().astype(np.int64)), pa.array(terms, pa.string()),
                                                  pa.array(n["n"].to_numpy().astype(np.int64))], names=["hash", "term", "n"])
    return run


def disclosing_terms(docs: DataFrame, keep: Scratch, text_col: str = "text", reach: int = REACH, support: int = SUPPORT,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(hash, term, disclosure) of the terms that tell at least that share of
    some entity's information; written in ``keep``."""
    texts = own_columns(docs, text_col).toDF("text").withColumn("row", F.monotonically_increasing_id())
    found = keep.save(texts.mapInArrow(releasing(_paired(reach)), "row long, entities array<string>, "
                                       "pairs array<struct<entity string, term string, hash long, place long>>"))
    pairs = (found.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
             .groupBy("row", "entity", "term", "hash").agg(F.min("place").alias("place"))
             .groupBy("entity", "term", "hash").agg(F.count(F.lit(1)).alias("both"), F.count_distinct("place").alias("places"))
             .filter(F.col("places") >= support))
    pairs = keep.save(pairs)
    terms = keep.save(pairs.select("term", "hash").distinct())
    none = terms.select("hash", "term", F.lit(1.0).alias("disclosure"))
    if terms.isEmpty():
        return none
    total = texts.count()
    entities = (found.select("row", F.explode("entities").alias("entity")).distinct()
                .groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity")))
    counted = (texts.mapInArrow(releasing(_documents_with(Bitmap.of(terms))), "hash long, term string, n long")
               .groupBy("hash", "term").agg(F.sum("n").alias("with_term")).join(terms, ["hash", "term"], "left_semi"))
    told = F.log2(F.col("both") * F.lit(float(total)) / F.col("with_entity") / F.col("with_term"))
    holds = F.log2(F.lit(float(total)) / F.col("with_entity"))
    scored = (pairs.join(counted, ["hash", "term"]).join(entities, "entity").filter(F.col("with_entity") < total)
              .withColumn("share", told / holds).filter(F.col("share") >= disclosure))
    return keep.save(scored.groupBy("hash", "term").agg(F.max("share").alias("disclosure")))


def _spans(bitmap: Bitmap | None):
    """All columns but the text, with the base spans and the terms that pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in base_spans(text)] for _, text in _texts(batch)]
            terms: list[list[dict]] = [[] for _ in spans]
            for row, start, end, key, body, first, base in (_term_rows(batch, bitmap) if bitmap else ()):
                if row.size:
                    points = np.concatenate(([0], np.cumsum((body & 0xC0) != 0x80)))
                    origin = points[first]
                    for r, a, b, h in zip(row.tolist(), start.tolist(), end.tolist(), key.astype(np.int64).tolist()):
                        terms[r].append({"hash": h, "term": _lowered(body[a:b].tobytes()),
                                         "start": int(points[a] - origin[r - base]), "end": int(points[b] - origin[r - base])})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(spans, _SPANS), pa.array(terms, _TERMS)],
                names=["row", "id", "spans", "terms"])
    return run


_TERMS = pa.list_(pa.struct([("hash", pa.int64()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, keep: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(row, id, spans) of every row: base spans by kind and start, then the
    disclosing terms. Reads ``keep`` until it is closed."""
    terms = disclosing_terms(docs, keep, text_col, **options)
    some = not terms.isEmpty()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = own_columns(docs, id_col, text_col).toDF("id", "text").withColumn("row", F.monotonically_increasing_id())
    found = keep.save(rows.mapInArrow(releasing(_spans(Bitmap.of(terms) if some else None)),
                                      f"row long, id {kind}, spans {SPAN}, terms array<struct<hash long, term string, start int, end int>>"))
    if not some:
        return found.select("row", "id", "spans")
    # only what passed the bitmap leaves its row
    hits = (found.select("row", F.explode("terms").alias("t")).select("row", "t.*").join(terms, ["hash", "term"], "left_semi")
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.lit(TERM).alias("kind"), "start", "end"))).alias("own")))
    return found.join(hits, "row", "left").select(
        "row", "id", F.concat("spans", F.coalesce("own", F.from_json(F.lit("[]"), SPAN))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def generalised(kind: int, value: str) -> str:
    """What stays of a span."""
    if KINDS[kind] == "email":
        return f"[email at {value.rsplit('@', 1)[1].rsplit('.', 1)[1]}]"
    if KINDS[kind] == "ip":
        return f"[address in {'.'.join(value.split('.')[:2])}]"
    if KINDS[kind] == "card":
        return f"[card ending {_DIGITS.sub('', value)[-4:]}]"
    if KINDS[kind] == "phone":
        return f"[phone ending {_DIGITS.sub('', value)[-2:]}]"
    return re.sub(r"[0-9]", "#", re.sub(r"[^\W0-9_]+", "x", value)) if re.search("[0-9]", value) else "[...]"


def cleaned(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans generalised or removed; of spans that overlap,
    one that begins earlier stands for them up to the last end."""
    out, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
        end = -end
        if start >= at:
            out += [text[at:start], generalised(kind, text[start:end])]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, keep: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every row and column of ``docs`` with ``spans`` and ``sanitised``, the
    text without what they cover. Reads ``keep`` until it is closed."""
    numbered = keep.save(docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row")))
    own = numbered.select(F.col("_row").alias("id"), F.col(f"_doc.`{text_col}`").alias("text"))
    spans = scan(own, keep, "id", "text", **options).select(F.col("id").alias("_row"), F.col("spans").alias("_spans"))

    @F.pandas_udf("string")
    def clean(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cleaned(t, [(s["kind"], s["start"], s["end"]) for s in own])
                          for t, own in zip(text, spans)], dtype=object)
    return (numbered.join(spans, "_row")
            .select("_doc.*", F.col("_spans").alias("spans"), clean(F.col(f"_doc.`{text_col}`"), F.col("_spans")).alias("sanitised")))
