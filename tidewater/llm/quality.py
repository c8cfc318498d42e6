"""Quality classifier: naive Bayes support vectors.

A text becomes indicators of hashed n-grams: its words (A-Z as a-z) and pairs
of words, and one to three successive word shapes. A shape is a word with
every run of letters, capitals, digits or other alphabets as one sign and
with its punctuation, marked when the word repeats the one before it. The
indicators are scaled by the class log-count ratios of naive Bayes and brought
to length one; a linear hinge-loss model is fitted by dual coordinate
descent, and its margin is mapped to a probability by a logistic fit on rows
that the descent has not seen.

Fitting uses a bounded sample of labelled rows, the first ``SAMPLE`` of each class by
a hash of the id, and reads their whole texts. Of a text with more than
``KEPT_FEATURES`` distinct n-grams, those first in a fixed shuffled order of all
features are kept (the same ones in every text), so the driver gets at most
8 * SAMPLE * KEPT_FEATURES bytes. Scoring is a map over all rows and their whole
texts and uses every n-gram, with the model (``2 ** BITS`` weights) sent to the
tasks.

Defined results: a null or empty text has no n-gram and gets the score of the
bias alone. Labels that are null are left out; of several labels of an id the
smallest counts, of several texts the one smallest by its features. Without labels of both classes, every score is the share of
label 1 (0.5 without any). Repeated rows get the same score. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, own_columns
from tidewater.llm.words import mix, release_memory, releasing, rolling, row_slices, text_bytes, word_bounds

BITS = 20
SAMPLE = 3000         # labelled rows of each class, at most
KEPT_FEATURES = 4096  # features of a text that fitting keeps; scoring uses all
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3
SMOOTHING = 1.0
COST = 4.0
EPOCHS = 12
PIECE = 1 << 18       # bytes of text worked on at a time

# Class of each byte: its own value for punctuation, one for each kind of letter.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[ord("a"):ord("z") + 1] = 300
_CLASS[ord("A"):ord("Z") + 1] = 301
_CLASS[ord("0"):ord("9") + 1] = 302
_CLASS[0x80:] = 303
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A"):ord("Z") + 1] += 32


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct n-grams of each row, in order of rows."""
    start, end, first = word_bounds(data, offsets)
    if not start.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(first.size - 1), np.diff(first))
    word = rolling(mix(_LOWER[data], 1), start, end)
    kind = _CLASS[data]
    begins = np.zeros(data.size, dtype=bool)
    begins[start] = True
    keep = begins.copy()
    keep[1:] |= kind[1:] != kind[:-1]
    at = np.concatenate(([0], np.cumsum(keep)))
    shape = rolling(mix(kind[keep], 2), at[start], at[end])
    last1, last2 = row[1:] == row[:-1], row[2:] == row[:-2]  # in one row with the word before, and two before
    again = np.zeros(word.size, dtype=bool)
    again[1:] = last1 & (word[1:] == word[:-1])
    shape = mix(shape + again.astype(np.uint64), 3)
    grams = [(row, mix(word, 4)), (row[1:][last1], mix(word[1:] ^ mix(word[:-1], 5), 6)[last1]), (row, shape),
             (row[1:][last1], mix(shape[1:] ^ mix(shape[:-1], 7), 8)[last1]),
             (row[2:][last2], mix(shape[2:] ^ mix(shape[1:-1] ^ mix(shape[:-2], 9), 10), 11)[last2])]
    key = np.concatenate([(r.astype(np.uint64) << np.uint64(bits)) | (g >> np.uint64(64 - bits)) for r, g in grams])
    key = np.unique(key).astype(np.int64)
    return key >> bits, key & ((1 << bits) - 1)


@dataclass
class Model:
    """``weight`` and ``square`` by feature: of the margin's sum, and of the
    squared length it is divided by."""
    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        total = np.bincount(row, self.weight[feature], rows)
        length = np.sqrt(np.bincount(row, self.square[feature], rows))
        return total / np.where(length > 0, length, 1.0) + self.bias

    def score(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(row, feature, rows) + self.shift, -60, 60)))


def log_count_ratios(docs: list[np.ndarray], y: np.ndarray, bits: int = BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log of the smoothed share of a feature in class 1 over that in class 0;
    0 for features that the sample does not have."""
    counts = np.zeros((2, 1 << bits))
    for d, c in zip(docs, y):
        counts[int(c), d] += 1
    p, q = counts[1] + smoothing, counts[0] + smoothing
    return np.where(counts.sum(0) > 0, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def dual_descent(docs: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: np.ndarray,
                 epochs: int = EPOCHS, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: one dual variable at a time,
    each held within [0, its cost]."""
    w, b = np.zeros(size), 0.0
    alpha, sign = np.zeros(len(docs)), np.where(y > 0, 1.0, -1.0)
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(docs)):
            gradient = sign[i] * (w[docs[i]] @ values[i] + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * sign[i]) != 0.0:
                w[docs[i]] += step * values[i]
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, b


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of P(1) by Newton steps, with a little regularization."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * margin + b, -60, 60)))
        g = np.array([(weight * (p - y) * margin).sum() + 0.01 * a, (weight * (p - y)).sum()])
        v = weight * p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 0.01, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(docs: list[np.ndarray], y: np.ndarray, share: float, bits: int = BITS) -> Model:
    """The model of sampled rows; ``share`` is that of label 1 among all."""
    size = 1 << bits
    if not (y == 1).any() or not (y == 0).any():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(size), np.zeros(size), 0.0, 1.0, float(np.log(share / (1 - share))))
    spare = np.arange(len(docs)) % 4 == 3  # kept from the descent for the logistic fit
    ratio = log_count_ratios([d for d, s in zip(docs, spare) if not s], y[~spare], bits)
    values = []
    for d in docs:
        v = ratio[d]
        length = np.sqrt(v @ v)
        values.append(v / length if length > 0 else v)
    rows = np.flatnonzero(~spare)
    each = np.bincount(y[rows].astype(int), minlength=2)
    w, b = dual_descent([docs[i] for i in rows], [values[i] for i in rows], y[rows], size,
                        COST * rows.size / 2 / np.maximum(each[y[rows].astype(int)], 1))
    rows = np.flatnonzero(spare)
    margin = np.array([w[docs[i]] @ values[i] + b for i in rows])
    each = np.bincount(y[rows].astype(int), minlength=2)
    prior = np.where(y[rows] == 1, share / max(each[1], 1), (1 - share) / max(each[0], 1)) * rows.size
    slope, shift = logistic(margin, y[rows].astype(float), prior)
    return Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), b, slope, shift)


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


def kept_features(feature: np.ndarray, most: int | None = None) -> np.ndarray:
    """At most ``most`` of a text's features, by a shuffled order of all."""
    most = KEPT_FEATURES if most is None else most
    if feature.size <= most:
        return feature
    return np.sort(feature[np.argsort(mix(feature.astype(np.uint64), 13), kind="stable")[:most]])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for rows in row_slices(offsets, PIECE):
            own = offsets[rows.start:rows.stop + 1]
            row, feature = features(data[own[0]:own[-1]], own - own[0])
            n = rows.stop - rows.start
            at = np.searchsorted(row, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(rows.start, n).cast(pa.int64()), batch.column("label").slice(rows.start, n).cast(pa.int32()),
                 pa.array([kept_features(feature[a:b]).astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["doc_id", "label", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit on the labelled rows outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    known = (own_columns(labels, id_col, label_col).toDF("doc_id", "label").dropna()
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label")))
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = count.get(1, 0) / max(sum(count.values()), 1) if count else 0.5
    order = F.xxhash64("doc_id")
    every = own_columns(docs, id_col, text_col).toDF("doc_id", "text")
    fitting = known.join(every.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = (fitting.filter("label = 1").orderBy(order, "doc_id").limit(sample)
              .unionByName(fitting.filter("label = 0").orderBy(order, "doc_id").limit(sample)))
    texts = every.join(F.broadcast(picked), "doc_id")  # at most 2 * sample rows of two numbers
    # of an id with several texts one is learnt, so the rows are as many as the ids that were picked
    rows = (texts.mapInArrow(releasing(_sampled), "doc_id long, label int, features binary")
            .groupBy("doc_id", "label").agg(F.min("features").alias("features")).collect())
    rows = sorted({(_shuffled(r["doc_id"]), r["doc_id"], bytes(r["features"]), r["label"]) for r in rows})
    model = fit([np.frombuffer(r[2], "<i4") for r in rows], np.array([r[3] for r in rows], dtype=np.int64), share)
    del rows
    release_memory()
    return model


def _shuffled(doc_id: int) -> int:
    """An order of the sampled rows that ids do not follow."""
    return int(mix(np.array([doc_id], dtype=np.int64).view(np.uint64))[0])


def _scores(text: pa.Array, model: Model) -> np.ndarray:
    data, offsets = text_bytes(text)
    out = [np.zeros(0)]
    for rows in row_slices(offsets, PIECE):
        own = offsets[rows.start:rows.stop + 1]
        row, feature = features(data[own[0]:own[-1]], own - own[0])
        out.append(model.score(row, feature, rows.stop - rows.start))
    return np.concatenate(out)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model))],
                                             names=["doc_id", "score"])
    return (own_columns(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(releasing(run), "doc_id long, score double"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns."""
    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(_scores(text, model))
    return docs.filter(scored(F.col(f"`{text_col}`")) >= threshold)
