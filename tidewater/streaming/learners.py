"""Online learners whose model is stored per batch.

Batch b loads the model of the batch before, folds its rows in (the data work
is one Spark aggregate) and stores its own; a replayed batch starts from the
same model again, and a restarted query goes on from the stored one. Scoring
loads the newest model at each of its batches, while training goes on.

Lines are parsed in the stream; rows that cannot be read, or hold a null, are
left out and counted in the stored model (``n_bad``), in the pass that trains.

``PinnedScorer`` scores a stream while another trains: each of its batches
notes the version of the model that it uses before it uses it, so a batch that
is replayed gives the same scores, however far training has gone on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.vectors import parse_labeled, parse_vector
from tidewater.operators.learning import KMeansModel, LinearModel, nearest_centre
from tidewater.streaming.sinks import write_batch
from tidewater.streaming.store import VersionedTable


def vectors_of(lines: DataFrame, names: list[str], text: str = "line") -> DataFrame:
    """A numeric column per element of each line's ``[a,b,...]`` (all null
    for a line of another shape or length)."""
    v = parse_vector(text)
    whole = F.when(F.size(v) == len(names), v)
    return lines.withColumns({n: F.get(whole, i) for i, n in enumerate(names)})


def labeled_of(lines: DataFrame, label: str, names: list[str], text: str = "line") -> DataFrame:
    """As ``vectors_of`` for ``label,a b`` or ``(label,[a,b])`` lines."""
    p = parse_labeled(text)
    whole = F.when(F.size(p["features"]) == len(names), p["features"])
    return lines.withColumns({label: F.when(whole.isNotNull(), p["label"]),
                              **{n: F.get(whole, i) for i, n in enumerate(names)}})


def readable(df: DataFrame, cols: list[str]) -> tuple[DataFrame, Observation]:
    """The rows without a null (or not-a-number) in ``cols``; and the number of
    the others (``n_bad``), known once an action has read the rows."""
    good = None
    for c in cols:
        ok = F.col(c).isNotNull() & ~F.isnan(c)
        good = ok if good is None else good & ok
    seen = Observation()
    good = F.coalesce(good, F.lit(False))
    return df.observe(seen, F.count_if(~good).alias("n_bad")).where(good), seen


class KMeansStream:
    """Training sink of streaming k-means; ``centre{i}`` columns in the store."""

    def __init__(self, out: str, features: list[str], start, weight: float = 0.0, decay: float = 1.0, keep: int = 2):
        self.models, self.features, self.decay = VersionedTable(out, keep), features, decay
        self.start, self.weight = start, weight

    def model(self, spark: SparkSession, before: int | None = None) -> KMeansModel:
        """The newest stored model (of a batch before ``before``), else the
        starting one. It has one row per cluster."""
        held = self.models.read(spark, before)
        if held is None:
            return KMeansModel.from_centres(self.start, self.weight, self.decay)
        rows = held.orderBy("cluster").collect()
        return KMeansModel(np.array([[r[f"c{i}"] for i in range(len(self.features))] for r in rows]),
                           np.array([r["weight"] for r in rows]), self.decay)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        model = self.model(spark, batch_id)
        rows, seen = readable(df, self.features)
        model.train_batch(rows, self.features)
        names = ", ".join(f"c{i} double" for i in range(len(self.features)))
        self.models.write(spark.createDataFrame(
            [(batch_id, i, w, *c, seen.get["n_bad"]) for i, w, c in model.to_rows()],
            f"batch_id long, cluster int, weight double, {names}, n_bad long").coalesce(1), batch_id)

    def score(self, df: DataFrame, before: int | None = None) -> DataFrame:
        """``df`` with the nearest cluster by the newest stored model (of a
        batch before ``before``); null for unreadable rows."""
        return df.withColumn("cluster", nearest_centre(self.features, self.model(df.sparkSession, before).centres.tolist()))


class RegressionStream:
    """Training sink of streaming linear regression."""

    def __init__(self, out: str, features: list[str], label: str, keep: int = 2, **options):
        self.models, self.features, self.label, self.options = VersionedTable(out, keep), features, label, options

    def model(self, spark: SparkSession, before: int | None = None) -> LinearModel:
        held = self.models.read(spark, before)
        if held is None:
            return LinearModel.zeros(len(self.features), **self.options)
        r = held.first()
        return LinearModel(np.array([r[f"w{i}"] for i in range(len(self.features))]), r["intercept"], **self.options)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        model = self.model(spark, batch_id)
        rows, seen = readable(df, [self.label, *self.features])
        model.train_batch(rows, self.features, self.label)
        names = ", ".join(f"w{i} double" for i in range(len(self.features)))
        self.models.write(spark.createDataFrame(
            [(batch_id, *[float(w) for w in model.weights], float(model.intercept), seen.get["n_bad"])],
            f"batch_id long, {names}, intercept double, n_bad long").coalesce(1), batch_id)

    def score(self, df: DataFrame, before: int | None = None, out: str = "y_hat") -> DataFrame:
        return df.withColumn(out, self.model(df.sparkSession, before).predict(self.features))


class PinnedScorer:
    """``foreachBatch`` sink of a scoring query that runs beside the training
    one: scores below ``out``, with the training batch whose model gave them
    (``model_batch``; -1 for the starting model)."""

    def __init__(self, trainer: KMeansStream | RegressionStream, out: str, columns: list[str]):
        self.trainer, self.out, self.columns = trainer, out, columns
        self.pins = VersionedTable(f"{out.rstrip('/')}/_pins")

    def pinned(self, spark: SparkSession, batch_id: int) -> int:
        """The model of a batch: the one noted, else the newest, which is noted."""
        held = self.pins.at(spark, batch_id)
        if held is not None:
            return held.first()["model_batch"]
        have = self.trainer.models.versions(spark)
        newest = have[-1] if have else -1
        self.pins.write(spark.createDataFrame([(newest,)], "model_batch long").coalesce(1), batch_id)
        return newest

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        model = self.pinned(df.sparkSession, batch_id)
        scored = self.trainer.score(df, before=model + 1).withColumn("model_batch", F.lit(model).cast("long"))
        write_batch(scored.select(*self.columns, "model_batch"), self.out, batch_id)
