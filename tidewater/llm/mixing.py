"""Mix sources to target weights by entropy balancing (DataFrame and SQL only).

Targets: a budget of words is shared among the sources by weight; a source's
target stops at ``most`` times its own size and the excess is shared again by
weight until none is above (water filling, in closed form over the sources
sorted by their level).

Rates: among all document rates that give each source its target number of
words and stay within [0, most], those closest to 1 in relative entropy are
``min(most, exp(lambda_s * size / mean_size_s))``. ``lambda_s`` solves the
convex dual; all sources take a guarded Newton step at once, each an
aggregation over the counts of (source, size). That table of counts is the
only form in which the documents enter the iterations.

Copies: rates are rounded by cumulated fractions over the counts in falling
size, so a source is off by at most about one document; a few repair steps
then add or take back single copies whose size fits what is left. Counts are
split by a hash of the id (``salts``), so no (source, size) meets in one task
when single documents are picked.

Defined results: a null text has size 0; a null source is a source of its own,
last in order. Documents of size 0 take 0 words. An empty table gives no rows.
Rows alike in id, source and size are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import as_rows, own_columns, saved, word_count

WEIGHTS = (5.0, 2.0, 1.0)   # repeated over the sources in order
SHARE = 1.5                 # budget as a multiple of all words
MOST = 2.0                  # a document's copies, and a source's target over its size
SALTS = 64
NEWTON_STEPS = 40
NEWTON_TOLERANCE = 1e-6
REPAIRS = 5


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", salts: int = SALTS) -> DataFrame:
    """(doc_id, source, size, fp, salt) of every row; the text is read once."""
    return (own_columns(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
            .select("doc_id", "source", word_count(F.col("text")).alias("size"),
                    F.xxhash64("text").alias("fp"),
                    F.pmod(F.xxhash64("doc_id", "text"), F.lit(salts)).alias("salt")))


def targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size). The windows
    run over one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rated = (by_source.withColumn("place", F.row_number().over(order) - 1)
             .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
             .withColumn("cap", F.col("source_size") * F.lit(most))
             .withColumn("level", F.col("cap") / F.col("weight")))
    every = Window.partitionBy(F.lit(1))
    below = Window.orderBy("level", "place").rowsBetween(Window.unboundedPreceding, -1)
    # with the sources up to here at their caps, the level of all others
    open_level = ((F.sum("source_size").over(every) * F.lit(share)
                   - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
                  / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))))
    return (rated.withColumn("open", open_level)
            # the first source, by level, that the others' level leaves below its cap
            .withColumn("water", F.min(F.when(F.col("open") <= F.col("level"), F.struct("level", "place", "open")))
                        .over(every)["open"])
            .withColumn("target", F.when(F.col("water").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight"))))
            .select("source", "source_size", "target"))


def _with_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on source, where null equals null; left's source stays."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def solve_rates(counts: DataFrame, goals: DataFrame, most: float = MOST,
                steps: int = NEWTON_STEPS, tolerance: float = NEWTON_TOLERANCE) -> DataFrame:
    """``goals`` with ``tilt`` (lambda) and ``mean_size`` per source, by Newton
    iterations on the dual. ``counts`` is (source, size, n)."""
    mean = (counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size")))
    state = saved(_with_source(goals, mean).select(
        "source", "source_size", "target", "mean_size", F.lit(0.0).alias("tilt"),
        F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"),
        # at the cap or at zero the solution lies at infinity: nothing to iterate
        ((F.col("target") >= most * F.col("source_size") * (1 - 1e-12)) | (F.col("target") <= 0)).alias("done")), "tilt")
    for _ in range(steps):
        if state.filter(~F.col("done")).isEmpty():
            break
        x = F.col("size") / F.col("mean_size")
        raw = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
        words = F.col("size") * F.col("n")
        open_ = state.filter(~F.col("done"))
        got = (_with_source(counts, open_.select("source", "tilt", "mean_size")).filter(F.col("tilt").isNotNull())
               .groupBy("source").agg(F.sum(words * F.least(raw, F.lit(most))).alias("got"),
                                      F.sum(F.when(raw < most, words * x * raw).otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        # no slope where every document is at the cap: no step of Newton's then, but the bracket is halved
        newton = F.col("tilt") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        middle = (F.col("low2") + F.col("high2")) / 2
        state = saved(
            _with_source(state, got)
            .withColumn("gap", gap).withColumn("low2", low).withColumn("high2", high).withColumn("newton", newton)
            .select("source", "source_size", "target", "mean_size",
                    F.when(F.col("got").isNull(), F.col("tilt"))
                    .when(F.abs("gap") <= tolerance * F.col("target"), F.col("tilt"))
                    .when((F.col("newton") > F.col("low2")) & (F.col("newton") < F.col("high2"))
                          & (F.abs(F.col("newton") - F.col("tilt")) <= 1 + F.abs("tilt")), F.col("newton"))
                    # a step of Newton's that leaves the bracket or overshoots: at most double, else halve
                    .when(F.col("gap") < 0, F.least(F.col("tilt") + 1 + F.abs("tilt"), middle))
                    .otherwise(F.greatest(F.col("tilt") - 1 - F.abs("tilt"), middle)).alias("tilt"),
                    F.coalesce(F.col("low2"), F.col("low")).alias("low"),
                    F.coalesce(F.col("high2"), F.col("high")).alias("high"),
                    (F.col("done") | (F.abs(F.coalesce("gap", F.lit(0.0))) <= tolerance * F.col("target"))).alias("done")),
            "tilt")
    return state


def _rate(most: float) -> Column:
    return (F.when(F.col("target") >= most * F.col("source_size") * (1 - 1e-12), F.lit(most))
            .when(F.col("target") <= 0, F.lit(0.0))
            .otherwise(F.least(F.lit(most), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean_size"), F.lit(50.0))))))


def plan_copies(bins: DataFrame, solved: DataFrame, most: float = MOST, repairs: int = REPAIRS) -> DataFrame:
    """(source, size, salt, n, base, extra): ``extra`` of the ``n`` documents
    of a bin are copied ``base + 1`` times, the others ``base`` times."""
    order = Window.partitionBy("source").orderBy(F.desc("size"), "salt")
    rated = (_with_source(bins, solved.drop("low", "high", "done")).withColumn("rate", _rate(most))
             .withColumn("base", F.floor("rate"))
             .withColumn("due", F.sum(F.col("n") * (F.col("rate") - F.col("base"))).over(order)))
    prior = F.coalesce(F.lag("due").over(order), F.lit(0.0))
    plan = rated.select("source", "size", "salt", "n", "target", "base",
                        F.least(F.col("n"), F.greatest(F.lit(0), F.round("due") - F.round(prior))).cast("long").alias("extra"))
    plan = saved(plan, "copies")
    for _ in range(repairs):
        taken = F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra")))
        left = plan.groupBy("source").agg((F.first("target") - taken).alias("left"))
        near = (_with_source(plan, left).filter(F.col("size") > 0)
                .withColumn("way", F.signum("left").cast("long"))
                .filter(((F.col("way") > 0) & (F.col("base") * F.col("n") + F.col("extra") < most * F.col("n"))
                         & ((F.col("extra") < F.col("n")) & (F.col("base") < most)))
                        | ((F.col("way") < 0) & (F.col("extra") > 0)))
                .withColumn("off", F.abs(F.abs("left") - F.col("size")))
                .filter(F.col("off") < F.abs("left"))
                .groupBy("source").agg(F.min(F.struct("off", "size", "salt", "way")).alias("pick")))
        plan = saved(_with_source(plan, near).select(
            "source", "size", "salt", "n", "target", "base",
            (F.col("extra") + F.when((F.col("pick.size") == F.col("size")) & (F.col("pick.salt") == F.col("salt")),
                                     F.col("pick.way")).otherwise(0)).alias("extra")), "copies")
    return plan


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, source, fp (hash of the text), size,
    source_size, target, copies."""
    rows = saved(sizes(docs, id_col, text_col, source_col, salts), "sizes")
    bins = saved(rows.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n")), "bins")
    counts = bins.groupBy("source", "size").agg(F.sum("n").alias("n"))
    by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = saved(targets(by_source, weights, share, most), "targets")
    plan = plan_copies(bins, solve_rates(saved(counts, "counts"), goals, most), most)
    pick = Window.partitionBy("source", "size", "salt").orderBy("fp", "doc_id")
    ranked = rows.withColumn("pick", F.row_number().over(pick))
    p = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.col("salt").alias("p_salt"),
                    "base", "extra")
    found = ranked.join(p, ranked["source"].eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))
                        & (F.col("salt") == F.col("p_salt")))
    return _with_source(found, goals).select(
        "doc_id", "source", "fp", "size", "source_size", "target",
        (F.col("base") + (F.col("pick") <= F.col("extra")).cast("long")).cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix, each repeated by its copies, with the
    columns of ``docs``."""
    twin = Window.partitionBy("id", "fp", "source").orderBy(F.lit(1))  # rows alike in all three, one by one
    plan = (mix(docs, id_col, text_col, source_col, **options).withColumnRenamed("doc_id", "id")
            .withColumn("twin", F.row_number().over(twin)).filter("copies > 0")
            .select(*[F.col(c).alias(f"p_{c}") for c in ("id", "fp", "source", "twin", "copies")]))
    keyed = as_rows(docs, id=F.col(f"`{id_col}`"), fp=F.xxhash64(f"`{text_col}`"), source=F.col(f"`{source_col}`"))
    keyed = keyed.withColumn("twin", F.row_number().over(twin))
    on = (F.col("id").eqNullSafe(F.col("p_id")) & (F.col("fp") == F.col("p_fp"))
          & F.col("source").eqNullSafe(F.col("p_source")) & (F.col("twin") == F.col("p_twin")))
    return (keyed.join(plan, on).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("p_copies").cast("int"))))
            .select("_doc.*"))
