"""Short-text and word operators (posts, documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import is_hashtag, jvm_split, lines, utf16_length
from tidewater.operators.windows import US, keyed_running, to_micros
from tidewater.streaming.batches import batch_start


#: Bytes of the texts whose words one task gathers again: a word's row takes many times its text.
KEYED_BYTES = 8 << 20


def texts_by_key(df: DataFrame, key: str, text: str = "text", most: int = KEYED_BYTES) -> DataFrame:
    """``df`` dealt out by ``key``, as many tasks as keep a task of middle size
    below ``most`` bytes of text. What is exploded from it and grouped by the
    key then needs no shuffle of its own. Takes a pass for the length of the texts."""
    size = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return df.repartition(size // most + 1, key)


def words(df: DataFrame, text: str = "text", keep=("post_id",)) -> DataFrame:
    """One row per space-separated word (JVM split rule), with its position."""
    keep = [c for c in keep if c in df.columns]
    return df.select(*keep, F.posexplode(jvm_split(text)).alias("pos", "word"))


def hashtags(df: DataFrame, text: str = "text", keep=("post_id",)) -> DataFrame:
    """Words that start with '#' (a lone '#' counts)."""
    return words(df, text, keep).where(is_hashtag("word")).withColumnRenamed("word", "hashtag")


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Count of every lower-cased word over the lines of all texts.

    ``groupBy().count()`` aggregates partially in each map task, so a very
    common word (or the empty word) is one row per task before the shuffle.
    """
    # Lower-casing never adds or removes a space or a line break, so the
    # text is lower-cased once instead of once per word.
    ls = df.select(F.explode(lines(F.lower(text))).alias("line"))
    ws = ls.select(F.explode(jvm_split("line")).alias("word"))
    return ws.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_n(df: DataFrame, n: int, order_col: str, key: str) -> DataFrame:
    """The first ``n`` rows by ``order_col`` desc then ``key`` (a top-k
    report: Spark runs it as a per-partition top-k and a final merge)."""
    return df.orderBy(F.desc(order_col), F.asc_nulls_first(key)).limit(n)


def text_lengths(df: DataFrame, text: str = "text", keep=("post_id",)) -> DataFrame:
    keep = [c for c in keep if c in df.columns]
    return df.select(*keep, F.length(text).cast("bigint").alias("length"),
                     utf16_length(text).alias("utf16_length"))


def running_length_totals(df: DataFrame, ts: str, batch_s: int, text: str = "text") -> DataFrame:
    """Totals after each batch: texts, characters (UTF-16 units), the
    integer average (as the reference prints it) and the exact average;
    plus the longest text so far.

    The per-batch aggregate is distributed (one row per batch); the running
    totals over the batches are then computed per day of batches and
    carried across days (``keyed_running``), so no single task holds them
    all, however long the stream.
    """
    per = (df.where(F.col(ts).isNotNull())
           .groupBy(batch_start(ts, batch_s).alias("batch_start"))
           .agg(F.count(F.lit(1)).alias("_n"),
                F.sum(utf16_length(text)).alias("_c"),
                F.max(utf16_length(text)).alias("_m"))
           .withColumn("_bus", to_micros("batch_start")))
    run = keyed_running(per, [], "_bus", {"n_posts": ("sum", "_n"), "total_chars": ("sum", "_c"),
                                          "max_len": ("max", "_m")}, 86_400 * US)
    out = run.select("batch_start", *[F.col(c).cast("bigint").alias(c)
                                      for c in ("n_posts", "total_chars", "max_len")])
    return (out.withColumn("avg_len", F.expr("total_chars div n_posts"))
            .withColumn("avg_len_exact", F.col("total_chars") / F.col("n_posts")))


def first_per_batch(df: DataFrame, ts: str, batch_s: int, n: int, order_cols) -> DataFrame:
    """The first ``n`` rows of every batch in arrival order (``print()``)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    b = df.withColumn("batch_start", batch_start(ts, batch_s))
    w = Window.partitionBy("batch_start").orderBy(*order_cols)
    return b.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
