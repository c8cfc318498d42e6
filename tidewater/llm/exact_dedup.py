"""Exact duplicates by digest, with the frequent digests split off.

1. Each text is read once: its digest (SHA-256 of the text with A-Z lower-cased,
   null as empty) is written with the row's id to a table of digests.
2. Each partition of that table keeps a Misra-Gries summary of ``counters``
   digests. The summaries are added up; a digest of more than
   ``2 * rows / (counters + 1)`` rows is certain to pass the threshold
   ``rows / (counters + 1)``, and at most ``counters`` digests can pass it.
3. Those candidates (at most ``counters`` rows, so they may be broadcast) are
   verified by an exact count; count and winner are attached map-side, so the
   rows of a frequent digest are never shuffled.
4. All other digests go through an ordinary pre-aggregated shuffle and a join.

Defined results: a null text equals an empty one. Of equal texts the row with
the largest doc_id stays (null ids rank lowest); of rows equal in id and text
one stays. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import as_rows, ascii_lower, own_columns, saved

COUNTERS = 1024


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest) of every row; ``row`` is unique within the table
    once it is written."""
    text = ascii_lower(F.coalesce(F.col("t"), F.lit("")))
    return (own_columns(docs, id_col, text_col).toDF("doc_id", "t")
            .select("doc_id", F.monotonically_increasing_id().alias("row"),
                    F.unhex(F.sha2(text, 256)).alias("digest")))


def misra_gries(counters: int):
    """Per partition: at most ``counters`` digests with their lower bounds."""
    def summarise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, int] = {}
        for part in parts:
            # a batch's own counts enter at once, which only tightens the bounds
            for digest, n in part["digest"].value_counts().items():
                held[digest] = held.get(digest, 0) + int(n)
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {d: n - cut for d, n in held.items() if n > cut}
        yield pd.DataFrame({"digest": list(held), "low": list(held.values())},
                           columns=["digest", "low"])
    return summarise


def frequent(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified (digest, group_size, winner) of the frequent digests; at most
    ``counters`` rows."""
    total = keys.count()
    low = keys.select("digest").mapInPandas(misra_gries(counters), "digest binary, low long")
    named = (low.groupBy("digest").agg(F.sum("low").alias("low"))
             .filter(F.col("low") > total / (counters + 1)).select("digest"))
    return grouped(keys.join(F.broadcast(named), "digest", "left_semi"))


def grouped(keys: DataFrame) -> DataFrame:
    return keys.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("winner"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest."""
    keys = saved(digests(docs, id_col, text_col), "digests")
    heavy = saved(frequent(keys, counters).repartition(1), "frequent")
    light = keys.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    decided = (keys.join(F.broadcast(heavy), "digest")
               .unionByName(light.join(grouped(light), "digest")))
    return decided.select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), "digest")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows of a
    frequent digest go map-side, by its broadcast winner; the others meet
    their digest's winner in one shuffle. Where a winner's id and text have
    several rows, one of them stays: the first by its text as written."""
    keys = saved(digests(docs, id_col, text_col), "digests")
    alike = keys.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    winners = saved(alike.groupBy("digest").agg(F.max(F.struct("doc_id", "rows")).alias("winner")), "winners")
    hot = saved(frequent(keys, counters).select("digest").repartition(1), "frequent")  # at most ``counters`` rows
    hot = F.broadcast(hot)
    text = F.col(f"`{text_col}`")
    keyed = as_rows(docs, id=F.col(f"`{id_col}`"), t=text, digest=F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)))
    decided = (keyed.join(F.broadcast(winners.join(hot, "digest", "left_semi")), "digest")
               .unionByName(keyed.join(hot, "digest", "left_anti").join(winners.join(hot, "digest", "left_anti"), "digest"))
               .filter(F.col("id").eqNullSafe(F.col("winner.doc_id"))))
    one = decided.filter("winner.rows = 1")
    if not winners.filter("winner.rows > 1").isEmpty():
        twin = F.row_number().over(Window.partitionBy("digest").orderBy("t"))
        one = one.unionByName(decided.filter("winner.rows > 1").withColumn("twin", twin).filter("twin = 1").drop("twin"))
    return one.select("_doc.*")
