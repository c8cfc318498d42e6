"""Filter interaction audit on failing-id relations.

1. One scan of the texts writes a row number, the part, the conditions A to D
   and a digest of the text. Condition E (a smaller id has the same text)
   comes from the smallest id of every digest: digests with many rows are
   fewer than ``HOT_SHARE`` and are broadcast, the rest is
   joined by digest.
2. One id table per filter holds the numbers of its failing rows; another
   holds the rows that fail any filter, with their part and labels. All are
   bucketed by the number, so no join below shuffles.
3. What a prefix of filters leaves depends on the set of its letters only:
   the survivors of each of the 32 sets are the failing rows after left-anti
   joins with the set's id tables, counted per part and label. Left-semi
   joins count each filter's failing rows. Rows that fail nothing survive
   every prefix and are counted once.
4. A step's removals and label losses are the counts before it less those
   after it, its redundant rows the filter's failing rows less its removals,
   the rows that fail only this filter its removals after all others. Every
   part spreads its 32 counts over the 600 (order, step) pairs.

Defined results: a null text is empty (fails A, not B, C or D; E if a smaller
id's text is empty too). A null source is the part ''. Conditions are judged
on whole texts. A null id is smaller than none and none is smaller than it.
Rows of one id with one text do not fail E by each other; all rows count. A
row is good (toxic) if any label of its id says so; labels without a table row
do nothing. An empty table has no parts and gives no rows. Other columns of
the tables are not looked at.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import Scratch, own_columns, partitions_for, saved

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"
HOT_SHARE = 1024       # a digest with more than 1/1024 of all rows is hot
BUCKET_ROWS = 250_000  # failing rows of a bucket
COUNTS = ("n", "good", "toxic")


def conditions(text: Column) -> dict[str, Column]:
    """Failure of A to D for a text that is not null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            "C": 100 * capitals > CAPITALS_PERCENT * F.length(text),
            "D": text.rlike(SYMBOLS)}


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(row, id, part, digest, A, B, C, D) of every row; the numbers hold for
    one reading, so write it."""
    rows = own_columns(docs, id_col, text_col, part_col).toDF("id", "text", "part")
    text = F.coalesce("text", F.lit(""))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", F.coalesce("part", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), *[c.alias(f) for f, c in conditions(text).items()])


def later_copies(rows: DataFrame, n_rows: int, keep: Scratch) -> DataFrame:
    """(row) of the rows with a text that a smaller id has."""
    firsts = (rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1").withColumn("hot", F.col("copies") * HOT_SHARE > n_rows))
    firsts = keep.save(firsts)
    hot = F.broadcast(firsts.filter("hot"))  # fewer than HOT_SHARE rows, as each has more than 1/HOT_SHARE of all
    own = rows.select("row", "id", "digest")
    few = own.join(hot, "digest", "left_anti").join(firsts.filter("not hot"), "digest")
    return own.join(hot, "digest").unionByName(few).filter("id > first").select("row")


class _Relations(Scratch):
    """Id tables bucketed by the row number, and other tables of a run."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark, "audit")
        self.tables: list[str] = []

    def relation(self, df: DataFrame, buckets: int) -> str:
        """Name of a new id table with the rows of ``df``."""
        name = f"audit_{uuid.uuid4().hex}"
        (df.repartition(buckets, "row").write.bucketBy(buckets, "row").sortBy("row").format("parquet")
         .option("path", self.fresh()).saveAsTable(name))
        self.tables.append(name)
        return name

    def __exit__(self, *why) -> None:
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
        super().__exit__(*why)


def _mask(letters: str) -> int:
    return sum(1 << FILTERS.index(f) for f in letters)


SETS = ["".join(f for i, f in enumerate(FILTERS) if m >> i & 1) for m in range(1 << len(FILTERS))]
CLEAN, FAILING = -1, len(SETS)  # numbers of the counts that are not a set's survivors


def survivor_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    part_col: str = "source") -> DataFrame:
    """Per part: ``kept`` (the counts n, good and toxic of the survivors of
    each of the 32 sets, in order of the set's mask) and ``failing`` (the
    number of failing rows of each filter)."""
    spark = docs.sparkSession
    known = own_columns(labels, id_col, "quality", "toxic").toDF("id", "quality", "toxic_label")
    known = known.filter("id is not null").groupBy("id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic_label") == 1), F.lit(False)).alias("toxic"))
    with _Relations(spark) as keep:
        rows = keep.save(judged(docs, id_col, text_col, part_col))
        n_rows = rows.count()
        buckets = partitions_for(n_rows, BUCKET_ROWS)
        every = keep.relation(rows.select("row", "id", "part").join(known, "id", "left").select(
            "row", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")), buckets)
        fails = {f: keep.relation(rows.filter(f).select("row"), buckets) for f in "ABCD"}
        fails["E"] = keep.relation(later_copies(rows, n_rows, keep), buckets)
        touched = keep.relation(spark.table(every).join(
            reduce(DataFrame.unionByName, [spark.table(t) for t in fails.values()]).distinct(), "row", "left_semi"), buckets)

        def counted(no: int, source: str, *joins: str) -> str:
            return f"select part, {no} as `set`, good, toxic from {source} " + " ".join(joins)
        steps = [counted(CLEAN, every, f"left anti join {touched} using (row)")]
        steps += [counted(m, touched, *[f"left anti join {fails[f]} using (row)" for f in letters]) for m, letters in enumerate(SETS)]
        steps += [counted(FAILING + i, touched, f"left semi join {fails[f]} using (row)") for i, f in enumerate(FILTERS)]
        counts = saved(spark.sql("select part, `set`, count(*) as n, count_if(good) as good, count_if(toxic) as toxic from ("
                                 + " union all ".join(steps) + ") group by part, `set`"), "audit-counts")
    held = F.map_from_entries(F.collect_list(F.struct("set", F.struct(*COUNTS))))  # at most 38 rows a part
    zeros = "named_struct(" + ", ".join(f"'{c}', 0L" for c in COUNTS) + ")"
    both = "named_struct(" + ", ".join(f"'{c}', coalesce(held[s], {zeros}).{c} + coalesce(held[{CLEAN}], {zeros}).{c}" for c in COUNTS) + ")"
    return counts.groupBy("part").agg(held.alias("held")).selectExpr(
        "part", f"transform(sequence(0, {FAILING - 1}), s -> {both}) as kept",
        f"transform(sequence({FAILING}, {FAILING + len(FILTERS) - 1}), s -> coalesce(held[s], {zeros}).n) as failing")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """A row per part, order of the filters and step."""
    per_part = survivor_counts(docs, labels, id_col, text_col, part_col)
    steps = [("".join(o), i + 1, _mask("".join(o[:i])), _mask("".join(o[:i + 1])), FILTERS.index(o[i]))
             for o in permutations(FILTERS) for i in range(len(FILTERS))]
    grid = F.from_json(F.lit("[" + ",".join('{"o":"%s","s":%d,"b":%d,"a":%d,"f":%d}' % x for x in steps) + "]"),
                       "array<struct<o string, s int, b int, a int, f int>>")
    full = len(SETS) - 1

    def removed(before: int, after: int) -> str:
        return f"(kept[{before}].n - kept[{after}].n)"

    def shapley(f: str) -> str:
        # a set of k letters stands before a filter in k! (4 - k)! of the orders
        return " + ".join(f"{factorial(len(s)) * factorial(len(FILTERS) - 1 - len(s))} * {removed(_mask(s), _mask(s + f))}"
                          for s in SETS if f not in s)
    unique = [removed(full & ~_mask(f), full) for f in FILTERS]
    d = (per_part.selectExpr("*", f"array({', '.join(map(shapley, FILTERS))}) as shap", f"array({', '.join(unique)}) as uniq")
         .withColumn("x", F.explode(grid))
         .select("part", "x.*", "failing", "shap", "uniq", F.col("kept")[F.col("x.b")].alias("was"), F.col("kept")[F.col("x.a")].alias("now")))
    gone = {c: F.col("was")[c] - F.col("now")[c] for c in COUNTS}
    return d.select("part", F.col("o").alias("filter_order"), F.col("s").alias("step"), F.col("now.n").alias("kept"),
                    gone["n"].alias("removed"), (F.col("failing")[F.col("f")] - gone["n"]).alias("redundant"),
                    F.col("uniq")[F.col("f")].alias("unique_fails"), gone["good"].alias("good_lost"),
                    gone["toxic"].alias("toxic_lost"), F.col("shap")[F.col("f")].cast("long").alias("shapley"))
