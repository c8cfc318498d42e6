"""Input tables and the views derived from them.

The driver's tables are parquet files; the inputs the reference works on
(access-log lines, short texts, numeric points) are derived from them with
column expressions, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
START_NTZ = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``text``: one row per line of the text files at ``path``."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def _s(c):
    return F.col(c).cast("string")


def _log_line(ts, status_first=None):
    """Access-log line made from an ``events`` row (see FIXTURES.md)."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ip = (F.when(eid % 61 == 0, F.lit(""))
          .otherwise(F.concat(F.lit("10.0."), F.expr("user_id div 256").cast("string"),
                              F.lit("."), (uid % 256).cast("string"))))
    request = (F.when(eid % 53 == 0, F.lit("-"))
               .when(et.isin("click", "error"),
                     F.concat(F.lit("GET /item/"), (eid % 20).cast("string"), F.lit(" HTTP/1.1")))
               .when(et == "view",
                     F.concat(F.lit("GET /page/"), (eid % 50).cast("string"), F.lit(" HTTP/1.1")))
               .when(et == "purchase", F.lit("POST /cart HTTP/1.1"))
               .otherwise(F.lit("POST /signup HTTP/1.1")))
    status = F.when(et == "error", F.lit("500"))
    if status_first is not None:
        status = F.when(status_first, F.lit("500")).when(et == "error", F.lit("500"))
    status = (status.when(et == "signup", F.lit("302"))
              .when((et == "click") & (eid % 10 == 0), F.lit("404"))
              .otherwise(F.lit("200")))
    body = F.concat(
        ip, F.lit(" - u"), uid.cast("string"),
        F.lit(" ["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'),
        request, F.lit('" '), status, F.lit(" "),
        F.floor(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit(' "-" "agent-'), (eid % 7).cast("string"), F.lit('"'))
    return (F.when(eid % 97 == 0, F.concat(F.lit("garbage line "), eid.cast("string")))
            .otherwise(body))


def weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weblog(event_id, ts, line)``: one access-log line per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", _log_line(F.col("ts")).alias("line"))


def weblog_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``weblog`` with one row per second and bursts of 500s."""
    ev = table(spark, sf_dir, "events")
    ts = F.expr(f"timestampadd(SECOND, event_id, {START_NTZ})")
    ev = ev.withColumn("ts", ts)
    return ev.select("event_id", "ts",
                     _log_line(F.col("ts"), status_first=(F.col("event_id") % 2000 < 400)).alias("line"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``posts(post_id, ts, text)``: short texts with two hashtags each."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("post_id"),
                    F.expr(f"timestampadd(SECOND, doc_id * 37, {START_NTZ})").alias("ts"),
                    F.concat("text", F.lit(" #"), "lang", F.lit(" #"), "source").alias("text"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``points(id, x, y)`` for regression; y is about -0.995 x."""
    ev = table(spark, sf_dir, "events")
    x = (F.col("value") - 50.0) / 50.0
    noise = (F.col("event_id") % 7 - 3) / 100.0
    return ev.select(F.col("event_id").alias("id"), F.round(x, 6).alias("x"),
                     F.round(F.lit(-0.995) * x + noise, 6).alias("y"))


# Fixed values of the k-means fixture: base income and age per label 0..4.
BLOB_INCOME = (16e4, 54e3, 113e3, 192e3, 56e3)
BLOB_AGE = (2e1, 5e1, 64e0, 59e0, 34e0)


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blobs(id, label, income, age)``: five clusters for k-means."""
    ev = table(spark, sf_dir, "events")
    lab = F.col("event_id") % 5

    def pick(values):
        e = F.when(lab == 0, F.lit(values[0]))
        for i, v in enumerate(values[1:], start=1):
            e = e.when(lab == i, F.lit(v))
        return e

    income = pick(BLOB_INCOME) + ((F.col("event_id") * 7919) % 1001 - 500) * 5e1
    age = pick(BLOB_AGE) + (F.col("event_id") * 31) % 9 - 4
    return ev.select(F.col("event_id").alias("id"), lab.cast("int").alias("label"),
                     income.cast("double").alias("income"), age.cast("double").alias("age"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_items(l_orderkey, q)``: sorted quantities per order."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_list(F.col("l_quantity").cast("int"))).alias("q")))


def nation_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 2)
