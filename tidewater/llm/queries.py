"""The registered queries opN_<name> and the pipeline, each a thin form of
its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import ann, centroids, exact_dedup, filter_audit, jaccard_join, mixing, packing, quality, sanitise, secrets, shards, substring_dedup, warc
from tidewater.llm.common import Scratch, saved, table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clean = warc.archive_pages(table(spark, sf_dir, "pages"))
    out = warc.read_archive(spark, clean)
    # what a response holds is measured on the payload read back, by its parser
    return out.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(saved(pieces, "pieces"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = len(secrets.BASE_RULES)
    found = secrets.scan(table(spark, sf_dir, "documents"))
    own = F.filter("spans", lambda s: s["no"] < base)

    def count(no: int):
        return F.size(F.filter("spans", lambda s: s["no"] == no)).cast("long")
    return found.select("doc_id", *[count(n).alias(f"n_{r.kind}") for n, r in enumerate(secrets.BASE_RULES)],
                        F.sha2(secrets.listed(own), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "pii") as keep:
        found = sanitise.scan(table(spark, sf_dir, "documents"), keep)
        base = F.filter("spans", lambda s: s["kind"] < sanitise.TERM)

        def count(kind: int):
            return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
        return saved(found.select(
            F.col("id").alias("doc_id"), *[count(k).alias(f"n_{name}") for k, name in enumerate(sanitise.KINDS[:sanitise.TERM])],
            F.sha2(sanitise.listed(base), 256).alias("base_sha256"), sanitise.listed(F.col("spans")).alias("spans")), "pii-spans")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc_revisits, op2_jaccard_join, op3_best_fit_packing, op4_substring_dedup, op5_quality, op6_histogram_shards, op7_secret_scan, op8_exact_dedup, op9_tree_neighbours, op10_entropy_mix, op11_pii_sanitise, op12_filter_audit, op13_centroid_clusters)}
