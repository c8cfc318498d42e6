"""A training corpus from ``documents``: low-quality texts go, then exact and
near copies, the sources are mixed to their target weights, and the mix is
packed into sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. ``run`` writes each stage's rows as Parquet below the session's shared
folder and reads them again as the next one's documents.

Rows that leave: texts scored under the threshold; of equal texts all but the
row of the largest id; of texts linked by shingles all but the smallest id;
documents that the mix takes no copy of. Documents that the mix takes twice
are two rows. The last stage returns a row per piece of a document, with its
token ids (unsigned, little-endian, 32 bits each), its sequence and its place.

Defined results, as in the operators: a null text is an empty one, scored,
deduplicated and (of no words) not taken by the mix; null ids rank last and
are no link; a null source is a source; rows equal in id and text are copies
of each other; an empty table gives no rows. Stages keep all columns of their
input, also ones named like their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import exact_dedup, jaccard_join, mixing, packing, quality
from tidewater.llm.common import dropping_shuffles, table
from tidewater.session import fresh_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality classifier", good_documents), ("exact dedup", without_copies),
          ("n-gram Jaccard join", without_near_copies), ("mixing to target weights", mixed),
          ("best-fit packing", sequences)]

#: The classifier, the components and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = fresh_dir(spark, "corpus-pipeline")
        rows = stage(spark, docs, sf_dir)
        with dropping_shuffles(spark):
            rows.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
