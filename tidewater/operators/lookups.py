"""Keyed lookups against a dimension table, with a default.

No join here is hinted: Spark broadcasts a dimension by its measured bytes
(``spark.sql.autoBroadcastJoinThreshold``, again at run time under AQE) and
shuffles it otherwise. A dimension is a map: of several rows of a key the
one with the smallest value counts (nulls last), so a lookup never
multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str,
                        default, out: str | None = None) -> DataFrame:
    """``Try(map(k)) getOrElse default`` at table scale: a left join on the
    key; keys missing from ``dim`` get ``default``."""
    d = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.min(value).alias("_v"))
    j = df.join(d, df[key] == d["_k"], "left")
    return j.withColumn(out or value, F.coalesce(F.col("_v"), F.lit(default))).drop("_k", "_v")


def key_present(df: DataFrame, dim: DataFrame, key: str, dim_key: str, present: bool = True) -> DataFrame:
    """Rows whose key is in ``dim`` (``present``) or is not (left anti)."""
    d = dim.select(F.col(dim_key).alias("_k"))
    return df.join(d, df[key] == d["_k"], "left_semi" if present else "left_anti")
