"""Parsing of vector and labelled-point text lines into columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two labelled-point text shapes, "(label,[a,b,...])"
# and "label,a b ...", and the dense vector shape "[a,b,...]".
VECTOR_SHAPE = r"^\[([^\[\]]*)\]$"
LABELED_SHAPE = r"^\(([^,()]*),\[([^\[\]]*)\]\)$"
LABELED_CSV_SHAPE = r"^([^,]*),(.*)$"


def _doubles(text: Column, sep: str) -> Column:
    parts = F.split(text, sep)
    vals = F.transform(parts, lambda x: F.trim(x).try_cast("double"))
    # a vector with any unreadable element is unreadable as a whole
    return F.when(F.exists(vals, lambda v: v.isNull()), F.lit(None)).otherwise(vals)


def parse_vector(s: Column | str) -> Column:
    """``[a,b,...]`` -> ``array<double>``; null when malformed (blanks and a
    trailing CR are ignored)."""
    s = F.col(s) if isinstance(s, str) else s
    t = F.regexp_replace(s, r"\s+", "")
    return F.when(t.rlike(VECTOR_SHAPE), _doubles(F.regexp_extract(t, VECTOR_SHAPE, 1), ",")) \
        .otherwise(F.lit(None).cast("array<double>"))


def parse_labeled(s: Column | str) -> Column:
    """``(label,[a,b])`` or ``label,a b`` -> ``struct<label double,
    features array<double>>``; null fields when malformed."""
    s = F.col(s) if isinstance(s, str) else s
    t = F.regexp_replace(s, r"\s+", "")
    csv = F.regexp_replace(F.trim(F.regexp_replace(s, r"[\r\n]", "")), r" +", " ")
    is_tuple = t.rlike(LABELED_SHAPE)
    label = F.when(is_tuple, F.regexp_extract(t, LABELED_SHAPE, 1)) \
        .otherwise(F.regexp_extract(csv, LABELED_CSV_SHAPE, 1))
    feats = F.when(is_tuple, _doubles(F.regexp_extract(t, LABELED_SHAPE, 2), ",")) \
        .when(csv.rlike(LABELED_CSV_SHAPE), _doubles(F.trim(F.regexp_extract(csv, LABELED_CSV_SHAPE, 2)), " "))
    return F.struct(F.trim(label).try_cast("double").alias("label"), feats.alias("features"))
