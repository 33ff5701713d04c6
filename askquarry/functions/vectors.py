"""Vector expressions on ``array<float>`` columns; sums run in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are compared and shown at this many decimals, so that equal vectors
# tie whatever the order of their sums and the lower id then wins.
SCORE_DIGITS = 9

METRICS = ["cosine", "dot", "l2"]


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(as_doubles(a), lambda x: x * x)))


def closest_first(score_col: Column, metric: str = "cosine") -> Column:
    """Sort key that puts the best match first and undefined scores last."""
    return score_col.asc_nulls_last() if metric == "l2" else score_col.desc_nulls_last()
