"""Nearest-centroid classification of embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askquarry.functions.arrays import evaluate_once
from askquarry.functions.vectors import SCORE_DIGITS, dot, norm

MAX_CLASSES = 1_000


def class_centroids(df: DataFrame, label: str, values: str) -> DataFrame:
    """Mean vector per class; the mean is partly summed before the shuffle."""
    vector = array_to_vector(F.col(values).cast("array<double>"))
    return df.filter(F.col(values).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        vector_to_array(Summarizer.mean(vector)).alias("centroid")
    )


def nearest_class(df: DataFrame, centroids: DataFrame, values: str, out: str = "predicted") -> DataFrame:
    """Add the label of the centroid with the highest cosine, the lowest label on a tie.

    The centroids reach the rows as one subquery value: a single row holding
    one unit vector per class, of which there are at most ``MAX_CLASSES``. A zero
    or missing vector has no class.
    """
    few = F.assert_true(F.count(F.lit(1)) <= MAX_CLASSES, F.lit(f"more than {MAX_CLASSES} classes"))
    length = norm(F.col("centroid"))
    unit = evaluate_once(length, lambda n: F.transform("centroid", lambda x: x / n))
    classes = (
        centroids.filter(length > 0)
        .limit(MAX_CLASSES + 1)
        .select("label", unit.alias("unit"))
        .agg(F.sort_array(F.collect_list(F.struct("label", "unit"))).alias("all"), few.alias("checked"))
        .select(F.when(F.col("checked").isNull(), F.col("all")).alias("all"))
    )
    return df.withColumn("_classes", classes.scalar()).withColumn(out, _closest(F.col(values))).drop("_classes")


def _closest(vector: Column) -> Column:
    def scored(length: Column) -> Column:
        cosine = lambda c: F.round(dot(vector, c["unit"]) / length, SCORE_DIGITS)
        return F.transform("_classes", lambda c: F.struct(cosine(c).alias("score"), c["label"].alias("label")))

    def first_best(scores: Column) -> Column:
        top = F.array_max(F.transform(scores, lambda s: s["score"]))
        return F.get(F.filter(scores, lambda s: s["score"] == top), F.lit(0))["label"]

    return evaluate_once(evaluate_once(F.nullif(norm(vector), F.lit(0.0)), scored), first_best)
