"""Built-in hashed bag-of-words embedding, so everything runs without a model."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askquarry.functions.text import words

DEFAULT_DIM = 64


def model_name(dim: int) -> str:
    return f"md5-words-{dim}"


def word_bucket(word: Column, dim: int) -> Column:
    """Bucket of one word: the first 32 bits of its md5, modulo the dimension."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % dim


def hash_embed(df: DataFrame, text: str, out: str = "embedding", dim: int = DEFAULT_DIM) -> DataFrame:
    """Add a unit-length ``array<float>`` of word counts per bucket.

    Runs in the JVM and inside the row: no shuffle, no Python. A text
    without words gives a zero vector, which search leaves out. The model name
    and the dimension travel in the column metadata (see ``search.check_model``).
    """
    buckets, counts, unit = "_buckets", "_counts", "_unit"
    count_model = CountVectorizerModel.from_vocabulary(
        [str(b) for b in range(dim)], inputCol=buckets, outputCol=counts
    )
    terms = F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: word_bucket(w, dim).cast("string"))
    counted = count_model.transform(df.withColumn(buckets, terms))
    normalised = Normalizer(p=2.0, inputCol=counts, outputCol=unit).transform(counted)
    vector = vector_to_array(F.col(unit)).cast("array<float>")
    return normalised.withColumn(
        out, vector.alias(out, metadata={"model": model_name(dim), "dim": dim})
    ).drop(buckets, counts, unit)
