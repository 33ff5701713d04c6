"""Chunk rows to vector records, their payload, and comparisons of table states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vector record layout and the payload keys.
SPARSE_VALUES = T.StructType(
    [
        T.StructField("indices", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("values", T.ArrayType(T.FloatType(), False), False),
    ]
)
VECTOR_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("values", T.ArrayType(T.FloatType())),
        T.StructField("namespace", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("sparse_values", SPARSE_VALUES),
    ]
)
PAYLOAD = "content string, url string, id string"


def payload_json(content: Column, url: Column, id: Column) -> Column:
    """The text a match must give back, as JSON; null fields are left out."""
    return F.to_json(F.struct(content.alias("content"), url.alias("url"), id.cast("string").alias("id")))


def read_payload(metadata: Column) -> Column:
    """The payload as a struct; a malformed one gives nulls."""
    return F.from_json(metadata, PAYLOAD)


def original_doc_json(content: Column) -> Column:
    return F.to_json(F.struct(content.alias("original_doc")))


def vector_records(chunks: DataFrame, namespace: str | Column) -> DataFrame:
    """Shape ``(id, url, content, embedding)`` rows as vector records.

    Model name and dimension stay in the metadata of the vector column.
    """
    space = F.lit(namespace) if isinstance(namespace, str) else namespace
    model = chunks.schema["embedding"].metadata or {}
    shaped = chunks.select(
        F.col("id").cast("string").alias("id"),
        F.col("embedding").cast("array<float>").alias("values"),
        space.alias("namespace"),
        payload_json(F.col("content"), F.col("url"), F.col("id")).alias("metadata"),
        F.lit(None).cast(SPARSE_VALUES).alias("sparse_values"),
    ).to(VECTOR_RECORD)
    return shaped.withColumn("values", F.col("values").alias("values", metadata=model))


def embedding_sizes(df: DataFrame, values: str = "values") -> DataFrame:
    """Number of vectors per length; more than one row means a mixed table."""
    size = F.when(F.col(values).isNotNull(), F.size(values)).cast("bigint")
    return df.groupBy(size.alias("dim")).agg(F.count(F.lit(1)).alias("n_vectors"))


def wrong_size(df: DataFrame, dim: int, values: str = "values") -> DataFrame:
    """The rows whose vector is missing or has not ``dim`` entries."""
    return df.filter(F.col(values).isNull() | (F.size(values) != dim))


def changes(before: DataFrame, after: DataFrame, id: str = "id", content: str = "content") -> DataFrame:
    """Difference of two snapshots with unique ids: ``(id, change)`` of insert, update or delete.

    Only ids and content hashes are shuffled.
    """
    old = before.select(F.col(id).alias(id), F.md5(content).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(F.col(id).alias(id), F.md5(content).alias("_new"), F.lit(True).alias("_is"))
    change = (
        F.when(F.col("_was").isNull(), "insert")
        .when(F.col("_is").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return old.join(new, id, "full_outer").select(id, change.alias("change")).filter("change is not null")


def latest_versions(names: DataFrame, versions: DataFrame, name: str, version: str, *carried: str) -> DataFrame:
    """Numerically highest version of each name, never below 1, and what it carries.

    Partial aggregation runs before the shuffle, so a name with very many
    versions still sends one row per task.
    """
    number = F.col(version).cast("bigint")
    newest = versions.groupBy(name).agg(
        F.max(number).alias("_top"), *[F.max_by(c, number).alias(c) for c in carried]
    )
    top = F.greatest(F.lit(1).cast("bigint"), F.coalesce("_top", F.lit(1).cast("bigint")))
    return names.select(name).distinct().join(newest, name, "left").select(
        name, top.alias("latest_version"), *carried
    )
