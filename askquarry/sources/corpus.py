"""Document sources: tables, optional second tables, and folders of raw files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of Spark's binary file source.
RAW_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def documents(df: DataFrame, url: Column | str, content: Column | str) -> DataFrame:
    """Name the two columns every corpus has."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(as_col(url).alias("url"), as_col(content).alias("content"))


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table or view, or none where it does not exist."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def merge_corpora(sources: Iterable[DataFrame | None]) -> DataFrame:
    """Append the corpora that exist, matched by column name."""
    there = [df for df in sources if df is not None]
    if not there:
        raise ValueError("no corpus given")
    merged = there[0]
    for df in there[1:]:
        merged = merged.unionByName(df)
    return merged


def raw_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """One row per file with its bytes; the bytes are read only where ``content`` is used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Path and size of each file."""
    return raw_files(spark, folder, glob).select("path", "length")


def url_like(df: DataFrame, pattern: str, n: int, order: str = "id", url: str = "url") -> DataFrame:
    """The first ``n`` rows, by ``order``, whose url matches a LIKE pattern."""
    return df.filter(F.col(url).like(pattern)).orderBy(order).limit(n)
