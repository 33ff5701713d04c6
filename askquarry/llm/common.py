"""Helpers of the operators: text keys, stage tables, columns of outside tables."""

from __future__ import annotations

import gc
import time
import uuid
import weakref
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askquarry.session import scratch_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> list[Column]:
    """128 bits naming a text, as columns k1 and k2; equal texts have equal keys. Null counts as empty.

    Results that depend on the text alone are joined back by this key, so
    rows need no unique id and equal texts share one result.
    """
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text, F.length(text)).alias("k2")]


def row_place(docs: DataFrame) -> tuple[Column, Column] | None:
    """Columns naming a row by 128 bits of its file's path and its place there, and the place, if ``docs`` is a plain table
    of Parquet files: every read of the table finds the same names, however it is split. None for any other plan."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        meta = docs.metadataColumn("_metadata")
        path, at = meta["file_path"], meta["row_index"]
        docs.select(path, at)
    except AnalysisException:
        return None
    return F.concat_ws("-", F.md5(path), at.cast("string")), at


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, row, at): all columns of ``docs`` in a struct, the row's name, its place.

    A table of Parquet files is read where it lies; only rows of another plan are written out first.
    """
    rows, named = docs.select(F.struct("*").alias("doc")), row_place(docs)
    if named is not None:
        return docs.select(F.struct("*").alias("doc"), named[0].alias("row"), named[1].alias("at"))
    rows = Stages(docs.sparkSession, "documents").save(rows, "documents")
    row, at = row_place(rows)
    return rows.select("doc", row.alias("row"), at.alias("at"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Stages:
    """Tables between the jobs of one operator, in the shared folder.

    A stage written here is read back from files that every executor sees, so
    lost executors cost only their own tasks. ``drop`` deletes what later
    jobs no longer read, ``keep_only`` all but what the returned DataFrame reads.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark, self.root = spark, f"{scratch_root(spark)}/{operator}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
        self.there: set[str] = set()

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self.paths[saved] = path
        self.there.add(path)
        return saved

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def drop(self, *tables: DataFrame) -> None:
        """Delete the stages' files, and let Spark remove the shuffle files of finished jobs."""
        self._delete([self.paths[df] for df in tables])

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all stages but these."""
        self._delete(self.there - {self.paths[df] for df in tables})

    def _delete(self, paths: Iterable[str]) -> None:
        for name in list(paths):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.there.discard(name)
        self.release()

    def release(self) -> None:
        """Let Spark's cleaner find finished jobs' shuffles: the first round frees Python's handles, the second what they held."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)
