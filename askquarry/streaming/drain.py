"""Streams that take in everything that is there, then stop.

Each source-to-table pair has its own checkpoint below one root, so several
sources can feed one table and each continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from askquarry.operators.vector_table import Load, VectorTable
from askquarry.sources.corpus import RAW_FILE, merge_corpora


def checkpoint_path(root: str, source: str, target: str) -> str:
    """The one place checkpoint folders get their name."""
    return f"{root.rstrip('/')}/checkpoints/{source}_to_{target}"


def source_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/table/source={source}"


def stream_files(
    spark: SparkSession, folder: str, glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """One row per new file. A file overwritten under its name is not seen again."""
    reader = spark.readStream.format("binaryFile").schema(RAW_FILE).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New rows of a parquet table, as files are added to it."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def schema_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/schemas/source={source}"


def drain(stream: DataFrame, root: str, source: str) -> None:
    """Append all that is available to the source's folder of a table, exactly once, and stop.

    The folder's own log names the files of finished batches and Spark reads by
    it, so a batch cut short by a failure leaves no rows behind. The log counts the
    batches of one stream; hence a folder and a checkpoint per source. The stream's schema is
    kept beside it, so a source without rows is an empty table.
    """
    stream.sparkSession.createDataFrame([], stream.schema).write.mode("overwrite").parquet(schema_path(root, source))
    _finish(
        stream.writeStream.format("parquet")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint_path(root, source, "table"))
        .start(source_path(root, source))
    )


def drained(spark: SparkSession, root: str, *sources: str) -> DataFrame:
    """The table all named sources were drained into."""

    def landed(source: str) -> DataFrame:
        schema = spark.read.parquet(schema_path(root, source)).schema
        path = spark._jvm.org.apache.hadoop.fs.Path(source_path(root, source))
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(source_path(root, source))

    return merge_corpora(landed(s) for s in sources)


def drain_to_vectors(
    stream: DataFrame,
    table: VectorTable,
    checkpoint: str,
    to_records: Callable[[DataFrame], DataFrame],
    compact_share: float | None = 1.0,
) -> None:
    """Turn each batch into vector records and load it as the batch of this checkpoint.

    The checkpoint's path is the writer's name, so streams share a table without arrangement, and a batch
    run again after a failure replaces its own load only. Loads and deletes by others keep their
    order with it. Afterwards the table is compacted once later loads outgrow ``compact_share`` times its base; None leaves it.
    """

    def load(batch: DataFrame, number: int) -> None:
        table.upsert(to_records(batch), Load(checkpoint, number))

    _finish(
        stream.writeStream.foreachBatch(load)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    if compact_share is not None:
        table.tidy(compact_share)


def _finish(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()
