"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import functools
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="askquarry-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local master may do without one."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root and not _one_machine(spark):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return (root or _local_root()).rstrip("/")


def _one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage out as parquet and read it back.

    Cuts the lineage in a way that survives lost executors, and keeps paid
    model calls from being repeated when two branches read the same stage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    with_metadata = {f.name: f.metadata for f in df.schema.fields if f.metadata}
    return written.withColumns({n: F.col(n).alias(n, metadata=m) for n, m in with_metadata.items()})


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input came as fewer splits than there are cores.

    Meant for plain scans of few files ahead of CPU-heavy steps. A large
    table already has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application."""
    _ship(spark.sparkContext.applicationId, spark)


@functools.cache
def _ship(application: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="askquarry-zip-")) / package.name
    spark.sparkContext.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
