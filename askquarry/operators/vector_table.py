"""A table of vector records that takes repeated loads from several writers.

A load is one folder of parquet below ``data``, partitioned by namespace and sorted by id, with Bloom filters on the
id. It counts once a file in ``log`` names it. Log files are numbered without gaps and a number is taken
once only, so all loads of all writers have one order, and a job that dies before its log file leaves nothing to read. A
load is known by its writer and the writer's own batch number: the same pair again, as in a retried stream batch, replaces that load
in its place. Reading gives, for each ``(namespace, id)``, the row of the newest load.

The log also says which model the vectors are from, and loads of another model are refused.
The file system has to refuse renaming onto an existing file, as HDFS and local ones do.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askquarry.functions.arrays import evaluate_once
from askquarry.operators.records import VECTOR_RECORD
from askquarry.operators.search import ModelMismatch

KEY = ["namespace", "id"]
STORED = T.StructType([*VECTOR_RECORD.fields, T.StructField("deleted", T.BooleanType())])
#: Keys of later loads that are broadcast to the base; more meet it in a shuffle of keys.
BROADCAST_KEYS = 500_000
#: Bytes of a row group; a lookup reads the groups whose Bloom filter may hold the id.
ROW_GROUP = 16 * 1024 * 1024
LOG = "version long, folder string, writer string, batch long, rows long, upserts boolean, upto long, ledger map<string,long>, model string, dim int"


class Load(NamedTuple):
    """Whose load it is, and the writer's own number for it."""

    writer: str
    batch: int


class Commit(NamedTuple):
    version: int
    folder: str
    load: Load
    rows: int
    upserts: bool
    model: str | None
    dim: int | None


class VectorTable:
    def __init__(self, spark: SparkSession, root: str, value_metadata: dict | None = None):
        """``value_metadata`` (model, dim) describes loads whose vector column doesn't say it itself."""
        self.spark, self.root = spark, root.rstrip("/")
        self.value_metadata = value_metadata or {}

    # --- the log ------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs, fs.makeQualified(path)

    def _log(self) -> list[dict]:
        fs, folder = self._path("log")
        if not fs.exists(folder):
            return []
        rows = self.spark.read.schema(LOG).json(folder.toString()).collect()
        return sorted((r.asDict() for r in rows), key=lambda r: r["version"])

    def _bases_and_commits(self) -> tuple[dict | None, list[Commit]]:
        """The newest compaction, and the loads that count, oldest first; a compaction stands for all up to its own bound."""
        entries = self._log()
        base = max((e for e in entries if e["upto"] is not None), key=lambda e: (e["upto"], e["version"]), default=None)
        ledger = (base or {}).get("ledger") or {}
        found: dict[Load, Commit] = {}
        for e in [base, *entries] if base else entries:
            load = Load(e["writer"], e["batch"])
            if e is not base and (e["upto"] is not None or base and (e["version"] <= base["upto"] or e["batch"] <= ledger.get(e["writer"], -1))):
                continue
            # a load repeated stays where it was first
            version = found[load].version if load in found else e["version"]
            found[load] = Commit(version, e["folder"], load, e["rows"], e["upserts"], e["model"], e["dim"])
        return base, list(found.values())

    def commits(self) -> list[Commit]:
        """The loads that count, oldest first; the first is the base that later ones are compared with."""
        return self._bases_and_commits()[1]

    def loads(self) -> list[int]:
        """Their numbers in the log."""
        return [c.version for c in self.commits()]

    def _publish(self, entry: dict) -> int:
        """Write a log file under the next free number."""
        jvm = self.spark._jvm
        fs, folder = self._path("log")
        fs.mkdirs(folder)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        refuse = self.spark.sparkContext._gateway.new_array(rename, 1)
        refuse[0] = rename.NONE
        version = max((e["version"] for e in self._log()), default=-1) + 1
        while True:
            _, draft = self._path(f"log/_{uuid.uuid4().hex}")
            out = fs.create(draft)
            out.write(json.dumps(entry | {"version": version}).encode())
            out.close()
            try:
                context.rename(draft, self._path(f"log/{version:020d}.json")[1], refuse)
                return version
            except Py4JJavaError as taken:
                fs.delete(draft, False)
                if "FileAlreadyExistsException" not in str(taken.java_exception):
                    raise
                version += 1

    # --- loads --------------------------------------------------------------------

    def identity(self) -> dict:
        """Model and dimension of the stored vectors, as far as loads have said."""
        known = next((c for c in self.commits() if c.upserts), None)
        stored = {} if known is None else {"model": known.model, "dim": known.dim}
        return {**self.value_metadata, **{k: v for k, v in stored.items() if v is not None}}

    def _checked(self, records: DataFrame) -> tuple[str | None, int | None]:
        """Model and dimension of a load; they must be those of the table's others."""
        own = records.schema["values"].metadata or {}
        ours = {k: own.get(k, self.value_metadata.get(k)) for k in ("model", "dim")}
        for k, v in self.value_metadata.items():
            if k in own and own[k] != v:
                raise ModelMismatch(f"the load's {k} is {own[k]!r}, the table was opened for {v!r}")
        known = next((c for c in self.commits() if c.upserts), None)
        if known is not None and (known.model, known.dim) != (ours["model"], ours["dim"]):
            raise ModelMismatch(f"the load is of {ours['model']!r} with {ours['dim']!r} values, the table of {known.model!r} with {known.dim!r}")
        return ours["model"], ours["dim"]

    def upsert(self, records: DataFrame, load: Load | None = None, gather: bool = False) -> Load:
        """Add or replace records; ids must be unique within one load.

        Written as they come, sorted within tasks, without a shuffle. ``gather`` first brings each
        namespace together, for loads with many namespaces, which would else leave
        a file per task and namespace; large namespaces are split again. A vector that hasn't the stated
        dimension fails the load. ``load`` names the writer and its batch; without it the load is one of its own.
        """
        model, dim = self._checked(records)
        rows = records.select(*VECTOR_RECORD.names, F.lit(False).alias("deleted"))
        if dim is not None:
            wrong = F.raise_error(F.format_string(f"vector of %s has not {dim} values", "id")).cast("array<float>")
            # bound once, so that the embedding isn't computed for its size again
            fits = evaluate_once(F.col("values"), lambda v: F.when(v.isNull() | (F.size(v) == dim), v).otherwise(wrong))
            rows = rows.withColumn("values", fits)
        return self._write(rows.hint("rebalance", "namespace") if gather else rows, load, model=model, dim=dim, upserts=True)

    def delete(self, keys: DataFrame, load: Load | None = None) -> Load:
        """Remove the records with these ``(namespace, id)`` pairs, as far as earlier loads hold them."""
        gone = keys.select(
            *[
                F.col(f.name) if f.name in KEY else F.lit(None).cast(f.dataType).alias(f.name)
                for f in VECTOR_RECORD.fields
            ],
            F.lit(True).alias("deleted"),
        )
        return self._write(gone, load, model=None, dim=None, upserts=False)

    def _write(self, rows: DataFrame, load: Load | None, **entry) -> Load:
        load = load or Load(uuid.uuid4().hex, 0)
        folder = uuid.uuid4().hex
        writer = rows.sortWithinPartitions(*KEY).write.partitionBy("namespace")
        writer = writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.block.size", ROW_GROUP)
        writer.parquet(f"{self.root}/data/commit={folder}")
        # by the files' footers
        n = self._read([Commit(0, folder, load, 0, True, None, None)]).count()
        self._publish({"folder": folder, "writer": load.writer, "batch": load.batch, "rows": n, **entry})
        return load

    # --- reading ------------------------------------------------------------------

    def _read(self, commits: list[Commit]) -> DataFrame:
        """The rows of some loads, with their order as ``seq``."""
        if not commits:
            return self.spark.createDataFrame([], STORED).withColumn("seq", F.lit(0).cast("bigint"))
        schema = T.StructType([*STORED.fields, T.StructField("commit", T.StringType())])
        paths = [f"{self.root}/data/commit={c.folder}" for c in commits]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        order = F.create_map(*[F.lit(x) for c in commits for x in (c.folder, c.version)])
        return rows.withColumn("seq", order[F.col("commit")].cast("bigint")).drop("commit")

    def current(self, namespace: str | None = None) -> DataFrame:
        """The live records, of one namespace if given (other folders are not read).

        The oldest load is the base. Only keys of later loads are compared: their newest load for each key, broadcast
        while the log says that they are few, so neither the base nor later rows are shuffled. ``compact``
        keeps them few.
        """
        commits = self.commits()
        base, later = self._read(commits[:1]), self._read(commits[1:])
        if namespace is not None:
            base, later = (df.filter(F.col("namespace") == namespace) for df in (base, later))
        live = base
        if len(commits) > 1:
            newest = later.groupBy(*KEY).agg(F.max("seq").alias("top")).toDF("_namespace", "_id", "top")
            if sum(c.rows for c in commits[1:]) <= BROADCAST_KEYS:
                newest = F.broadcast(newest)
            same: Column = F.col("namespace").eqNullSafe(F.col("_namespace")) & (F.col("id") == F.col("_id"))
            kept = base.join(newest, same, "left_anti")
            live = kept.unionByName(later.join(newest, same & (F.col("seq") == F.col("top")), "left_semi"))
        live = live.filter(~F.col("deleted")).select(*VECTOR_RECORD.names)
        known = next((c for c in commits if c.upserts), None)
        said = {} if known is None else {"model": known.model, "dim": known.dim}
        metadata = {**self.value_metadata, **{k: v for k, v in said.items() if v is not None}}
        return live.withColumn("values", F.col("values").alias("values", metadata=metadata))

    # --- upkeep -------------------------------------------------------------------

    def compact(self, root: str | None = None) -> VectorTable:
        """Write the live records as one load, sorted by key over all files; in place, or as a fresh table at ``root``.

        In place, loads that end meanwhile stay on top. The ledger of what the new base holds goes into the log, so a
        batch repeated after it is left out.
        """
        rows = self.current().withColumn("deleted", F.lit(False)).repartitionByRange(*KEY)
        base, commits = self._bases_and_commits()
        known = next((c for c in commits if c.upserts), None)
        entry = {"model": known.model if known else None, "dim": known.dim if known else None, "upserts": known is not None}
        if root is not None:
            fresh = VectorTable(self.spark, root, self.value_metadata)
            fresh._write(rows, None, **entry)
            return fresh
        if not commits:
            return self
        ledger = dict((base or {}).get("ledger") or {})
        for c in commits:
            ledger[c.load.writer] = max(c.load.batch, ledger.get(c.load.writer, -1))
        upto = max(c.version for c in commits)
        self._write(rows, None, upto=upto, ledger=ledger, **entry)
        return self

    def tidy(self, share: float = 1.0) -> bool:
        """Compact in place once later loads hold more than ``share`` times the base's rows; true if it was done.

        At a share of one the table doubles between compactions, so a row is rewritten a logarithmic number of times.
        """
        commits = self.commits()
        due = sum(c.rows for c in commits[1:]) > share * (commits[0].rows if commits else 0)
        if due:
            self.compact()
        return due


def stale_keys(table: VectorTable, namespace: str, chunks: DataFrame) -> DataFrame:
    """Keys in the table that the newest chunking of the corpus no longer has.

    A document that shrank leaves higher chunk numbers behind; deleting these keys
    removes its stale text from search.
    """
    return table.current(namespace).select(*KEY).join(chunks.select("id"), "id", "left_anti").select(*KEY)
