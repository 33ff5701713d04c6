"""Near duplicates of embeddings by Euclidean p-stable hashing (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.llm.common import Stages
from askquarry.llm.graph import components
from askquarry.llm.near_dup import _group_pairs
from askquarry.session import ship_package

#: Vectors of one block that are compared with another in a task.
BLOCK = 2048


@dataclass(frozen=True)
class Stable:
    """Parameters: a pair at the threshold shares a bucket of one table with probability 0.857 ** projections,
    so it is missed by all with probability 0.011; at 0.95 with 5e-6."""

    cosine: float = 0.9
    tables: int = 96
    projections: int = 20
    width: float = 2.5
    seed: int = 11


def bucket_ids(unit: np.ndarray, how: Stable) -> np.ndarray:
    """For each unit vector and table, 32 bits naming its cell of quantised random projections."""
    dims = unit.shape[1]
    rng = np.random.default_rng([how.seed, dims])
    lines = rng.standard_normal((dims, how.tables * how.projections))
    shift = rng.uniform(0, how.width, how.tables * how.projections)
    by = rng.integers(0, 1 << 62, how.projections, np.uint64) * np.uint64(2) + np.uint64(1)
    cells = np.floor((unit @ lines + shift) / how.width).astype(np.int64).astype(np.uint64)
    mixed = (cells.reshape(len(unit), how.tables, how.projections) * by).sum(2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hashed(how: Stable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                vectors = [np.array(v, np.float64) for v in batch["vector"].to_pylist()]
                signatures = [None] * len(vectors)
                for dims in {len(v) for v in vectors}:
                    at = [i for i, v in enumerate(vectors) if len(v) == dims]
                    x = np.stack([vectors[i] for i in at])
                    x /= np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for i, own in zip(at, bucket_ids(x, how), strict=True):
                        signatures[i] = own
                arrays = [batch["node"], batch["vector"], batch["copies"], pa.array(signatures, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "vector", "copies", "signature"])

    return run


def join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the rows i[k] and j[k] one root, and with them all rows that had theirs. Every root points at itself."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        # of a root's several smaller ones the least is taken; the pairs of the others stay apart until the next round
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


GROUP = ["dims", "t", "cell", "i", "j"]


def _compared(how: Stable):
    """Exact cosines of a group's pairs, counted in the first table that they share.

    Gives, for each vector with links in the group, the links' number with copies, and one node
    of all that the group's links join with it.
    """

    def links(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        side, node, copies, t = (table[c].to_numpy() for c in ("side", "node", "copies", "t"))
        dims = table["dims"].to_numpy()
        signature = np.concatenate([c.flatten().to_numpy() for c in table["signature"].chunks]).reshape(table.num_rows, -1)
        flat, starts = np.concatenate([c.flatten().to_numpy() for c in table["vector"].chunks]).astype(np.float64), np.append(0, np.cumsum(dims))
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x = flat[starts[first] : starts[last]].reshape(last - first, -1)
            x = x / np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            count, root = np.zeros(last - first, np.int64), np.arange(last - first)
            for i, j in _group_pairs(side[first:last], np.array([0, last - first])):
                near = np.einsum("ij,ij->i", x[i], x[j]) >= how.cosine
                i, j = i[near], j[near]
                for earlier in range(t[first]):
                    if not len(i):
                        break
                    apart = signature[first + i, earlier] != signature[first + j, earlier]
                    i, j = i[apart], j[apart]
                np.add.at(count, i, copies[first + j])
                np.add.at(count, j, copies[first + i])
                join(root, i, j)
            hit = np.flatnonzero(count)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(node[first + hit]), pa.array(node[first + root[hit]]), pa.array(count[hit])], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.stack([table[c].to_numpy() for c in GROUP], 1)
            cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            if len(cuts) > 1:
                yield from links(table.slice(0, cuts[-1]), cuts)
            rest = table.slice(cuts[-1])
        if rest is not None:
            yield from links(rest, np.array([0, rest.num_rows]))

    return run


def near_vectors(rows: DataFrame, how: Stable = Stable()) -> DataFrame:
    """One row per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
    lengths. Equal vectors are hashed once and count as linked with each other. Pairs that share a bucket of
    some table are held by their exact cosine, each counted in the first table they share. A large bucket is
    cut into blocks; a task compares two blocks and sends sums, not pairs. component_id is the smallest non-null vec_id
    reached, null if there is none; kept rows are those whose vec_id equals it, nulls being equal. Other columns are not read.
    """
    spark = rows.sparkSession
    ship_package(spark)
    stages = Stages(spark, "vectors")
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    given = rows.select(F.col("vec_id").cast("long"), vector.alias("vector")).withColumn("sound", sound)
    distinct = given.where("sound").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = stages.save(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    hashed = distinct.select("node", "vector", "copies").mapInArrow(_hashed(how), "node long, vector array<double>, copies long, signature array<int>")
    hashed = stages.save(hashed, "hashed")
    cells = hashed.select("node", F.size("vector").alias("dims"), F.posexplode("signature").alias("t", "cell"))
    shared = cells.groupBy("dims", "t", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("size")).where("size > 1")
    members = cells.join(shared.drop("size"), ["dims", "t", "cell"])
    own = F.pmod(F.xxhash64("node"), "blocks")
    tasks = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j"), F.when(k >= own, 1).otherwise(2).alias("side")))
    members = stages.save(members.withColumn("task", F.explode(tasks)).select("node", "dims", "t", "cell", "task.*"), "members")
    stages.release()
    carried = members.join(hashed, "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = stages.save(carried.mapInArrow(_compared(how), "a long, b long, links long"), "links")
    stages.release()
    label = components(found, stages)
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = distinct.join(label, "node", "left").join(counts, "node", "left")
    known = known.select("vector", "copies", "least", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    known = stages.save(known, "known")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stages.save(known.join(least, "root").select("vector", (F.col("copies") - 1 + F.col("links")).alias("n_links"), "component_id"), "named")
    linked = given.where("sound").join(known, "vector").select("vec_id", "n_links", "component_id")
    alone = given.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
