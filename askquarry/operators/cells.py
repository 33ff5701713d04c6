"""Top-k search over vectors grouped into cells around k-means centres.

Approximate form: each query looks into its ``probes`` nearest cells. Exact form:
a second round visits just those further cells that can still hold a match,
by the triangle inequality on cell radius and distance to the centre. Both meet
in equi-joins on bounded blocks: a cell with very many rows is split into blocks, a cell
asked for by very many queries into query parts.

Each row also has a code: its offset from the centre in one byte per dimension. ``topk_coded`` reads only codes, a quarter of
the vectors' bytes, for a short list per query, and the vectors of those short lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askquarry.functions.vectors import SCORE_DIGITS
from askquarry.operators.search import (
    BROADCAST_MATCHES,
    LOOKUP_IDS,
    _matrix,
    _unit,
    best_of,
    check_metric,
    check_model,
    rows_per_block,
    score_blocks,
)
from askquarry.session import materialize

# Centres are held by every task: at most this many bytes of them.
CENTRE_BYTES = 64 * 1024 * 1024
PUSHED_CELLS = 1_000
DISTANCE_ENTRIES = 4_000_000


@dataclass
class CellIndex:
    rows: DataFrame  # (id, values, cell, gap, code, step): gap is the distance to the cell's centre
    stats: DataFrame  # (cell, n_rows, radius): one row per cell
    centres: np.ndarray
    metric: str


def _points(column, dim: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in the space where nearer means better: unit length for cosine."""
    matrix, rows = _matrix(column, dim)
    if metric == "cosine":
        matrix, kept = _unit(matrix)
        rows = rows[kept]
    return matrix, rows


def _slices(batches: Iterator[pa.RecordBatch], n_centres: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one table of distances stays small."""
    step = max(1, DISTANCE_ENTRIES // n_centres)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", centres, centres)[None, :]
    return np.sqrt(np.maximum(squares - 2 * points @ centres.T, 0.0))


def build_cells(
    corpus: DataFrame,
    dim: int,
    n_cells: int,
    metric: str = "cosine",
    seed: int = 7,
    training_rows: int | None = None,
    iterations: int = 8,
) -> CellIndex:
    """Train centres on all rows, then assign every row to its nearest one.

    With ``training_rows`` about that many rows, drawn at random, place the centres; all rows are
    indexed. The index is a written table, range-partitioned by cell and id: a large cell spans several
    files and a scan for few cells skips the others.
    """
    check_metric(metric)
    if metric == "dot":
        raise ValueError("cells order vectors by distance; use cosine or l2")
    if n_cells * dim * 8 > CENTRE_BYTES:
        raise ValueError(f"{n_cells} centres of {dim} dimensions exceed {CENTRE_BYTES} bytes")
    metadata = corpus.schema["values"].metadata
    corpus = corpus.select("id", "values").filter(F.size("values") == dim)
    trained_on = corpus
    if training_rows is not None:
        trained_on = corpus.sample(min(1.0, training_rows / max(1, corpus.count())), seed)
    centres = _train(trained_on, dim, n_cells, metric, seed, iterations)
    shared = corpus.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType(
        [
            *corpus.schema.fields,
            T.StructField("cell", T.IntegerType()),
            T.StructField("gap", T.DoubleType()),
            T.StructField("code", T.BinaryType()),
            T.StructField("step", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, n_cells):
            points, rows = _points(batch.column("values"), dim, metric)
            if not len(rows):
                continue
            gaps = _distances(points, shared.value)
            cell = gaps.argmin(axis=1)
            nearest = np.take_along_axis(gaps, cell[:, None], axis=1)[:, 0]
            kept = pa.Table.from_batches([batch]).take(pa.array(rows))
            kept = kept.append_column("cell", pa.array(cell.astype(np.int32)))
            kept = kept.append_column("gap", pa.array(nearest))
            offsets = points - shared.value[cell]
            step = np.maximum(np.abs(offsets).max(axis=1), 1e-300) / 127
            codes = np.rint(offsets / step[:, None]).astype(np.int8)
            kept = kept.append_column("code", pa.array([c.tobytes() for c in codes], pa.binary()))
            yield from kept.append_column("step", pa.array(step)).combine_chunks().to_batches()

    # written first, as dealing by range looks at its input twice
    assigned = materialize(corpus.mapInArrow(run, schema), "cells-assigned")
    rows = materialize(assigned.repartitionByRange("cell", "id"), "cells")
    rows = rows.withColumn("values", F.col("values").alias("values", metadata=metadata or {}))
    stats = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"), F.max("gap").alias("radius"))
    return CellIndex(rows, materialize(stats, "cell-stats"), centres, metric)


def _train(rows: DataFrame, dim: int, n_cells: int, metric: str, seed: int, iterations: int) -> np.ndarray:
    points = rows.select(array_to_vector(F.col("values").cast("array<double>")).alias("features"))
    if metric == "cosine":
        points = Normalizer(p=2.0, inputCol="features", outputCol="unit").transform(points).select(
            F.col("unit").alias("features")
        )
    model = KMeans(k=n_cells, seed=seed, maxIter=iterations, initSteps=2).fit(points)
    return np.array(model.clusterCenters(), dtype=np.float64).reshape(-1, dim)


def _route(queries: DataFrame, index: CellIndex, dim: int, probes: int, reach: dict[int, float] | None) -> DataFrame:
    """Add the cells each query visits.

    First round (``reach`` is none): its ``probes`` nearest cells. Second round: the
    cells beyond those whose rows may lie within the query's ``bound``.
    """
    metric, centres = index.metric, index.centres
    radius = None
    if reach is not None:
        radius = np.full(len(centres), -np.inf)
        for cell, r in reach.items():
            radius[cell] = r
    shared = queries.sparkSession.sparkContext.broadcast((centres, radius))
    schema = T.StructType([queries.schema["qid"], queries.schema["vector"], T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radius = shared.value
        for batch in _slices(batches, len(centres)):
            points, rows = _points(batch.column("vector"), dim, metric)
            if not len(rows):
                continue
            gaps = _distances(points, centres)
            near = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
            if radius is None:
                q = np.repeat(np.arange(len(rows)), near.shape[1])
                cells = near.ravel()
            else:
                bound = batch.column("bound").to_numpy(zero_copy_only=False)[rows]
                open_cells = gaps - radius[None, :] <= bound[:, None] + 1e-6
                np.put_along_axis(open_cells, near, False, axis=1)
                q, cells = np.nonzero(open_cells)
            table = pa.Table.from_batches([batch]).select(["qid", "vector"]).take(pa.array(rows[q]))
            table = table.append_column("cell", pa.array(cells.astype(np.int32)))
            yield from table.combine_chunks().to_batches()

    return queries.mapInArrow(run, schema)


def _decoded(index: CellIndex, dim: int):
    """The vectors that a table's codes stand for, with all row numbers."""
    centres = index.centres

    def run(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(-1, dim)
        cell, step = table.column("cell").to_numpy(), table.column("step").to_numpy()
        return centres[cell] + codes * step[:, None], np.arange(len(codes))

    return run


def _visit(index: CellIndex, routed: DataFrame, dim: int, k: int, block_rows: int, coded: bool = False) -> DataFrame:
    """Score routed queries against the rows of their cells, or their codes, block by block."""
    asked = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_queries"))
    # At most one row per centre, whose number build_cells bounds.
    layout = index.stats.join(asked, "cell").select(
        "cell",
        F.ceil(F.col("n_rows") / block_rows).alias("blocks"),
        F.ceil(F.col("n_queries") / block_rows).alias("parts"),
    ).toArrow()
    cells = layout.column("cell").to_pylist()
    rows = index.rows
    if len(cells) <= PUSHED_CELLS:
        # A plain filter, so that files holding none of these cells are not read.
        rows = rows.filter(F.col("cell").isin(cells))
    layout = F.broadcast(routed.sparkSession.createDataFrame(layout))

    def numbers(n: str):
        return F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)

    block, part = F.pmod(F.xxhash64("id"), "blocks"), F.pmod(F.xxhash64("qid"), "parts")
    left = rows.join(layout, "cell").select(
        "id", *(["code", "step"] if coded else ["values"]), "cell", block.alias("block"), F.explode(numbers("parts")).alias("part")
    )
    right = routed.join(layout, "cell").select(
        "qid", "vector", "cell", part.alias("part"), F.explode(numbers("blocks")).alias("block")
    )
    return score_blocks(left, right, ["cell", "block", "part"], dim, k, index.metric, _decoded(index, dim) if coded else None)


def topk_coded(
    index: CellIndex,
    queries: DataFrame,
    k: int,
    probes: int = 4,
    shortlist: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Approximate top-k in two levels, as ``(qid, rank, id, score)``; scores are exact.

    In its ``probes`` nearest cells a query ranks rows by their codes; the best ``shortlist`` (twice k if not given) are
    scored again by their vectors, which no other row's are read for.
    """
    check_model(queries, "vector", index.rows, "values")
    dim, shortlist = index.centres.shape[1], max(k, shortlist or 2 * k)
    block_rows = block_rows or rows_per_block(dim)
    queries = materialize(queries.select("qid", "vector"), "coded-queries")
    first = _visit(index, _route(queries, index, dim, probes, None), dim, shortlist, block_rows, coded=True)
    listed = materialize(best_of(first, shortlist, index.metric).select("qid", "id"), "shortlist")
    parts = max(1, math.ceil(listed.count() / block_rows))
    part = F.pmod(F.xxhash64("qid"), F.lit(parts))
    wanted = listed.select("id", part.alias("part")).distinct()
    rows = index.rows.select("id", "values")
    if listed.count() <= BROADCAST_MATCHES:
        ids = wanted.select("id").distinct().limit(LOOKUP_IDS + 1).collect()
        if len(ids) <= LOOKUP_IDS:
            rows = rows.filter(F.col("id").isin([r["id"] for r in ids]))
        wanted = F.broadcast(wanted)
    found = score_blocks(rows.join(wanted, "id"), queries.withColumn("part", part), ["part"], dim, k, index.metric)
    return best_of(found, k, index.metric)


def topk_cells(
    index: CellIndex,
    queries: DataFrame,
    k: int,
    probes: int = 4,
    exact: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """The k best rows per query from the cell index, as ``(qid, rank, id, score)``.

    With ``exact`` the result equals ``search.topk``; without, rows in cells that
    were not probed can be missed.
    """
    check_model(queries, "vector", index.rows, "values")
    dim = index.centres.shape[1]
    block_rows = block_rows or rows_per_block(dim)
    queries = materialize(queries.select("qid", "vector"), "cell-queries")
    routed = _route(queries, index, dim, probes, None)
    first = _visit(index, routed, dim, k, block_rows)
    if not exact:
        return best_of(first, k, index.metric)
    first = materialize(best_of(first, k, index.metric), "cell-first-round").drop("rank")
    kth = first.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("score") if index.metric == "l2" else F.min("score")).alias("worst"),
    )
    worst = F.col("worst") + 10.0**-SCORE_DIGITS
    if index.metric == "cosine":
        # Distance between unit vectors of this cosine.
        worst = F.sqrt(F.greatest(2 - 2 * (F.col("worst") - 10.0**-SCORE_DIGITS), F.lit(0.0)))
    bound = F.when(F.coalesce("n", F.lit(0)) < k, F.lit(float("inf"))).otherwise(worst)
    bounded = queries.join(kth, "qid", "left").select("qid", "vector", bound.alias("bound"))
    # One number per centre, whose count build_cells bounds.
    reach = {row["cell"]: row["radius"] for row in index.stats.collect()}
    second = _visit(index, _route(bounded, index, dim, probes, reach), dim, k, block_rows)
    return best_of(first.unionByName(second), k, index.metric)
