"""Exact top-k similarity search for one query or for many.

Many queries are scored without a join: each task multiplies its part of
the corpus with the query matrix and passes on only its k best per query, so
the shuffle holds k rows per query and task. Small query sets travel by
broadcast after a check of their size; larger ones are searched in batches of that size, over
a corpus that stays where it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from askquarry.functions.vectors import METRICS, SCORE_DIGITS, closest_first
from askquarry.operators.records import read_payload
from askquarry.session import materialize, scratch_path

DEFAULT_K = 4
BROADCAST_QUERIES = 65_536
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_MATCHES = 500_000
#: Distinct ids of matches that are looked up by a filter on the records.
LOOKUP_IDS = 1_000
#: Stands between id and namespace in a key; below all letters, so keys sort by id first.
SEPARATOR = "\x01"
BLOCK_ROWS = 16_384
BLOCK_BYTES = 128 * 1024 * 1024
ROW_SLICE = 1_024
QUERY_SLICE = 512
#: Pairs that are scored exactly at a time, and that wait at least before they are settled between tiles.
EXACT_SLICE = 65_536
SETTLE_PAIRS = 1_048_576
#: Squared lengths of query and row together, up to which products are made in single precision.
SINGLE_SQUARES = 1e30


class ModelMismatch(ValueError):
    """Query and corpus vectors come from different embedding models."""


def check_model(queries: DataFrame, query_vector: str, corpus: DataFrame, values: str) -> None:
    """Compare the model name and dimension in the column metadata of both sides."""
    ours, theirs = (df.schema[c].metadata or {} for df, c in ((queries, query_vector), (corpus, values)))
    for key in ("model", "dim"):
        if key in ours and key in theirs and ours[key] != theirs[key]:
            raise ModelMismatch(f"query {key} is {ours[key]!r}, corpus {key} is {theirs[key]!r}")


def in_namespace(records: DataFrame, namespace: str) -> DataFrame:
    """Records of one namespace; on a table partitioned by it, other folders are not read."""
    return records.filter(F.col("namespace") == namespace)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the right length as a float64 matrix, with their positions."""
    column = _flat(column)
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(rows)).flatten()
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    whole = np.isfinite(matrix).all(axis=1)
    return matrix[whole], rows[whole]


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    rows = np.flatnonzero(norms > 0)
    return matrix[rows] / norms[rows, None], rows


def _few_copies(ids: pa.Array, matrix: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """At most k rows of each distinct vector, those with the lowest ids.

    Equal vectors score alike, so the others cannot rank; without this a
    large group of copies would tie its way into every candidate list.
    """
    if len(ids) <= k:
        return ids, matrix
    mark = np.einsum("ij,j->i", matrix, np.cos(np.arange(matrix.shape[1])))
    _, first, group, counts = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
    if counts.max() <= k:
        return ids, matrix
    copies = (matrix == matrix[first[group]]).all(axis=1) & (counts[group] > k)
    rows = np.flatnonzero(copies)
    lowest = rows[_lowest_ids(group[rows], ids.take(pa.array(rows)), np.full(len(first), k))]
    kept = np.concatenate([np.flatnonzero(~copies), lowest])
    return ids.take(pa.array(kept)), matrix[kept]


def _lowest_ids(group: np.ndarray, ids: pa.Array, room: np.ndarray) -> np.ndarray:
    """Places of the rows with the lowest ids, ``room[g]`` of each group g."""
    frame = pd.DataFrame({"group": group, "id": np.array(ids.to_pylist(), dtype=object)}).sort_values(["group", "id"])
    place = frame.groupby("group", sort=False).cumcount().to_numpy()
    return frame.index.to_numpy()[place < room[frame["group"].to_numpy()]]


class QuerySet:
    """Query vectors held by one task, and the k best matches seen for each.

    A tile of rows and queries costs one product in single precision and its highest value for each query; where that reaches the
    query's bar, the pairs above it are scored exactly. Pairs wait as numbers (query, row, key) until they are settled to the k best, and of the rows' ids
    only those of such pairs are kept, so memory doesn't grow with the rows offered.
    """

    def __init__(self, positions: pa.Array, matrix: np.ndarray, k: int, metric: str):
        if metric == "cosine":
            matrix, rows = _unit(matrix)
            positions = positions.take(pa.array(rows))
        self.positions = positions
        self.matrix, self.k, self.metric = matrix, k, metric
        self.squares = np.einsum("ij,ij->i", matrix, matrix)
        self.narrow = self._left(matrix.astype(np.float32))
        #: Key of the k-th best match so far.
        self.floor = np.full(len(matrix), -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list[pa.Array] = []
        self.waiting = self.held = 0
        self.settled = False

    def _left(self, matrix: np.ndarray) -> np.ndarray:
        """The queries' side of the product; for l2 it gives 2 q.r - r.r, the distance but for q.q, turned round."""
        if self.metric != "l2":
            return matrix
        return np.hstack([2 * matrix, np.full((len(matrix), 1), -1, matrix.dtype)])

    def offer(self, ids: pa.Array, matrix: np.ndarray) -> None:
        if self.metric == "cosine":
            matrix, rows = _unit(matrix)
            ids = ids.take(pa.array(rows))
        ids, matrix = _few_copies(ids, matrix, self.k)
        squares = np.einsum("ij,ij->i", matrix, matrix)
        if self.metric != "cosine":  # long vectors together, since the longest of a slice sets its slack
            order = np.argsort(squares, kind="stable")
            ids, matrix, squares = ids.take(pa.array(order)), matrix[order], squares[order]
        for r in range(0, len(matrix) if len(self.matrix) else 0, ROW_SLICE):
            self._offer_rows(ids.slice(r, ROW_SLICE), matrix[r : r + ROW_SLICE], squares[r : r + ROW_SLICE])

    def _offer_rows(self, ids: pa.Array, rows: np.ndarray, squares: np.ndarray) -> None:
        """Keep the pairs that may reach the best k; single precision only preselects.

        ``slack`` covers the rounding of the product and of the shown score for the slice's longest vector. Until a
        query has k matches, the k-th product within the slice stands in for its floor. Vectors beyond single precision are
        multiplied in double, and a product or slack that isn't a number keeps its pairs.
        """
        both = self.squares + squares.max()
        fits = both.max() < SINGLE_SQUARES
        kind = np.float32 if fits else np.float64
        with np.errstate(over="ignore", invalid="ignore"):
            left = self.narrow if fits else self._left(self.matrix)
            right = (rows if self.metric != "l2" else np.hstack([rows, squares[:, None]])).astype(kind).T
            slack = (4 * (rows.shape[1] + 2) * np.finfo(kind).eps + 4 * 10.0**-SCORE_DIGITS) * (1.0 + both)
            products = np.empty((min(QUERY_SLICE, len(left)), len(rows)), kind)
            held = None
            for start in range(0, len(left), QUERY_SLICE):
                qs = slice(start, start + QUERY_SLICE)
                n = len(left[qs])
                fast = np.matmul(left[qs], right, out=products[:n])
                bar = (self.floor[qs] if self.metric != "l2" else self.squares[qs] - self.floor[qs] ** 2) - slack[qs]
                if len(rows) > self.k and np.isneginf(bar).any():
                    at = len(rows) - self.k
                    bar = np.maximum(bar, np.partition(fast, at, axis=1)[:, at] - 2 * slack[qs])
                bar = np.nextafter(bar.astype(kind), kind(-np.inf))
                # few queries have a product above their bar; only theirs are looked at one by one
                hot = np.flatnonzero(~(fast.max(axis=1) < bar))
                hits = np.flatnonzero(~(fast[hot] < bar[hot, None]))
                for h in range(0, len(hits), EXACT_SLICE):
                    q, r = np.divmod(hits[h : h + EXACT_SLICE], len(rows))
                    q = hot[q] + start
                    key = self._exact(self.matrix[q], rows[r])
                    near = ~(key < self.floor[q])
                    if near.any():
                        if held is None:
                            held = self.held
                            self.ids.append(ids)
                            self.held += len(ids)
                        self.best.append((q[near], r[near] + held, key[near]))
                        self.waiting += int(near.sum())
                        if self.waiting > max(2 * self.k * len(self.matrix), SETTLE_PAIRS):
                            self._settle()
                            held = None
        if not self.settled or self.waiting > 2 * self.k * len(self.matrix) or self.held > SETTLE_PAIRS:
            self._settle()

    def _exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Closeness summed pair by pair, equal for equal vectors wherever they lie."""
        if self.metric == "l2":
            return -np.round(np.sqrt(np.einsum("ij,ij->i", a - b, a - b)), SCORE_DIGITS)
        return np.round(np.einsum("ij,ij->i", a, b), SCORE_DIGITS)

    def _settle(self) -> None:
        """Keep each query's k best pairs, the lower id of equal ones, and the ids of their rows."""
        self.settled, self.waiting = True, 0
        if not self.best:
            return
        q, row, key = (np.concatenate(part) for part in zip(*self.best, strict=True))
        order = np.lexsort((-key, q))
        q, row, key = q[order], row[order], key[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        sizes = np.diff(np.r_[first, len(q)])
        group = np.repeat(np.arange(len(first)), sizes)
        place = np.arange(len(q)) - first[group]
        full = sizes >= self.k
        last = np.full(len(first), np.nan)
        last[full] = key[first[full] + self.k - 1]
        kept = place < self.k
        ids = pa.concat_arrays(self.ids)
        # where more rows than there is room for share the k-th key, their ids decide
        tied = key == last[group]
        crowded = np.zeros(len(first), bool)
        crowded[group[tied & ~kept]] = True
        among = np.flatnonzero(tied & crowded[group])
        if len(among):
            better = np.bincount(group[~tied & kept], minlength=len(first))
            kept[among] = False
            kept[among[_lowest_ids(group[among], ids.take(pa.array(row[among])), self.k - better)]] = True
        self.floor[q[first[full]]] = last[full]
        q, key = q[kept], key[kept]
        rows, row = np.unique(row[kept], return_inverse=True)
        self.ids, self.held = [ids.take(pa.array(rows))], len(rows)
        self.best = [(q, row, key)]

    def result(self, id_type: pa.DataType, q_type: pa.DataType) -> pa.RecordBatch:
        self._settle()
        q, row, key = self.best[0] if self.best else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        ids = self.ids[0].take(pa.array(row)) if self.best else pa.array([], id_type)
        score = (-key if self.metric == "l2" else key) + 0.0
        return pa.RecordBatch.from_arrays(
            [self.positions.take(pa.array(q)).cast(q_type), ids.cast(id_type), pa.array(score, pa.float64())],
            names=["qid", "id", "score"],
        )


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _kept(column: pa.Array | pa.ChunkedArray, rows: np.ndarray) -> pa.Array:
    return _flat(column).take(pa.array(rows))


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def _result_schema(corpus: DataFrame, qid: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", qid),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _scan(corpus: DataFrame, qids: pa.Array, matrix: np.ndarray, qid: T.DataType, k: int, metric: str) -> DataFrame:
    """Each task scans its corpus rows once against all queries, which travel by broadcast.

    There are no more tasks than cores, since each passes on k rows for every query.
    """
    dim = matrix.shape[1]
    context = corpus.sparkSession.sparkContext
    shared = context.broadcast((qids, matrix))
    id_type, q_type = _arrow(corpus, "id"), to_arrow_type(qid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = QuerySet(*shared.value, k, metric)
        for batch in batches:
            vectors, kept = _matrix(batch.column("values"), dim)
            found.offer(_kept(batch.column("id"), kept), vectors)
        best = found.result(id_type, q_type)
        yield from (best.slice(r, BLOCK_ROWS) for r in range(0, best.num_rows, BLOCK_ROWS))

    return corpus.select("id", "values").coalesce(context.defaultParallelism).mapInArrow(run, _result_schema(corpus, qid))


def topk_one(corpus: DataFrame, vector: list[float], k: int = 5, metric: str = "cosine") -> DataFrame:
    """The k best rows for one vector known to the driver, as ``(id, score)``, best first.

    Each task passes on k rows; there is no shuffle and no full sort.
    """
    check_metric(metric)
    matrix = np.array([vector], dtype=np.float64)
    partial = _scan(corpus, pa.array([0], pa.int64()), matrix, T.LongType(), k, metric)
    return partial.select("id", "score").orderBy(closest_first(F.col("score"), metric), "id").limit(k)


def score_blocks(
    corpus: DataFrame,
    queries: DataFrame,
    keys: list[str],
    dim: int,
    k: int,
    metric: str,
    vectors_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """The k best corpus rows per query within each block both sides name.

    Blocks are bounded by whoever assigns the keys; a group holds one corpus
    block and one query block and gives k rows per query. ``vectors_of`` makes the corpus vectors, with their
    row numbers, where they aren't the column ``values``.
    """
    id_type, q_type = _arrow(corpus, "id"), _arrow(queries, "qid")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        matrix, rows = _matrix(right.column("vector"), dim)
        found = QuerySet(_kept(right.column("qid"), rows), matrix, k, metric)
        vectors, kept = vectors_of(left) if vectors_of else _matrix(left.column("values"), dim)
        found.offer(_kept(left.column("id"), kept), vectors)
        return pa.Table.from_batches([found.result(id_type, q_type)])

    schema = _result_schema(corpus, queries.schema["qid"].dataType)
    return corpus.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, schema)


def rows_per_block(dim: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))


def _scan_batches(corpus: DataFrame, queries: DataFrame, n: int, dim: int, k: int, metric: str, limit: int) -> DataFrame:
    """Search in batches of about ``limit`` queries, one after another; the corpus is scanned by each and never moved.

    A batch's queries are dealt by hash, held by every task while it runs, and its merged result, k rows for each
    query, is written before the next one begins.
    """
    spark = corpus.sparkSession
    batches = math.ceil(n / limit)
    dealt = queries.withColumn("batch", F.pmod(F.xxhash64("qid"), F.lit(batches)))
    q_type = queries.schema["qid"].dataType
    path = scratch_path(spark, "query-batches")
    for batch in range(batches):
        table = dealt.filter(F.col("batch") == batch).toArrow()
        matrix, rows = _matrix(table.column("vector"), dim)
        partial = _scan(corpus, _kept(table.column("qid"), rows), matrix, q_type, k, metric)
        best_of(partial, k, metric).write.mode("append").parquet(path)
    schema = best_of(_scan(corpus, pa.array([], to_arrow_type(q_type)), np.zeros((0, dim)), q_type, k, metric), k, metric).schema
    return spark.read.schema(schema).parquet(path)


def best_of(partial: DataFrame, k: int, metric: str) -> DataFrame:
    """Merge partial results to ``(qid, rank, id, score)``; each query has few rows left."""
    order = Window.partitionBy("qid").orderBy(closest_first(F.col("score"), metric), F.col("id"))
    ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("qid", F.col("rank").cast("bigint").alias("rank"), "id", "score")


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")


def topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    metric: str = "cosine",
    dim: int | None = None,
    broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The k best corpus rows for every query, as ``(qid, rank, id, score)``.

    ``corpus`` has ``id`` and ``values``, ``queries`` has ``qid`` and ``vector``;
    other columns are dropped before scoring and joined back by the caller. Scores
    are rounded to ``SCORE_DIGITS``; equal scores rank the lower id first. Null,
    wrongly sized and (for cosine) zero vectors take no part.

    The vectors must have the dimension ``dim``, taken from the column metadata
    where it is not given. Up to ``broadcast_queries`` queries (and
    ``BROADCAST_BYTES``) are broadcast; more are searched in batches of that size.
    """
    check_metric(metric)
    check_model(queries, "vector", corpus, "values")
    metadata = queries.schema["vector"].metadata or {}
    dim = dim or metadata.get("dim") or (corpus.schema["values"].metadata or {}).get("dim")
    if not dim:
        raise ValueError("the vector dimension is neither given nor in the column metadata")
    corpus = corpus.select("id", "values")
    # Written once: the vectors may come from paid model calls, and are counted and read.
    queries = materialize(queries.select("qid", "vector"), "query-vectors")
    limit, n = max(1, min(broadcast_queries, BROADCAST_BYTES // (8 * dim))), queries.count()
    if n > limit:
        return _scan_batches(corpus, queries, n, dim, k, metric, limit)
    table = queries.toArrow()
    matrix, rows = _matrix(table.column("vector"), dim)
    partial = _scan(corpus, _kept(table.column("qid"), rows), matrix, queries.schema["qid"].dataType, k, metric)
    return best_of(partial, k, metric)


def topk_records(records: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "cosine", **options) -> DataFrame:
    """Top-k over vector records, whose key is namespace and id: ``(qid, rank, namespace, id, score)``.

    Equal scores rank the lower id first, then the lower namespace; null counts as the empty namespace.
    Options are those of ``topk``.
    """
    both = F.concat(F.col("id"), F.lit(SEPARATOR), F.coalesce("namespace", F.lit("")))
    found = topk(records.select(both.alias("id"), "values"), queries, k, metric, **options)
    namespace = F.nullif(F.substring_index("id", SEPARATOR, -1), F.lit(""))
    id = F.expr(f"substring(id, 1, length(id) - length(substring_index(id, '{SEPARATOR}', -1)) - 1)")
    return found.select("qid", "rank", namespace.alias("namespace"), id.alias("id"), "score")


def with_payload(
    matches: DataFrame,
    records: DataFrame,
    include_values: bool = False,
    include_metadata: bool = True,
    broadcast_matches: int = BROADCAST_MATCHES,
) -> DataFrame:
    """Join the payload of the winners back on; it is not read before the top-k.

    Records are met by namespace and id where the matches have both, else by id. The matches are written out, so
    the search runs once, and counted. Up to ``broadcast_matches`` of them are broadcast and the records only scanned;
    if their distinct ids are at most ``LOOKUP_IDS``, these are a filter too, by which a table sorted by id or with Bloom filters
    leaves row groups unread. More are joined by shuffle, first to their distinct keys, so a record that very many
    queries found is fetched once.
    """
    keys = [c for c in ("namespace", "id") if c in matches.columns and c in records.columns]
    wanted = ["values"] * include_values + ["metadata"] * include_metadata
    matches = materialize(matches, "matches")
    payloads = records.select(*[F.col(c).alias(f"_{c}") for c in keys], *wanted)
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"_{c}").eqNullSafe(F.col(c))
    if matches.count() <= broadcast_matches:
        ids = matches.select("id").distinct().limit(LOOKUP_IDS + 1).collect()
        if len(ids) <= LOOKUP_IDS:
            payloads = payloads.filter(F.col("_id").isin([r["id"] for r in ids]))
        joined = payloads.join(F.broadcast(matches), same)
    else:
        few = matches.select(*keys).distinct()
        joined = matches.join(payloads.join(few, same, "left_semi"), same)
    joined = joined.select(*matches.columns, *wanted)
    if not include_metadata:
        return joined
    payload = read_payload(F.col("metadata"))
    return joined.withColumn("url", payload["url"]).withColumn("content", payload["content"]).drop("metadata")
