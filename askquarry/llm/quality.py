"""Quality classifier: supervised subword embeddings (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askquarry.llm import rolling
from askquarry.session import ship_package

#: Labelled rows that training uses at most: those whose hashed doc_id comes first.
TRAINING_ROWS = 2_000
THRESHOLD = 0.3
#: Character n-grams have from 2 to so many.
LONGEST = 4
#: Pairs of words so far apart are features too; only whether both are equal names them.
LAGS = (1, 2, 3)


@dataclass(frozen=True)
class Training:
    #: a power of two
    buckets: int = 1 << 16
    dims: int = 8
    epochs: int = 6
    rate: float = 0.5
    seed: int = 3


@dataclass(frozen=True)
class Model:
    """Vectors of the hashed features folded with the softmax layer: each feature's share of the margin."""

    margins: np.ndarray
    bias: float


def features(texts: list[bytes], buckets: int) -> Iterator[np.ndarray]:
    """The hashed words, word pairs and character n-grams of every text; n-grams run inside words with their edges marked.

    Characters are code points. A text without words has no feature.
    """
    for text in texts:
        if not text:
            yield np.zeros(0, np.int64)
            continue
        points = np.frombuffer((" " + text.decode() + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
        blank = (points == 32) | ((points - np.uint64(9)) < 5)
        words, _ = rolling.word_hashes(text)
        found = [words]
        for lag in LAGS:
            same = words[lag:] == words[:-lag]
            found.append(np.where(same, np.uint64(2 * lag), np.uint64(2 * lag + 1)))
        spaces = np.cumsum(blank)
        grams = points
        for size in range(2, LONGEST + 1):
            power = pow(rolling.BASES[1], size - 1, 1 << 64)
            grams = grams[:-1] + points[size - 1 :] * np.uint64(power)
            n = len(grams)
            # white space at one edge only
            between = spaces[size - 2 : n + size - 2] == spaces[:n]
            found.append(grams[between & ~(blank[:n] & blank[size - 1 :])])
        yield ((np.concatenate(found) * np.uint64(rolling.BASES[0])) >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, how: Training) -> Model:
    """Softmax over the mean feature vector of a document, by stochastic gradient descent.

    ``rows`` are (features, counts). Without rows of both labels the model answers with their share.
    """
    share = min(0.99, max(0.01, float(labels.mean()))) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(how.buckets, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(how.seed)
    vectors = rng.uniform(-1 / how.dims, 1 / how.dims, (how.buckets, how.dims)).astype(np.float32)
    layer = np.zeros((2, how.dims), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    order, steps, step = np.arange(len(rows)), how.epochs * len(rows), 0
    for _ in range(how.epochs):
        rng.shuffle(order)
        for k in order:
            rate, step = how.rate * (1 - step / steps), step + 1
            at, counts = rows[k]
            if not len(at):
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            mean = weight @ vectors[at]
            score = layer @ mean + bias
            chance = np.exp(score - score.max())
            error = chance / chance.sum()
            error[labels[k]] -= 1
            back = error @ layer
            layer -= rate * np.outer(error, mean)
            bias -= 0.05 * rate * error
            # relative to the document's commonest feature, so a step moves the mean by no more than its gradient
            vectors[at] -= (rate * weight / weight.max())[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, how: Training = Training()) -> Model:
    """Train on at most ``rows`` labelled documents outside the held-out fifth.

    Only that bounded sample, as feature counts of whole texts, comes to the driver. Rows without id or label are not learnt from.
    """
    ship_package(docs.sparkSession)
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    picked = usable.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"))
    order = [F.xxhash64(F.lit(how.seed), "doc_id"), F.col("doc_id")]
    picked = picked.orderBy(*order).limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            found = [np.unique(f, return_counts=True) for f in features(texts, how.buckets)]
            at = pa.array([f[0].astype("<u4").tobytes() for f in found], pa.binary())
            counts = pa.array([f[1].astype("<u4").tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["quality"], at, counts], names=["doc_id", "quality", "at", "counts"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    counted = texts.mapInArrow(run, "doc_id long, quality int, at binary, counts binary")
    # repeated ids: still no more rows than asked for
    sample = counted.orderBy(*order, "quality", "at").limit(rows).toLocalIterator()
    learnt, truth = [], []
    for r in sample:
        learnt.append((np.frombuffer(r["at"], "<u4"), np.frombuffer(r["counts"], "<u4")))
        truth.append(r["quality"])
    return train(learnt, np.array(truth, np.int64), how)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc, score), all columns of ``docs`` being the struct ``doc``: the chance of label 1, over whole texts.

    Null and empty texts have no feature and get the score of the bias.
    """
    ship_package(docs.sparkSession)
    margins, bias = model.margins, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            found = [margins[f].mean() if len(f) else 0.0 for f in features(texts, len(margins))]
            score = 1 / (1 + np.exp(-(np.array(found, np.float64) + bias)))
            yield pa.RecordBatch.from_arrays([part["doc"], pa.array(score)], names=["doc", "score"])

    rows = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, rows)
    slim = scored(docs.select("doc_id", "text"), model)
    return slim.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    return scored(docs, fit(docs, labels, rows)).where(F.col("score") >= THRESHOLD).select("doc.*")
