"""Toxic passages by maximum-scoring segments (operator 12).

Every word has a log-odds of toxic against clean documents, with a Dirichlet prior. All maximal segments of a text are found
in one scan; their scores follow an extreme-value law on clean text, whose two constants are learnt, so segments
become expectations, their sum over a document a statistic, and that a chance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askquarry.llm import rolling
from askquarry.session import ship_package

#: Labelled rows that counts are learnt from at most: those whose hashed doc_id comes first.
TRAINING_ROWS = 20_000
#: Of these, rows whose segments set the constants of the law and the chance.
CALIBRATION_ROWS = 4_000
THRESHOLD = 0.3
#: A passage is a segment of which clean text of that length is expected to hold at most so many.
SIGNIFICANT = 0.1
#: Scores of words that a Python worker remembers.
REMEMBERED = 500_000

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    #: cells of each of the two rows of counts, a power of two
    cells: int = 1 << 19
    #: words that the prior counts as seen, divided as all words are
    prior: float = 2.0
    #: taken from every word's log-odds, so that passages end
    drift: float = 1.0


@dataclass(frozen=True)
class Model:
    """Word counts by class in two rows of cells, and the law's constants."""

    toxic: np.ndarray
    clean: np.ndarray
    share: float
    how: Training
    rate: float = 1.0
    density: float = 1.0
    slope: float = 0.0
    bias: float = 0.0

    def odds(self, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """Log-odds of words from their counts; unseen words have minus the drift."""
        prior, share = self.how.prior, self.share
        return np.log((toxic + prior * share) / (clean + prior * (1 - share))) - np.log(share / (1 - share)) - self.how.drift


def words_of(text: bytes) -> list[str]:
    """The runs of letters of a text, lower-cased."""
    return _WORDS.findall(text.decode().lower())


def cells_of(word: str, cells: int) -> tuple[int, int]:
    h = xxhash.xxh64_intdigest(word)
    return h & (cells - 1), cells + ((h >> 32) & (cells - 1))


def counts_of(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(toxic, clean) counts of words: of a word's two cells the lesser ones."""
    at = np.array([cells_of(w, model.how.cells) for w in words], np.int64).reshape(-1, 2)
    return model.toxic[at].min(1).astype(float), model.clean[at].min(1).astype(float)


class Scores:
    """The log-odds of words, remembered."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def learn(self, words: Iterable[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(words) - self.known.keys())
        self.known.update(zip(new, self.model.odds(*counts_of(new, self.model)).tolist(), strict=True))

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), float, len(words))


def maximal_segments(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, score) of all maximal scoring segments, in order; ends are exclusive.

    The linear-time scan: a segment looks for the last one that starts lower; a segment passed over points at the
    one it found itself, so the search never looks at what lies between. Runs of positive scores are one item.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    positive = np.concatenate([[False], scores > 0, [False]])
    edges = np.flatnonzero(positive[1:] != positive[:-1])
    starts, ends = edges[::2].tolist(), edges[1::2].tolist()
    lows, highs = sums[edges[::2]].tolist(), sums[edges[1::2]].tolist()
    held: list[tuple[int, int, float, float, int]] = []
    for start, end, low, high in zip(starts, ends, lows, highs, strict=True):
        at = len(held) - 1
        while True:
            while at >= 0 and held[at][2] >= low:
                at = held[at][4]
            if at < 0 or held[at][3] >= high:
                held.append((start, end, low, high, at))
                break
            start, low, before = held[at][0], held[at][2], held[at][4]
            del held[at:]
            at = before
    first, last, low, high, _ = zip(*held, strict=True) if held else ((),) * 5
    return np.array(first, np.int64), np.array(last, np.int64), np.array(high, float) - np.array(low, float)


def evidence(segments: np.ndarray, n: int, rate: float, density: float) -> float:
    """Minus the logarithm of the chance that clean text of ``n`` words has segments as high as these together.

    A segment's normalised score is minus the logarithm of how many so high are expected. The best r of the segments of which
    at most ``SIGNIFICANT`` are expected, with sum t, have the chance e^-t t^(r-1) / (r! (r-1)!);
    the r with the least chance counts. Without any the best segment alone does. In short texts
    as many segments are expected as in those with one above zero.
    """
    normal = np.sort(rate * segments - np.log(max(density * n, 1.0)))[::-1]
    if not len(normal) or normal[0] <= 0:
        return 0.0
    t = np.cumsum(normal[: max(1, int((normal >= -np.log(SIGNIFICANT)).sum()))])
    log_factorial = np.cumsum(np.log(np.arange(1, len(t) + 1)))
    found = t - np.arange(len(t)) * np.log(t) + log_factorial + np.concatenate([[0.0], log_factorial[:-1]])
    return float(max(found.max(), 0.0))


def _rate(model: Model) -> float:
    """The law's first constant: the positive root of E[exp(rate * score)] = 1 over the words of clean text."""
    cells = model.how.cells
    toxic, clean = model.toxic[:cells].astype(float), model.clean[:cells].astype(float)
    seen = toxic + clean > 0
    scores = model.odds(toxic[seen], clean[seen])
    weight = clean[seen] + model.how.prior * (1 - model.share)
    if not len(scores) or scores.max() <= 0 or weight @ scores >= 0:
        return 1.0
    weight /= weight.sum()
    low, high = 1e-3, 50.0 / scores.max()
    for _ in range(60):
        rate = (low + high) / 2
        low, high = (rate, high) if weight @ np.exp(rate * scores) < 1 else (low, rate)
    return rate


def _chance(found: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the chance of label 1 by the logarithm of the evidence, with a light ridge; a single label gives its share."""
    share = min(0.99, max(0.01, float(labels.mean()))) if len(labels) else 0.01
    w = np.array([0.0, np.log(share / (1 - share))])
    if len(set(labels.tolist())) < 2:
        return 0.0, float(w[1])
    x = np.stack([np.log1p(found), np.ones(len(found))], 1)
    ridge = np.diag([0.1, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2; rows without id too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, toxic, text of the documents of at most ``rows`` labels; repeated ids have their greatest label."""
    usable = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    picked = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = picked.orderBy(F.xxhash64(F.lit(12), "doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "doc_id")


def _cell_counts(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            counts = [Counter(), Counter()]
            for toxic, text in zip(part["toxic"].to_pylist(), texts, strict=True):
                counts[toxic].update(words_of(text))
            at, told = [], []
            for toxic, words in enumerate(counts):
                for word, n in words.items():
                    for cell in cells_of(word, cells):
                        at.append(cell)
                        told.append((n * (1 - toxic), n * toxic))
            told = np.array(told, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(told[:, 0]), pa.array(told[:, 1])], names=["cell", "clean", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, how: Training = Training()) -> Model:
    """Learn from the whole texts of at most ``rows`` labelled documents outside the held-out quarter.

    Counts are summed in Spark; the driver gets no more than the cells, and segment scores of ``CALIBRATION_ROWS`` rows.
    These rows are scored without their own words' counts, so their evidence is that of unseen text.
    Rows without id, or without label 0 or 1, are not learnt from. Without rows of both labels every
    score is their label's share.
    """
    ship_package(docs.sparkSession)
    sample = _sample(docs, labels, rows)
    cells = sample.mapInArrow(_cell_counts(how.cells), "cell long, clean long, toxic long")
    sums = cells.groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    clean, toxic = np.zeros(2 * how.cells, np.int64), np.zeros(2 * how.cells, np.int64)
    at = sums["cell"].to_numpy()
    clean[at], toxic[at] = sums["clean"].to_numpy(), sums["toxic"].to_numpy()
    total = toxic.sum() + clean.sum()
    share = min(0.99, max(0.01, float(toxic.sum() / total))) if total else 0.5
    model = Model(toxic, clean, share, how)
    model = Model(toxic, clean, share, how, _rate(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            out = []
            for label, text in zip(part["toxic"].to_pylist(), texts, strict=True):
                words = words_of(text)
                own = Counter(words)
                n = np.array(list(own.values()), float)
                toxic, clean = counts_of(list(own), model)
                odds = model.odds(np.maximum(toxic - n * label, 0), np.maximum(clean - n * (1 - label), 0))
                scores = dict(zip(own, odds.tolist(), strict=True))
                out.append((len(words), maximal_segments(np.fromiter(map(scores.__getitem__, words), float, len(words)))[2]))
            yield pa.RecordBatch.from_arrays([part["toxic"], pa.array([n for n, _ in out], pa.int64()), pa.array([s.astype("<f4").tobytes() for _, s in out], pa.binary())], names=["toxic", "n", "segments"])

    told = _sample(docs, labels, min(rows, CALIBRATION_ROWS)).mapInArrow(run, "toxic int, n long, segments binary").collect()
    truth = np.array([r["toxic"] for r in told], np.int64)
    segments = [np.frombuffer(r["segments"], "<f4").astype(float) for r in told]
    # likeliest density, given the highest segment of every clean text
    spent = sum(r["n"] * np.exp(-model.rate * s.max()) for r, s in zip(told, segments, strict=True) if not r["toxic"] and len(s))
    density = sum(1 for r, s in zip(told, segments, strict=True) if not r["toxic"] and len(s)) / spent if spent else 1.0
    found = np.array([evidence(s, r["n"], model.rate, density) for r, s in zip(told, segments, strict=True)])
    return Model(toxic.astype("<u4"), clean.astype("<u4"), share, how, model.rate, float(density), *_chance(found, truth))


_PASSAGES = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
PASSAGES = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())]))


def score_texts(docs: DataFrame, model: Model, expected: float = SIGNIFICANT) -> DataFrame:
    """(doc, score, passages), all columns of ``docs`` being the struct ``doc``.

    ``passages`` are the maximal segments of which clean text of that length is expected to hold at most ``expected``, in
    order, by their first and last word (from 0; words are runs of letters). A null or empty text has none, and the
    score of no evidence. Every row is scored on its whole text alone, so repeated rows have equal
    results. A task holds one text's words and scores at a time.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType()), T.StructField("passages", PASSAGES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scores(model)
        for part, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            scores, passages = [], []
            found_words = [words_of(text) for text in texts]
            known.learn(chain.from_iterable(found_words))
            for words in found_words:
                first, end, segments = maximal_segments(known.of(words))
                found = evidence(segments, len(words), model.rate, model.density)
                scores.append(1 / (1 + np.exp(-(model.slope * np.log1p(found) + model.bias))))
                chance = max(model.density * len(words), 1.0) * np.exp(-model.rate * segments)
                passages.append([{"first_word": int(first[k]), "last_word": int(end[k]) - 1, "score": segments[k], "expected": chance[k]} for k in np.flatnonzero(chance <= expected)])
            yield pa.RecordBatch.from_arrays([part["doc"], pa.array(scores, pa.float64()), pa.array(passages, _PASSAGES)], names=schema.names)

    return rows.mapInArrow(run, schema)


def toxic_passages(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score from 0.3 on), passages.

    A null doc_id counts as held out. Without documents there are no rows; without usable labels every score is 0.01,
    the least share the calibration gives. Columns other than doc_id and text are not read.
    """
    found = score_texts(docs.select("doc_id", "text"), fit(docs, labels, rows))
    doc_id = F.col("doc.doc_id")
    return found.select(doc_id, held_out(doc_id).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
