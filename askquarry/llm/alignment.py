"""Alignment of two tokenizers' tokens over the same text (operator 13)."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askquarry.llm import rolling
from askquarry.llm.common import Stages
from askquarry.llm.packing import Encoder
from askquarry.session import ship_package

#: Id pairs whose counts are sent to all tasks, 16 bytes each; more are joined.
BROADCAST_PAIRS = 4_000_000
#: Units that a Python worker remembers, and characters of them.
REMEMBERED, REMEMBERED_CHARS = 600_000, 12_000_000

def shared_cuts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups between neighbouring common values of two rising arrays with the same last value end, in each.

    In every interval the common value nearest to the middle is found by bisection in the other array and divides the
    interval; both halves go on, and an interval without one is a group. The intervals of one depth are looked at
    together. Without values there are no groups.
    """
    low, high = np.array([0], np.int64), np.array([len(a)], np.int64)
    cuts = [high[high > 0]]
    while len(low):
        middle, found = (low + high - 2) // 2, np.full(len(low), -1)
        left, k = np.flatnonzero(high - low > 1), 0
        while len(left):
            # the middle, the one after it, the one before it, ...; inner values only, as the last one is common already
            at = middle[left] + ((k + 1) // 2 if k % 2 else -(k // 2))
            inside = (at >= low[left]) & (at <= high[left] - 2)
            value = a[np.clip(at, 0, len(a) - 1)]
            common = inside & (b[np.searchsorted(b, value)] == value)
            found[left[common]] = at[common]
            k += 1
            left = left[~common & (high[left] - low[left] > k)]
        split = found >= 0
        cut = found[split] + 1
        cuts.append(cut)
        low, high = np.concatenate([low[split], cut]), np.concatenate([cut, high[split]])
    ends = np.sort(np.concatenate(cuts))
    return ends, np.searchsorted(b, a[ends - 1]) + 1


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the tokens whose ranges overlap, given the ends of all: one for each stretch between two ends of either."""
    stretches = np.sort(np.concatenate([a, b]), kind="stable")  # two runs, merged
    stretches = stretches[np.append(stretches[1:] != stretches[:-1], True)]
    return np.searchsorted(a, stretches), np.searchsorted(b, stretches)


class Aligner:
    """Aligned tokens of texts, unit by unit.

    Both vocabularies surely cut before a space or line end that follows a visible character, if a visible one follows the space:
    the byte-level pattern starts a new part there, and no piece holds a space after anything else or a line end. At
    these common ends a text falls into units. New units are encoded and divided further together, and remembered: plain tuples
    of n_a, n_b, n_groups, n_links, n_best, count_sum, the groups as text, and the linked ids, 8 bytes each, ``a * 2**32 + b``.
    """

    UNSURE = re.compile(r"\s\s|\s\Z")
    CUT = re.compile(r"(?<=\S)(?=\n| \S)")
    SPACE = "▁"

    def __init__(self, path_a: str, path_b: str, with_groups: bool = True, with_pairs: bool = True):
        """Groups or linked ids that aren't asked for stay empty."""
        from sentencepiece import SentencePieceProcessor

        own = Encoder(path_a)
        self.pairs, self.sizes_a = own.pairs, own.sizes
        self.pieces = SentencePieceProcessor(model_file=path_b)
        shown = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        if any("\n" in p or self.SPACE in p.lstrip(self.SPACE) for p in shown):
            raise ValueError("a piece spans the space between words")
        self.start = self.pieces.piece_to_id(self.SPACE)
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.pieces.is_byte(i) else p.replace(self.SPACE, " ").encode() for i, p in enumerate(shown)]
        self.sizes_b = np.array([len(p) for p in self.bytes_b], np.int64)
        self.written = list(map(str, range(max(len(self.sizes_a), len(shown)))))
        self.with_groups, self.with_pairs = with_groups, with_pairs
        self.known: dict[str, tuple | None] = {}
        self.chars, self.counts_of = 0, None
        #: whether any unit known is None, that is, not given back by its tokens
        self.any_bad = False

    def units(self, text: str) -> list[str]:
        full = " " + text
        if self.UNSURE.search(full):
            return self.CUT.split(full)
        # no two white spaces meet, so every space or line end but the first begins a unit
        found = full.replace("\n", " \n").split(" ")
        return [u if u[0] == "\n" else " " + u for u in found[1:]]

    def learn(self, units: Iterable[str], counts: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """Align units that are not known yet; ``counts`` are the pairs and their counts, best ones negative."""
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.known.clear()
            self.chars = 0
        new = list(set(units) - self.known.keys())
        self.chars += sum(map(len, new))
        # only the last unit of a text can end in white space, and is then sure of its end by itself only
        together = [u for u in new if not u[-1].isspace()]
        for part in ([together] if together else []) + [[u] for u in new if u[-1].isspace()]:
            self._learn(part, counts)

    def _learn(self, units: list[str], counts: tuple[np.ndarray, np.ndarray] | None) -> None:
        whole = "".join(units)
        data = whole.encode()
        unit_ends = np.cumsum([len(u.encode()) for u in units])
        found = self.pieces.encode([u.removeprefix(" ") for u in units], num_threads=1)
        # the piece that stands for a space the unit hasn't
        found = [ids if u[0] == " " else ids[1:] if ids and ids[0] == self.start else [] for u, ids in zip(units, found, strict=True)]
        n_b = np.array([len(ids) for ids in found])
        b = list(chain.from_iterable(found))
        ends_b = np.cumsum(self.sizes_b[b])
        same = n_b.min() > 0 and np.array_equal(ends_b[np.cumsum(n_b) - 1], unit_ends)
        if not same or b"".join(map(self.bytes_b.__getitem__, b)) != data:
            given_back = [b"".join(map(self.bytes_b.__getitem__, ids)) == u.encode() for u, ids in zip(units, found, strict=True)]
            self.known.update((u, None) for u, same in zip(units, given_back, strict=True) if not same)
            self.any_bad = True
            rest = [u for u, same in zip(units, given_back, strict=True) if same]
            return self._learn(rest, counts) if rest else None
        a = self.pairs.encode_ordinary(whole)
        ends_a = np.cumsum(self.sizes_a[a])
        groups_a, groups_b = shared_cuts(ends_a, ends_b)
        i, j = overlaps(ends_a, ends_b)
        pairs = (np.array(a, np.int64)[i] << 32) | np.array(b, np.int64)[j]
        until_a = np.searchsorted(ends_a, unit_ends) + 1
        until_group = np.searchsorted(groups_a, until_a) + 1
        until_link = np.searchsorted(i, until_a)
        n_best = sums = np.zeros(len(units), np.int64)
        first = np.concatenate([[0], until_link[:-1]])
        if counts is not None:
            n = counts[1][np.searchsorted(counts[0], pairs)]
            n_best, sums = np.add.reduceat((n < 0).astype(np.int64), first), np.add.reduceat(np.abs(n), first)
        n_a, n_groups, n_links = (np.diff(x, prepend=0) for x in (until_a, until_group, until_link))
        groups = held = [None] * len(units)
        if self.with_groups:
            groups = self._written(a, b, groups_a, groups_b, until_group)
        if self.with_pairs:
            data = pairs.tobytes()
            held = [data[s:e] for s, e in zip((8 * first).tolist(), (8 * until_link).tolist(), strict=True)]
        numbers = (x.tolist() for x in (n_a, n_b, n_groups, n_links, n_best, sums))
        self.known.update(zip(units, zip(*numbers, groups, held, strict=True), strict=True))

    def _written(self, a: list[int], b: list[int], groups_a: np.ndarray, groups_b: np.ndarray, until: np.ndarray) -> list[str]:
        """Each unit's groups as text; ``until`` are the numbers of groups up to each unit's end."""
        starts_a, starts_b = (np.concatenate([[0], g[:-1]]) for g in (groups_a, groups_b))
        written = self.written
        told = [written[a[s]] + "|" + written[b[u]] for s, u in zip(starts_a.tolist(), starts_b.tolist(), strict=True)]
        for k in np.flatnonzero((groups_a - starts_a > 1) | (groups_b - starts_b > 1)).tolist():
            ids_a, ids_b = a[starts_a[k] : groups_a[k]], b[starts_b[k] : groups_b[k]]
            told[k] = ",".join([written[i] for i in ids_a]) + "|" + ",".join([written[i] for i in ids_b])
        until = until.tolist()
        return [";".join(told[s:e]) for s, e in zip([0, *until[:-1]], until, strict=True)]


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(tokenizers: tuple[str, str] | None, with_groups: bool, with_pairs: bool) -> Aligner:
    """A worker's aligner for one of the passes."""
    if tokenizers is None:
        import public_tokenizers

        tokenizers = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    # one at a time, so that a worker remembers one set of units
    if (key := (*tokenizers, with_groups, with_pairs)) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _unit_lists(aligner: Aligner, texts: list[bytes], counts: tuple[np.ndarray, np.ndarray] | None = None) -> list[list[str]]:
    """The units of every text; none where it is empty or holds the sign that pieces write for a space."""
    found = [t.decode() for t in texts]
    lists = [aligner.units(t) if t and Aligner.SPACE not in t else [] for t in found]
    aligner.learn(chain.from_iterable(lists), counts)
    if not aligner.any_bad:
        return lists
    # a text with a unit that isn't given back has no tokens
    return [[] if None in map(aligner.known.__getitem__, units) else units for units in lists]


def _pair_counts(tokenizers: tuple[str, str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(tokenizers, False, True)
        for _, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            seen = Counter(chain.from_iterable(_unit_lists(aligner, texts)))
            units = [aligner.known[u] for u in seen]
            pairs = np.frombuffer(b"".join(u[7] for u in units), np.int64)
            times = np.repeat(np.fromiter(seen.values(), np.int64, len(seen)), np.array([u[3] for u in units], np.int64))
            pair, at = np.unique(pairs, return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, at, times)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return run


def pair_counts(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """(pair, n, best): how many links hold an id pair, ``a * 2**32 + b``, and whether that is the most of all pairs with that b.

    Links are summed within a megabyte of text, then within each task, before the shuffle.
    """
    ship_package(docs.sparkSession)
    counted = docs.select(F.col("text").cast("string")).mapInArrow(_pair_counts(tokenizers), "pair long, n long")
    counts = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    # at most the first vocabulary's size in rows for each b
    same_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same_b)).alias("best"))


class Shared(NamedTuple):
    """Counts of pairs in all tasks, and which run they are of."""

    id: str
    table: Broadcast

    @property
    def value(self) -> tuple[np.ndarray, np.ndarray]:
        return self.table.value


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _described(tokenizers: tuple[str, str] | None, shared, with_pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(tokenizers, True, with_pairs)
        counts = shared.value if shared else None
        if shared and aligner.counts_of != shared.id:  # a worker may have served another run
            aligner.known.clear()
            aligner.chars, aligner.counts_of = 0, shared.id
        for rows, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            out, links = [], []
            for units in _unit_lists(aligner, texts, counts):
                *numbers, told, pairs = zip(*map(aligner.known.__getitem__, units), strict=True) if units else ((),) * 8
                out.append([*map(sum, numbers), hashlib.sha256(";".join(told).encode()).hexdigest() if units else ""])
                if with_pairs:
                    pair, n = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
                    links.append([{"pair": p, "times": m} for p, m in zip(pair.tolist(), n.tolist(), strict=True)])
            columns = [rows["doc_id"], *(pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:6]), pa.array([o[6] for o in out], pa.string())]
            names = [c.split()[0] for c in ALIGNED.split(", ")]
            if with_pairs:
                columns += [rows["row"], pa.array(links, pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))]
                names += ["row", "links"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def aligned(docs: DataFrame, tokenizers: tuple[str, str] | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``tokenizers`` are the paths of a byte-level ``tokenizers`` file and of a ``sentencepiece`` model, by default
    public_tokenizers' byte_bpe_50k.json and piece_bpe_32k.model. Texts that are null, empty or not given back by their tokens
    have zeros and an empty digest and give no links. Repeated rows count again in the counts of pairs.
    No documents give no rows. Other columns are not read. A task holds about a megabyte of texts, or
    one longer text, with their units, besides a bounded memory of units.

    Counts of pairs go to all tasks while there are at most ``broadcast_pairs``; more are met in a join of the
    pairs of every document, whose sums are taken by row.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stages = Stages(spark, "alignment")
    counts = stages.save(pair_counts(docs, tokenizers), "counts")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if counts.count() <= broadcast_pairs:
        found = counts.toArrow().sort_by("pair")
        n, best = found["n"].to_numpy(), found["best"].to_numpy()
        shared = Shared(uuid.uuid4().hex, spark.sparkContext.broadcast((found["pair"].to_numpy(), np.where(best, -n, n))))
        return texts.mapInArrow(_described(tokenizers, shared, False), ALIGNED)
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    with_links = ALIGNED + ", row long, links array<struct<pair: long, times: long>>"
    described = stages.save(numbered.mapInArrow(_described(tokenizers, None, True), with_links), "described")
    links = described.select("row", F.explode("links").alias("link")).select("row", "link.*").join(counts, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    told = described.drop("n_best", "count_sum", "links").join(stages.save(sums, "sums"), "row", "left").na.fill(0, ["n_best", "count_sum"])
    return told.select(*(c.split()[0] for c in ALIGNED.split(", ")))
