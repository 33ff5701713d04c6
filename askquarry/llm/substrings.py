"""Removal of repeated word windows (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.llm import rolling
from askquarry.llm.common import Stages, partitions, text_key
from askquarry.session import ship_package

WINDOW = 35
#: Bytes of text whose windows are packed together; about a seventh as many windows.
CHUNK_BYTES = 6_000_000
#: Windows that one counting task holds, on average at most.
TASK_WINDOWS = 4_000_000
#: Bytes of the first hash that are sent; the bucket holds bits of the second one.
HASH_BYTES = 7

# Kinds of rows between the steps.
HASHES, DIRECTORY = 0, 1
ROWS = "bucket int, kind int, chunk long, a binary, b binary"


def _deltas(numbers: np.ndarray) -> bytes:
    """Rising numbers as differences, in two bytes each where they fit."""
    steps = np.diff(numbers, prepend=0)
    narrow = not len(steps) or steps.max() < 1 << 16
    return bytes([int(narrow)]) + steps.astype("<u2" if narrow else "<u4").tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2" if data[0] == 1 else "<u4", offset=1).astype(np.int64))


def _windows(window: int, buckets: int):
    """Rabin-Karp hashes of every window, packed by bucket.

    For each chunk of texts: rows of HASHES with the hashes of one bucket (a) and the numbers of their
    windows in the chunk (b), and one of DIRECTORY with the texts' keys (a) and, as b, their numbers of
    windows, followed by the windows that repeat inside the chunk. Of those one goes out for all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for rows, texts in rolling.text_groups(batches, CHUNK_BYTES):
            words, counts = rolling.grouped_words(texts)
            per_text = np.maximum(counts - window + 1, 0)
            total = int(per_text.sum())
            if not total:
                continue
            first_word, first = np.cumsum(counts) - counts, np.cumsum(per_text) - per_text
            starts = np.arange(total) + np.repeat(first_word - first, per_text)
            h = rolling.window_hashes(words, window, rolling.BASES[1])[starts]
            order = np.argsort(h, kind="stable")
            ranked = h[order]
            fresh = np.append(True, ranked[1:] != ranked[:-1])
            repeated = ~fresh | np.append(~fresh[1:], False)
            local = np.sort(order[repeated])
            sent = np.sort(order[fresh])
            g = rolling.window_hashes(words, window, rolling.BASES[2])[starts[sent]]
            bucket = (g % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            sent, bucket = sent[by], bucket[by]
            data = h[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            keys = np.stack([rows["k1"].to_numpy(), rows["k2"].to_numpy()], 1).astype("<i8").tobytes()
            head = len(texts).to_bytes(4, "little") + per_text.astype("<u4").tobytes()
            out = [(int(chunk % buckets), DIRECTORY, chunk, keys, head + _deltas(local))]
            out += [(int(bucket[i]), HASHES, chunk, data[i:j].tobytes(), _deltas(sent[i:j])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            for k in range(0, len(out), 200):
                part = list(zip(*out[k : k + 200], strict=True))
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names=["bucket", "kind", "chunk", "a", "b"])
            chunk += 1

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition of whole buckets: each chunk's windows whose hash came more than once, as b; directories as they are."""
    rows = []
    for batch in batches:
        kind = batch["kind"]
        passed = batch.filter(pa.compute.equal(kind, DIRECTORY))
        if passed.num_rows:
            yield passed.select(["kind", "chunk", "a", "b"])
        hashes = batch.filter(pa.compute.equal(kind, HASHES))
        rows += zip(hashes["bucket"].to_pylist(), hashes["chunk"].to_pylist(), hashes["a"].to_pylist(), hashes["b"].to_pylist(), strict=True)
    if not rows:
        return
    sizes = [len(a) // HASH_BYTES for _, _, a, _ in rows]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, HASH_BYTES)
    # buckets of one partition are told apart by the free byte
    wide[:, HASH_BYTES] = np.repeat(np.array([r[0] % 251 for r in rows], np.uint8), sizes)
    keys = wide.view("<u8").ravel()
    order = np.argsort(keys)
    ranked = keys[order]
    again = np.append(False, ranked[1:] == ranked[:-1])
    again |= np.append(again[1:], False)
    found = np.zeros(len(keys), bool)
    found[order] = again
    at, out = 0, []
    for (_, chunk, _, numbers), size in zip(rows, sizes, strict=True):
        hit = found[at : at + size]
        if hit.any():
            out.append((HASHES, chunk, b"", _deltas(_numbers(numbers)[hit])))
        at += size
    for k in range(0, len(out), 2000):
        part = list(zip(*out[k : k + 2000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["kind", "chunk", "a", "b"])


def _intervals(window: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["kind"] == DIRECTORY].iloc[0]
        n = int.from_bytes(head["b"][:4], "little")
        per_text = np.frombuffer(head["b"], "<u4", n, 4).astype(np.int64)
        keys = np.frombuffer(head["a"], "<i8").reshape(-1, 2)
        hit = np.zeros(per_text.sum(), bool)
        hit[_numbers(head["b"][4 + 4 * n :])] = True
        for data in group.loc[group["kind"] == HASHES, "b"]:
            hit[_numbers(data)] = True
        ends, out = np.cumsum(per_text), []
        at = np.flatnonzero(hit)
        cuts = np.searchsorted(at, np.append(0, ends))
        for k in np.flatnonzero(np.diff(cuts)):
            starts = at[cuts[k] : cuts[k + 1]] - (ends[k] - per_text[k])
            breaks = np.flatnonzero(np.diff(starts) > window)
            firsts = np.append(starts[0], starts[breaks + 1])
            lasts = np.append(starts[breaks], starts[-1]) + window
            out.append((keys[k, 0], keys[k, 1], firsts, lasts))
        return pd.DataFrame(out, columns=["k1", "k2", "starts", "ends"])

    return run


def repeated_spans(docs: DataFrame, stages: Stages, window: int = WINDOW) -> DataFrame:
    """(k1, k2, starts, ends): by text key, the maximal word intervals [start, end) that repeated windows cover.

    A window repeats when its words also start anywhere else, in the same text too. Windows count as equal by parts of two
    Rabin-Karp hashes: the second one's bucket says which task counts it, seven bytes of the first are sent. Words are
    not compared, so among very many windows (some 10**13) a few different ones may be taken for equal. Rows hold the hashes of a chunk of texts for one bucket, and equal windows of a chunk go once,
    so a passage that all texts share costs one hash per chunk. Texts without repeats have no row.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.col("text").cast("string")
    sized = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(partitions(spark), -(-sized // (6 * TASK_WINDOWS)))
    hashes = docs.select(*text_key(text), text.alias("text")).mapInArrow(_windows(window, 4 * tasks), ROWS)
    counted = hashes.repartition(tasks, "bucket").mapInArrow(_repeated, "kind int, chunk long, a binary, b binary")
    spans = counted.groupBy("chunk").applyInPandas(_intervals(window), "k1 long, k2 long, starts array<int>, ends array<int>")
    spans = stages.save(spans.dropDuplicates(["k1", "k2"]), "spans")
    stages.release()
    return spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, starts, ends in zip(batch["text"], batch["starts"].to_pylist(), batch["ends"].to_pylist(), strict=True):
            # bytes are split at ASCII white space only
            words = (text.as_py() or "").encode().split()
            n, removed = len(words), 0
            if starts:
                kept, at = [], 0
                for start, end in zip(starts, ends, strict=True):
                    kept += words[at:start]
                    removed += end - start
                    at = end
                words = kept + words[at:]
            out.append((n, removed, b" ".join(words).decode()))
        columns = list(zip(*out, strict=True)) if out else ([], [], [])
        arrays = [batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text.

    Words are divided by ASCII white space, kept ones joined by one space; a null text has none. All windows
    are judged on the input. Copies and repeated rows lose all that a window covers; texts of fewer
    words than a window lose nothing. Other columns are not read; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "substrings")
    spans = repeated_spans(docs, stages, window)
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long"), text.alias("text"), *text_key(text))
    found = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "starts", "ends")
    return found.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text string")
