"""Rolling hashes of words and word windows, over many texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed together.
GROUP_BYTES = 1_000_000

# Odd multipliers, so that they have inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a base and of its inverse, modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size, both = max(n, GROUP_BYTES), []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, np.uint64)
            table[0] = 1
            both.append(np.cumprod(table))
        _POWERS[base] = (both[0], both[1])
    return _POWERS[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every input bit spread over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for every pair: the Rabin-Karp sum, by prefix sums."""
    power, inverse = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * inverse[starts]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start byte of every word; words are divided by ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = (raw == 32) | ((raw - np.uint8(9)) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = _sums(raw.astype(np.uint64) + np.uint64(1), starts, ends, BASES[0])
    return mixed(sums + (ends - starts).astype(np.uint64)), starts


def window_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return mixed(_sums(words, at, at + size, base))


def _cut(data: bytes) -> Iterator[bytes]:
    """Pieces of a long text, cut at white space."""
    at = 0
    while len(data) - at > GROUP_BYTES:
        end = max(data.rfind(c, at, at + GROUP_BYTES) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if end <= at:
            ends = [e for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (e := data.find(c, at + GROUP_BYTES)) >= 0]
            end = min(ends, default=len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def grouped_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts, one after another, and each text's number of words."""
    hashes, counts, at = [], np.zeros(len(texts), np.int64), 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) < GROUP_BYTES:
            size += len(texts[end]) + 1
            end += 1
        if end == at + 1:
            found = [word_hashes(piece)[0] for piece in _cut(texts[at])]
            counts[at] = sum(map(len, found))
            hashes += found
        else:
            found, starts = word_hashes(b"\n".join(texts[at:end]))
            firsts = np.cumsum([0, *(len(t) + 1 for t in texts[at : end - 1])])
            cuts = np.append(np.searchsorted(starts, firsts), len(starts))
            counts[at:end] = np.diff(cuts)
            hashes.append(found)
        at = end
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def text_groups(batches: Iterator[pa.RecordBatch], limit: int, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches of about ``limit`` bytes of text, with the texts' bytes; null is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, end - at), [v or b"" for v in column.slice(at, end - at).to_pylist()]
            at = end
