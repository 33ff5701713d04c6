"""The block step of the embedding operator, without Spark: its rows join what all near vectors of a bucket join."""

import numpy as np
import pyarrow as pa
import pytest

from askquarry.llm import near_dup
from askquarry.llm import vector_dup as vd


def components(n, links):
    root = list(range(n))
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    return root


def block_rows(vectors, block, order):
    """One bucket's rows for every pair of its blocks, as ``near_vectors`` deals them."""
    blocks = -(-len(vectors) // block)
    rows = []
    for k in order:
        own = k % blocks
        for other in range(blocks):
            task = {"i": min(own, other), "j": max(own, other), "side": 1 if other >= own else 2}
            rows.append({"dims": vectors.shape[1], "t": 0, "cell": 0, **task, "node": k, "vector": vectors[k].tolist(), "copies": 1, "signature": [0]})
    return sorted(rows, key=lambda r: (r["i"], r["j"]))


def star(n):
    # a centre and rays that are near to it but not to each other
    rays = np.hstack([np.full((n, 1), 0.93), 0.36 * np.eye(n)])
    return np.vstack([np.eye(1, n + 1), rays])


def chain(n):
    angles = np.arange(n) * 0.4
    return np.stack([np.cos(angles), np.sin(angles)], 1)[: int(np.pi / 0.4) * 2 - 1]


@pytest.mark.parametrize("shape", [star, chain])
@pytest.mark.parametrize("seed", range(6))
def test_rows_join_all_near_vectors(monkeypatch, shape, seed):
    monkeypatch.setattr(near_dup, "PAIRS", 3)
    rng = np.random.default_rng(seed)
    vectors = rng.permutation(shape(14))
    n = len(vectors)
    rows = block_rows(vectors, 5, rng.permutation(n).tolist())
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 7]) for k in range(0, len(rows), 7)]
    out = [r for b in vd._compared(vd.Stable())(iter(batches)) for r in b.to_pylist()]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = [(a, b) for a in range(n) for b in range(a) if unit[a] @ unit[b] >= 0.9]
    assert components(n, [(r["a"], r["b"]) for r in out]) == components(n, near)
    links = np.zeros(n, int)
    for r in out:
        links[r["a"]] += r["links"]
    assert links.tolist() == [sum(k in pair for pair in near) for k in range(n)]


def test_a_link_seen_before_a_smaller_neighbour_is_kept(monkeypatch):
    """Of the blocks {1, 0} and {2}: 1 and 2 are near, then 0 and 2; 0 and 1 are not."""
    monkeypatch.setattr(near_dup, "PAIRS", 1)
    vectors = {1: [1.0, 0.36, 0.0], 0: [1.0, 0.0, 0.36], 2: [1.0, 0.0, 0.0]}
    rows = [{"dims": 3, "t": 0, "cell": 0, "i": 0, "j": 1, "side": 1 + (k == 2), "node": k, "vector": v, "copies": 1, "signature": [0]} for k, v in vectors.items()]
    out = [r for b in vd._compared(vd.Stable())(iter([pa.RecordBatch.from_pylist(rows)])) for r in b.to_pylist()]
    assert len(set(components(3, [(r["a"], r["b"]) for r in out]))) == 1
