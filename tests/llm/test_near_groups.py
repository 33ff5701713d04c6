"""The block step of the near-duplicate operator, without Spark: its links join what all similar pairs join."""

import numpy as np
import pyarrow as pa
import pytest

from askquarry.llm import near_dup as nd


def roots(n, links):
    root = list(range(n))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root


@pytest.mark.parametrize("near", [nd.WORDS_3, nd.WORDS_5])
def test_links_of_a_group_join_all_similar_texts(near):
    rng = np.random.default_rng(11)
    sets = []
    for family in range(4):
        own = rng.integers(0, 1 << 63, 400, np.uint64)
        for k in range(12):  # a chain: neighbours are similar, the ends are not
            own = own.copy()
            own[rng.choice(400, 10 + 5 * family, replace=False)] = rng.integers(0, 1 << 63, 10 + 5 * family, np.uint64)
            sets.append(np.unique(own))
    sketches = [nd.registers(s, near) for s in sets]
    rows = []
    for node, sketch in enumerate(sketches):
        for band in range(near.bands):
            key = hash(sketch[band * near.rows : (band + 1) * near.rows].tobytes() + bytes([band]))
            rows.append({"bucket": key, "band": band, "node": node, "n": len(sets[node]), "comp": node, "regs": sketch.tobytes(), "i": 0, "j": 0, "what": 1, "side": 1, "elements": sets[node].tobytes()})
    rows.sort(key=lambda r: (r["bucket"], r["node"]))
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 37]) for k in range(0, len(rows), 37)]
    paired = [b for b in nd._paired(near)(iter(batches))]
    links = [(r["a"], r["b"]) for b in nd._joined(near)(iter(paired)) for r in b.to_pylist()]
    everything = [(a, b) for a in range(len(sets)) for b in range(a) if nd._similar(sets[a], sets[b], near)]
    assert all(nd._similar(sets[a], sets[b], near) for a, b in links)
    assert len(everything) > len(sets) and roots(len(sets), links) == roots(len(sets), everything)
    assert len(links) < sum(b.num_rows for b in paired)
