"""Toxic passages: segments against brute force, and accuracy on rows that were never learnt from."""

import random
import zlib

import numpy as np
import pytest

from askquarry.llm import toxicity

SCHEMA = "doc_id long, text string, toxic string, score string, doc string, passages string"


def brute_segments(scores):
    """Every segment by its definition: take the best, then the same left and right of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    found = [(-(s := sum(scores[i:j])), j - i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    best, _, i, j = min(found)
    return [*brute_segments(scores[:i]), (i, j, -best), *((a + j, b + j, s) for a, b, s in brute_segments(scores[j:]))]


def test_maximal_segments_equal_their_definition():
    rng = random.Random(5)
    for _ in range(150):
        # distinct powers keep sums from tying
        scores = [rng.choice([-1, 1]) * rng.random() for _ in range(rng.randint(0, 14))]
        start, end, score = toxicity.maximal_segments(np.array(scores, float))
        want = brute_segments(scores)
        assert list(zip(start.tolist(), end.tolist(), strict=True)) == [w[:2] for w in want]
        assert np.allclose(score, [w[2] for w in want])


def test_scan_is_linear():
    scores = np.tile([1.0, -1.5], 200_000)
    assert len(toxicity.maximal_segments(scores)[0]) == 200_000
    rising = np.tile([2.0, -1.0], 200_000)
    assert toxicity.maximal_segments(rising)[2].tolist() == [200_001.0]


def test_evidence_grows_with_segments_and_falls_with_length():
    one = toxicity.evidence(np.array([9.0]), 100, 1.0, 0.1)
    assert toxicity.evidence(np.array([9.0, 8.0]), 100, 1.0, 0.1) > one > toxicity.evidence(np.array([9.0]), 10_000, 1.0, 0.1)
    assert toxicity.evidence(np.array([]), 0, 1.0, 0.1) == 0.0


def made_up():
    rng = random.Random(2)
    neutral = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6))) for _ in range(200)]
    bad = ["vile", "rotten", "filth"]
    rows, labels = [], []
    for k in range(600):
        words = [rng.choice(neutral) for _ in range(rng.randint(5, 120))]
        toxic = k % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(bad, k=3)
        rows.append((k, " ".join(words).upper() if k % 7 == 0 else ", ".join(words), "0", "s", "d", "p"))
        labels.append((k, int(toxic)))
    labels += [(0, 1), (1, None), (2, 7), (None, 1), (5000, 1)]
    long = " ".join(rng.choice(neutral) for _ in range(30_000))
    extra = [(700, None), (701, ""), (702, "1 2 3"), (703, long), (704, long + " vile rotten filth vile rotten " + long), (None, "vile rotten filth"), (705, "filth"), (1, rows[1][1])]
    return rows + [(i, t, "1", None, None, None) for i, t in extra], labels


ROWS, LABELS = made_up()


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3), spark.createDataFrame(LABELS, "doc_id long, toxic int")


def test_passages_and_rows(tables):
    got = toxicity.toxic_passages(*tables).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    truth = dict(LABELS[:600])
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) >= 0.98 * len(tested)
    assert by_id[700]["score"] == by_id[701]["score"] == by_id[702]["score"] < 0.3 and by_id[700]["passages"] == []
    assert by_id[703]["predicted"] == 0 and by_id[704]["predicted"] == 1
    (passage,) = by_id[704]["passages"]
    assert (passage["first_word"], passage["last_word"]) == (30_000, 30_004)
    twice = [r["score"] for r in got if r["doc_id"] == 1]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_without_labels_or_documents(spark, tables):
    docs, labels = tables
    assert {round(r["score"], 6) for r in toxicity.toxic_passages(docs, labels.limit(0)).collect()} == {0.01}
    assert toxicity.toxic_passages(docs.limit(0), labels).collect() == []


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, tables):
    docs, labels = tables
    flipped = [(i, y if i is None or zlib.crc32(str(i).encode()) % 4 != 2 else 1 - (y or 0)) for i, y in LABELS]
    other = spark.createDataFrame(flipped, "doc_id long, toxic int")
    a, b = (sorted((r["doc_id"] or -1, r["score"]) for r in toxicity.toxic_passages(docs, t).collect()) for t in (labels, other))
    assert np.allclose([x[1] for x in a], [x[1] for x in b])


def test_registered_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    from askquarry.llm.queries import QUERIES

    found = QUERIES["op12_toxicity"](spark, sf_dir)
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    tested = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    ones, zeros = ([s for s, y in tested if y == k] for k in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros]) > 0.75
