"""Chunking: edge rows and properties."""

import random

import pytest
from pyspark.sql import functions as F

from askquarry.operators.chunking import chunk_documents, chunkless, window_chunks, with_chunk_id, within_budget
from askquarry.plans.ingest import chunk_table


def docs(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "url string, content string")


def numbered(n):
    return " ".join(f"w{i}" for i in range(n))


@pytest.mark.parametrize("n, chunks", [(1, 1), (500, 1), (501, 2), (510, 2), (990, 2), (991, 3), (1480, 3), (1481, 4)])
def test_window_counts(spark, n, chunks):
    assert chunk_documents(docs(spark, [numbered(n)])).count() == chunks


@pytest.mark.parametrize("method", ["window", "sentence"])
def test_no_text_no_chunks(spark, method):
    rows = docs(spark, [None, "", " \n\t ", "one."])
    assert [r["url"] for r in chunk_documents(rows, method=method).collect()] == ["3"]
    assert sorted(r["url"] for r in chunkless(rows).collect()) == ["0", "1", "2"]


def test_dropping_the_overlap_rebuilds_the_words(spark):
    sizes = [1, 9, 10, 11, 499, 500, 501, 989, 990, 991, 3333]
    rows = chunk_documents(docs(spark, [numbered(n) for n in sizes])).orderBy("url", "chunk_no").collect()
    for i, n in enumerate(sizes):
        parts = [r["content"].split(" ") for r in rows if r["url"] == str(i)]
        assert all(len(p) <= 500 for p in parts)
        assert all(a[-10:] == b[:10] for a, b in zip(parts, parts[1:]))
        assert parts[0] + [w for p in parts[1:] for w in p[10:]] == numbered(n).split(" ")


def test_overlap_must_be_below_size(spark):
    with pytest.raises(ValueError):
        window_chunks(F.lit("a"), 5, 5)


def expected_sentences(text, size, overlap):
    """The packing rule, written plainly."""
    pieces = []
    for s in text.replace(". ", ".\n").split("\n"):
        w = s.split()
        pieces += [w[i : i + size] for i in range(0, len(w), size)]
    chunks, current = [], []
    for p in pieces:
        if current and sum(map(len, current)) + len(p) > size:
            chunks.append(current)
            room, tail = min(overlap, size - len(p)), []
            for q in reversed(current):
                if sum(map(len, tail)) + len(q) > room:
                    break
                tail.insert(0, q)
            current = tail
        current = current + [p]
    if current:
        chunks.append(current)
    return [" ".join(w for p in c for w in p) for c in chunks]


@pytest.mark.parametrize("size, overlap", [(20, 5), (20, 0), (7, 6), (500, 10)])
def test_sentences_follow_the_packing_rule(spark, size, overlap):
    rng = random.Random(size * 100 + overlap)
    texts = []
    for _ in range(25):
        lengths = [rng.choice([1, 2, 3, 5, 8, 19, 20, 21, 45]) for _ in range(rng.randint(1, 40))]
        texts.append(" ".join(" ".join(f"x{rng.randint(0, 99)}" for _ in range(n)) + "." for n in lengths))
    rows = chunk_documents(docs(spark, texts), method="sentence", size=size, overlap=overlap).collect()
    for i, text in enumerate(texts):
        got = [r["content"] for r in sorted((r for r in rows if r["url"] == str(i)), key=lambda r: r["chunk_no"])]
        assert got == expected_sentences(text, size, overlap)
        assert all(len(c.split(" ")) <= size for c in got)


def test_ids_are_stable_and_unique(spark):
    rows = docs(spark, [numbered(2000), numbered(700)])
    first, second = (
        sorted((r["id"], r["url"], r["chunk_no"]) for r in with_chunk_id(chunk_documents(rows)).collect())
        for _ in range(2)
    )
    assert first == second and len({r[0] for r in first}) == len(first)


def test_budget_keeps_the_leading_rows(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 1, 11)], "g string, rank int, n int"
    )
    kept = within_budget(rows, "g", "rank", "n", 10).collect()
    assert sorted((r["g"], r["rank"]) for r in kept) == [("a", 1), ("a", 2)]


def test_chunk_table_is_one_stage(spark):
    plan = chunk_table(docs(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
