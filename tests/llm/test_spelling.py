"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from askquarry.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, prefix string"


def brute_words(rows):
    found = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    out, form = {}, {}
    for w, n in words.items():
        beside = [v for v in words if v != w and near(v, w)]
        best = min(beside, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
        out[w] = [n, len(beside)]
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, form.get(w), root, *out[w], words.get(form.get(w)))
    return sorted(out.values())


def made_up():
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 9))) for _ in range(12)]
    texts = [None, "", "short words only", "Aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaaaaa", "ÀÉÀÉÀÉÀ àéàéàéà ÀÉÀÉÀÉÀ àéàéàéà ×÷×÷×÷× ×÷×÷×÷×"]
    # a chain of forms: 300, 30, 3 and 2 occurrences
    texts += [" ".join(["letterbox"] * 300), " ".join(["leterbox"] * 30), " ".join(["lterbox"] * 3), "lterbo lterbox1lterbo"]
    for _ in range(150):
        words = []
        for stem in rng.choices(stems, weights=[2.0**-k for k in range(len(stems))], k=rng.randint(1, 40)):
            word = list(stem)
            if rng.random() < 0.3:
                at = rng.randrange(len(word))
                word[at : at + 1] = rng.choice([[], [rng.choice("abcé")], [word[at], rng.choice("abcé")]])
            words.append("".join(word).upper() if rng.random() < 0.1 else "".join(word))
        texts.append(rng.choice([" ", "\n", "-", "1"]).join(words))
    rows = [(k, t, "x", 1, "y$x") for k, t in enumerate(texts)]
    return [*rows, rows[5], (None, texts[-1], "x", 1, None), (None, None, None, None, None)]


ROWS = made_up()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_variants_equal_brute_force(docs):
    got = sorted(tuple(r) for r in spelling.variants(docs).collect())
    want = brute(ROWS)
    assert len(want) > 100 and any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)
    assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_no_documents(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_counting_task_passes_on_what_it_holds(docs, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    rows = docs.coalesce(1).select("doc_id", "text").collect()
    got = Counter()
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows])
    for part in spelling._counted(iter([batch])):
        for word, n in zip(part["word"].to_pylist(), part["n"].to_pylist(), strict=True):
            got[word] += n
    assert {w: n for w, n in got.items() if n >= 2} == brute_words(ROWS)


def test_very_frequent_words_do_not_make_large_groups(spark):
    words = spark.createDataFrame([("aaaaaaa" + chr(c), 10**12) for c in range(ord("a"), ord("z") + 1)] + [("aaaaaaa", 1)], "word string, n long")
    found = {r["word"]: r for r in spelling.near_words(words).collect()}
    assert found["aaaaaaa"]["n_near"] == 26 and found["aaaaaaa"]["near"] == "aaaaaaaa"
    assert found["aaaaaaab"]["n_near"] == 26 and found["aaaaaaab"]["near"] == "aaaaaaaa"
    largest = spelling.rotations(words).groupBy("prefix").count().agg(F.max("count")).first()[0]
    assert largest == 27


def test_registered_query_over_whole_table(spark, sf_dir):
    from askquarry.llm.queries import QUERIES

    found = QUERIES["op11_spelling_variants"](spark, sf_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    words = brute_words(rows)
    beside = {}
    for w in words:  # all edits of one letter that are words too
        alphabet = {c for v in words for c in v}
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in alphabet} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet}
        beside[w] = sorted((v for v in edits - {w} if v in words), key=lambda v: (-words[v], v)) if len(beside) < 1500 else None
    got = {r["word"]: r for r in found.collect()}
    assert {w: r["n"] for w, r in got.items()} == words
    for w, others in beside.items():
        if others is not None:
            form = others[0] if others and words[others[0]] >= 10 * words[w] else None
            assert (got[w]["n_near"], got[w]["form"], got[w]["form_n"]) == (len(others), form, words.get(form))
