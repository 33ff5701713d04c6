"""Plug-in stages: batching, order, errors, extraction."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from askquarry.functions.hashing import hash_embed
from askquarry.operators.chunking import chunk_documents, explode_chunks
from askquarry.operators.plugins import embed_texts, extract_text, generate_texts, split_texts, utf8_pages
from askquarry.plans import standins
from askquarry.plans.standins import hash_model


def sized_model(log):
    def factory():
        def call(texts):
            with open(log, "a") as out:
                out.write(f"{len(texts)}\n")
            return [[float(len(t))] for t in texts]

        return call

    return factory


def test_batches_cross_arrow_batches(spark, tmp_path):
    log = str(tmp_path / "sizes")
    df = spark.range(1000, numPartitions=1).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = embed_texts(df, "t", sized_model(log), "m", 1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [int(n) for n in open(log)] == [150] * 6 + [100]
    assert [r["embedding"] for r in rows] == [[float(i)] for i in range(1000)]


def test_null_texts_are_not_sent(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "ccc")], "id int, t string").coalesce(1)

    def factory():
        return lambda texts, max_tokens: [t.upper()[:max_tokens] for t in texts]

    rows = generate_texts(df, "t", factory, max_tokens=2).orderBy("id").collect()
    assert [(r["id"], r["answer"]) for r in rows] == [(1, "A"), (2, None), (3, "CC")]


@pytest.mark.parametrize("broken", [lambda texts, n: [1 / 0 for _ in texts], lambda texts, n: []])
def test_model_errors_fail_the_task(spark, broken):
    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(PythonException):
        generate_texts(df, "t", lambda: broken).collect()


def test_plugged_in_model_equals_the_built_in(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "é\tx\ny"), (3, "")], "id int, t string")
    ours = {r["id"]: r["embedding"] for r in hash_embed(df, "t").collect()}
    theirs = {r["id"]: r["embedding"] for r in embed_texts(df, "t", hash_model, "m", 64).collect()}
    assert ours == theirs and ours[3] == [0.0] * 64


def test_one_bad_document_leaves_the_others(spark):
    rows = [("a", b"one\ftwo"), ("b", b"\xff\xfe"), ("c", None), ("d", "grün".encode())]
    df = spark.createDataFrame(rows, "url string, content binary")
    got = {r["url"]: r for r in extract_text(df, "content", utf8_pages).collect()}
    assert got["a"]["text"] == "one\ntwo" and got["a"]["error"] is None
    assert got["d"]["text"] == "grün"
    assert got["b"]["text"] is None and got["b"]["error"].startswith("UnicodeDecodeError")
    assert got["c"]["text"] is None and got["c"]["error"]
    texts = extract_text(df, "content", utf8_pages).withColumnRenamed("text", "content")
    assert sorted({r["url"] for r in chunk_documents(texts).collect()}) == ["a", "d"]


def test_splitter_plugin(spark):
    df = spark.createDataFrame([("a", "x;y"), ("b", None)], "url string, t string")
    split = split_texts(df, "t", lambda: lambda text: text.split(";"))
    rows = explode_chunks(split.drop("t"), "chunks").collect()
    assert [(r["url"], r["chunk_no"], r["content"]) for r in rows] == [("a", 0, "x"), ("a", 1, "y")]


def test_built_in_model_hashes_a_repeated_word_once(monkeypatch):
    hashed, md5 = [], standins.hashlib.md5
    monkeypatch.setattr(standins.hashlib, "md5", lambda word: hashed.append(word) or md5(word))
    model = hash_model()
    assert model(["a b a", "b a\tb"]) == model(["b a a", "a b b"])
    assert len(hashed) == 2


def test_reading_model_takes_lines_and_stops_apart_without_a_pattern_per_line(monkeypatch):
    """Gaps of all kinds end sentences as before; only the question and the sentence told go through the word pattern."""
    split, patterns = [], standins.WORD_BREAKS
    monkeypatch.setattr(standins, "WORD_BREAKS", type("Counted", (), {"split": lambda self, text: split.append(text) or patterns.split(text)})())
    documents = "One two.\tThree  four!? five\rsix\tseven \f . eight.nine\x0bten\n\n \t\n?"
    prompt = "Documents: {}\nQuestion: {}".format
    told = {
        "two": "One two.",
        "Three": "Three four!?",
        "five": "five",
        "six  seven": "six seven",
        "eight.nine\x0bten": "eight.nine\x0bten",
        ".": ".",
        "none": "One two.",
        "": "One two.",
    }
    answers = standins.reading_model()(["\n" + prompt(documents, q) for q in told], 200)
    assert answers == list(told.values())
    assert len(split) <= 2 * len(told)
    assert standins.reading_model()(["\n" + prompt(" \t\r\f\n", "two")], 2) == ["I do"]
