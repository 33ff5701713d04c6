"""License paragraphs, whole and damaged, and the secret models' precision and recall on strings they were not trained on."""

import random
import string

import pytest
from pyspark.sql import functions as F

from askquarry.llm import licenses, secrets

TEXTS = "doc_id long, text string"


def test_templates_hold_every_word():
    for label, text in licenses.PARAGRAPHS:
        parts = licenses.templates([(label, text)])
        assert " ".join(t for _, t in parts) == text and {x for x, _ in parts} == {label}
        assert all(2 <= len(t.split()) <= licenses.TEMPLATE_WORDS for _, t in parts)


def test_every_paragraph_is_found_and_half_a_one_too(spark):
    rng, rows, want = random.Random(8), [], []
    for label, text in licenses.PARAGRAPHS:
        words = text.split()
        damaged = [w for w in words if rng.random() > 0.04]
        halves = [words[: len(words) // 2], words[len(words) // 2 :]] if len(words) > 4 * licenses.TEMPLATE_WORDS else []
        for own in (words, damaged, *halves):
            rows.append((len(rows), "some words before. " + " ".join(own).capitalize() + ", and some after"))
            want.append(label)
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(spark.createDataFrame(rows, TEXTS)).collect()}
    assert [k for k, label in enumerate(want) if label not in got[k]] == []


def test_common_wording_is_no_license(spark):
    texts = ["the software is provided to any person in the hope that it will be useful for any purpose", "you may use a copy of the work and share it with the public", "see the license for more details"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect()
    assert all(r["labels"] == "" and r["score"] == 0 for r in got)


@pytest.fixture(scope="module")
def names(spark):
    words = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
    vocabulary = sorted(r["w"] for r in words.groupBy("w").count().where("length(w) between 3 and 9 and count >= 20").collect())
    rng = random.Random(9)

    def name():
        own = [rng.choice(vocabulary) for _ in range(rng.randint(2, 4))]
        return rng.choice(["_".join(own), "-".join(own), "/".join(own), own[0] + "".join(map(str.title, own[1:])), "_".join(own).upper(), "_".join(own) + str(rng.randint(1, 999))])

    return [n for n in (name() for _ in range(3000)) if len(n) >= 12]


def found(spark, strings):
    rows = secrets.scan(spark.createDataFrame(list(enumerate(strings)), TEXTS))
    return sum(r["n"] for r in rows.select(F.exists("spans", lambda s: s["kind"] == "markov").cast("int").alias("n")).collect())


def test_precision_and_recall_on_unseen_strings(spark, names):
    rng = random.Random(10)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    tokens = [draw(string.ascii_letters + string.digits, rng.randint(20, 44)) for _ in range(2000)]
    hits, false = found(spark, tokens), found(spark, names)
    print("recall", hits / len(tokens), "flagged names", false / len(names))
    assert hits >= 0.9 * len(tokens) and false <= 0.02 * len(names)
    letters = [draw(string.ascii_lowercase, 24) for _ in range(1000)]
    short = [draw(string.ascii_letters + string.digits, 19) for _ in range(1000)]
    print("letters alone", found(spark, letters) / 1000, "19 characters", found(spark, short) / 1000)
    assert found(spark, letters) >= 850 and found(spark, short) >= 850
