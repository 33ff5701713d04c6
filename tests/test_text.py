"""Web page text, sentences, vectors, classes."""

import pytest
from pyspark.sql import functions as F

from askquarry.functions.text import first_sentence, html_to_text, sentences, words
from askquarry.operators.classify import class_centroids, nearest_class


def value(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a <b>b</b></p><p>c</p>", "a b\nc"),
        ("<SCRIPT>var x='<p>no</p>';</SCRIPT>x<style>p{}</style>", "x"),
        ("a<!-- <p>hidden</p> -->b<br/>c", "a b\nc"),
        ("1 &lt; 2 &amp;amp; &quot;q&quot;", '1 < 2 &amp; "q"'),
        ("", ""),
        (None, None),
    ],
)
def test_html(spark, html, text):
    assert value(spark, html, html_to_text) == text


def test_sentences(spark):
    assert value(spark, "One. Two?! Three\nFour 3.5 x.\n\n ", sentences) == ["One.", "Two?!", "Three", "Four 3.5 x."]
    assert value(spark, " ", first_sentence) == ""
    assert value(spark, None, words) is None


def test_nearest_class(spark):
    rows = spark.createDataFrame(
        [(0, [1.0, 0.0]), (0, [1.0, 0.2]), (1, [0.0, 1.0]), (2, [0.0, 0.0])], "label int, v array<float>"
    )
    centroids = class_centroids(rows, "label", "v")
    asked = spark.createDataFrame([(1, [2.0, 0.1]), (2, [0.1, 3.0]), (3, [0.0, 0.0]), (4, None)], "id int, v array<float>")
    got = {r["id"]: r["predicted"] for r in nearest_class(asked, centroids, "v").collect()}
    assert got == {1: 0, 2: 1, 3: None, 4: None}
