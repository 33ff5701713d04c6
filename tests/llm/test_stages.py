"""The rows that each stage of the pipeline keeps, against brute force, on tables of files and on other plans."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_operators import LOWER, ROWS, SCHEMA, ordered, split

import corpus_pipeline
from askquarry.llm import exact_dup, mixing, near_dup, quality
from askquarry.llm.common import numbered

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", params=["files", "plan"])
def docs(request, spark, tmp_path_factory):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    if request.param == "plan":
        return rows
    path = str(tmp_path_factory.mktemp("rows") / "documents")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def newest(row):
    return (row[0] is not None, row[0] or 0)


def test_rows_are_named_once(docs):
    named = numbered(docs)
    rows, again = named.collect(), named.repartition(5).collect()
    assert len({r["row"] for r in rows}) == len(ROWS)
    assert {r["row"]: r["doc"] for r in rows} == {r["row"]: r["doc"] for r in again}
    copied = any("-documents" in f or "documents-" in f for f in named.inputFiles() if "askquarry-tests" in f)
    assert copied == bool(docs._jdf.queryExecution().analyzed().children().size())


def test_exact_rows_kept(docs):
    groups = defaultdict(list)
    for row in ROWS:
        groups[(row[1] or "").translate(LOWER)].append(row)
    assert ordered(exact_dup.deduplicated(docs).collect()) == ordered(max(g, key=newest) for g in groups.values())


def test_near_rows_kept(docs):
    def shingles(text):
        words = split((text or "").translate(LOWER))
        return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])

    sets = [shingles(row[1]) for row in ROWS]
    root = list(range(len(ROWS)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    groups = defaultdict(list)
    for k, row in enumerate(ROWS):
        groups[top(k)].append(row)
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert ordered(near_dup.deduplicated(docs).collect()) == ordered(want)


def test_accepted_are_the_documents_above_the_bound(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).collect() if r["score"] >= 0.3}
    kept = quality.accepted(docs, labels).collect()
    assert ordered(kept) == ordered(r for r in docs.collect() if r["doc_id"] in good)


def test_mixed_rows_are_the_account(docs):
    account = Counter()
    for r in mixing.taken_words(docs).collect():
        account[(r["doc_id"], r["size"])] += r["taken"]
    mixed = mixing.mix(docs).collect()
    got = Counter()
    for r in mixed:
        got[(r["doc_id"], len(split(r["text"])))] += len(split(r["text"]))
    assert +got == +account
    assert {tuple(r) for r in mixed} <= set(ROWS)


def test_words_taken_come_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.taken_words(docs, chunk_rows=100)
    sums = defaultdict(lambda: [0, 0.0, 0])
    for r in rows.collect():
        own = sums[(r["source_size"], round(r["target"], 3))]
        own[0], own[1], own[2] = own[0] + r["taken"], r["target"], max(own[2], r["size"])
    assert all(abs(taken - target) <= 0.01 * target + 50 for taken, target, _ in sums.values())


def test_repeated_rows_are_spread_over_chunks(spark, tmp_path):
    path = str(tmp_path / "equal")
    spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("some equal words").alias("text"), F.when(F.col("id") < 2990, "a").alias("source")).coalesce(1).write.parquet(path)
    rows = mixing._sized(numbered(spark.read.parquet(path)).select("row", "at", "doc.*"), 23)
    assert rows.select("key").distinct().count() == 1
    dealt = rows.groupBy(F.pmod(F.xxhash64(F.lit(23), "key", "at"), F.lit(30)).alias("c")).count()
    assert dealt.agg(F.max("count")).first()[0] < 200
    got = mixing.taken_words(spark.read.parquet(path), chunk_rows=100).collect()
    assert len(got) == 3000 and ordered(got) == ordered(mixing.taken_words(spark.read.parquet(path), chunk_rows=100).collect())


def run_on(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_on_nulls_and_nothing(spark, tmp_path):
    labels = [(k, k % 2, 0) for k in range(60)]
    rows = [r[:5] for r in ROWS if len(r[1] or '') < 3000] + [(None, None, None, None, None)]
    assert {r["doc_id"] for r in run_on(spark, tmp_path / "some", rows, labels)} <= {r[0] for r in rows}
    assert run_on(spark, tmp_path / "none", [], []) == []
