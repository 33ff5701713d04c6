"""Search: agreement of all forms with brute force, edge rows, skew, plans."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askquarry.functions.hashing import hash_embed
from askquarry.operators import cells, search
from askquarry.operators.cells import build_cells, topk_cells
from askquarry.operators.search import ModelMismatch, in_namespace, topk, topk_one, topk_records, with_payload
from workload.queries import QUERIES

DIM = 6


def table(spark, vectors, key, column):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{key} long, {column} array<float>")


def brute(corpus, queries, k, metric):
    def one(a, b):
        a, b = np.float32(a).astype(float), np.float32(b).astype(float)
        if metric == "dot":
            return round(float(a @ b), 9)
        if metric == "l2":
            return round(float(np.sqrt(((a - b) ** 2).sum())), 9)
        return round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 9)

    def whole(v):
        return v is not None and len(v) == DIM and (metric != "cosine" or any(v))

    rows = []
    for q, b in enumerate(queries):
        if not whole(b):
            continue
        scored = [(one(a, b), i) for i, a in enumerate(corpus) if whole(a)]
        scored.sort(key=lambda s: (s[0] if metric == "l2" else -s[0], s[1]))
        rows += [(q, rank, i, score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return rows


def data(seed=3, n=400, copies=150):
    """A corpus of which a third is one vector, with unusable rows among it."""
    rng = np.random.default_rng(seed)
    corpus = list(rng.normal(size=(n, DIM)))
    for i in rng.choice(n, copies, replace=False):
        corpus[i] = corpus[0]
    corpus += [None, [0.0] * DIM, [1.0] * (DIM - 1), []]
    queries = [corpus[0]] + list(rng.normal(size=(9, DIM))) + [None, [0.0] * DIM]
    return corpus, queries


def found(df):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect())


def close(got, expected):
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], atol=2e-9)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("options", [{}, {"broadcast_queries": 5}])
def test_topk_equals_brute_force(spark, metric, options):
    corpus, queries = data()
    got = topk(table(spark, corpus, "id", "values"), table(spark, queries, "qid", "vector"), 5, metric, DIM, **options)
    close(found(got), sorted(brute(corpus, queries, 5, metric)))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("block_rows", [None, 40])
def test_exact_cells_equal_brute_force(spark, metric, block_rows):
    corpus, queries = data()
    index = build_cells(table(spark, corpus, "id", "values"), DIM, 8, metric)
    got = topk_cells(index, table(spark, queries, "qid", "vector"), 5, 2, exact=True, block_rows=block_rows)
    close(found(got), sorted(brute(corpus, queries, 5, metric)))


def test_probing_all_cells_is_exact_and_fewer_cells_find_most(spark):
    corpus, queries = data(copies=0)
    index = build_cells(table(spark, corpus, "id", "values"), DIM, 8)
    asked = table(spark, queries, "qid", "vector")
    exact = sorted(brute(corpus, queries, 5, "cosine"))
    close(found(topk_cells(index, asked, 5, probes=8)), exact)
    some = {(q, i) for q, _, i, _ in found(topk_cells(index, asked, 5, probes=4))}
    recall = len(some & {(q, i) for q, _, i, _ in exact}) / len(exact)
    assert recall > 0.8


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_single_query_form(spark, metric):
    corpus, queries = data()
    got = topk_one(table(spark, corpus, "id", "values"), queries[1], 7, metric).collect()
    expected = [r for r in brute(corpus, queries, 7, metric) if r[0] == 1]
    close([(1, i, r["id"], r["score"]) for i, r in enumerate(got, 1)], expected)


def test_k_above_the_corpus_gives_all(spark):
    got = topk(table(spark, np.eye(DIM), "id", "values"), table(spark, [np.ones(DIM)], "qid", "vector"), 50, dim=DIM)
    assert [r[2] for r in found(got)] == list(range(DIM))


def test_string_ids_tie_in_code_point_order(spark):
    ids = ["b", "a", "é", "Z", "10", "9"]
    corpus = spark.createDataFrame([(i, [1.0, 2.0]) for i in ids], "id string, values array<float>")
    asked = spark.createDataFrame([("q", [2.0, 4.0])], "qid string, vector array<float>")
    for options in ({}, {"broadcast_queries": 1}):
        got = topk(corpus, asked, 3, dim=2, **options).orderBy("rank").collect()
        assert [r["id"] for r in got] == ["10", "9", "Z"]


def test_unknown_namespace_and_metric(spark):
    records = spark.createDataFrame([("a", "x")], "id string, namespace string")
    assert in_namespace(records, "y").count() == 0
    with pytest.raises(ValueError):
        topk(table(spark, [], "id", "values"), table(spark, [], "qid", "vector"), 3, "hamming", DIM)


def test_models_must_agree(spark):
    text = spark.createDataFrame([("a", "some words")], "id string, text string")
    corpus = hash_embed(text, "text", "values", 16)
    asked = hash_embed(text.withColumnRenamed("id", "qid"), "text", "vector", 32)
    with pytest.raises(ModelMismatch):
        topk(corpus, asked)


@pytest.mark.parametrize("limit", [100, 0])
def test_payload_join(spark, limit):
    matches = spark.createDataFrame([(1, 1, "a", 0.5), (2, 1, "a", 0.4)], "qid int, rank int, id string, score double")
    records = spark.createDataFrame(
        [("a", [1.0], '{"content":"text","url":"u","id":"a"}'), ("b", [2.0], "{}")],
        "id string, values array<float>, metadata string",
    )
    rows = with_payload(matches, records, include_values=True, broadcast_matches=limit).collect()
    assert sorted((r["qid"], r["url"], r["content"], r["values"]) for r in rows) == [
        (1, "u", "text", [1.0]),
        (2, "u", "text", [1.0]),
    ]
    assert with_payload(matches, records, include_metadata=False).columns == ["qid", "rank", "id", "score"]


@pytest.mark.parametrize("limit", [100, 0])
def test_one_id_in_two_namespaces(spark, limit):
    rows = [("a", n, [1.0, w], f'{{"url":"{n}"}}') for n, w in (("x", 0.0), ("y", 0.5), (None, 0.1))] + [("a\x01b", "x", [0.0, 1.0], "{}")]
    records = spark.createDataFrame(rows, "id string, namespace string, values array<float>, metadata string")
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("r", [0.0, 1.0])], "qid string, vector array<float>")
    found = with_payload(topk_records(records, asked, 3, dim=2), records, broadcast_matches=limit).collect()
    got = {(r["qid"], r["rank"]): (r["namespace"], r["id"], r["url"]) for r in found}
    assert len(found) == 6
    assert [got["q", k] for k in (1, 2, 3)] == [("x", "a", "x"), (None, "a", "None"), ("y", "a", "y")]
    assert [got["r", k][:2] for k in (1, 2, 3)] == [("x", "a\x01b"), ("y", "a"), (None, "a")]


def test_payload_lookup_moves_no_records(spark):
    from askquarry.operators.vector_table import VectorTable
    from askquarry.session import scratch_path

    store = VectorTable(spark, scratch_path(spark, "vt"))
    rows = [(str(k), [1.0, k / 50], "n", f'{{"url":"{k}"}}', None) for k in range(50)]
    store.upsert(spark.createDataFrame(rows, "id string, values array<float>, namespace string, metadata string, sparse_values struct<indices: array<int>, values: array<float>>"))
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, vector array<float>")
    found = with_payload(topk_records(store.current("n"), asked, 3, dim=2), store.current("n"))
    text = plan(found)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
    assert "In(id, [" in text
    assert sorted(r["url"] for r in found.collect()) == ["0", "1", "2"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    corpus, queries = data()
    rows = table(spark, corpus, "id", "values").withColumn("metadata", F.lit("{}"))
    asked = table(spark, queries, "qid", "vector")
    text = plan(topk(rows, asked, 5, dim=DIM))
    assert "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "metadata" not in text
    one = plan(topk_one(rows, queries[1], 5))
    assert "TakeOrderedAndProject" in one and "Exchange" not in one


def test_batches_of_queries_leave_the_corpus_where_it_is(spark, monkeypatch):
    """Every batch's plan has one exchange, that of its matches; the corpus is neither moved nor counted."""
    corpus, queries = data()
    rows, asked = table(spark, corpus, "id", "values"), table(spark, queries, "qid", "vector")
    plans, best_of = [], search.best_of
    monkeypatch.setattr(search, "best_of", lambda partial, k, metric: plans.append(plan(best_of(partial, k, metric))) or best_of(partial, k, metric))
    counted = []
    monkeypatch.setattr(type(rows), "count", lambda self, count=type(rows).count: counted.append(self.columns) or count(self))
    topk(rows, asked, 5, dim=DIM, broadcast_queries=4)
    assert len(plans) == 4 and all(p.count("Exchange") == 1 and "hashpartitioning(qid" in p for p in plans)
    assert counted == [["qid", "vector"]]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("limit", [search.BROADCAST_MATCHES, 0])
def test_codes_find_what_vectors_find(spark, monkeypatch, metric, limit):
    monkeypatch.setattr(cells, "BROADCAST_MATCHES", limit)
    corpus, queries = data(copies=0)
    index = build_cells(table(spark, corpus, "id", "values"), DIM, 8, metric)
    got = cells.topk_coded(index, table(spark, queries, "qid", "vector"), 5, probes=8, shortlist=12, block_rows=70)
    close(found(got), sorted(brute(corpus, queries, 5, metric)))


def test_first_level_reads_codes_and_the_second_few_vectors(spark):
    corpus, queries = data(copies=0)
    index = build_cells(table(spark, corpus, "id", "values"), DIM, 8)
    routed = cells._route(table(spark, queries, "qid", "vector"), index, DIM, 8, None)
    assert "values" not in plan(cells._visit(index, routed, DIM, 10, 100, coded=True)).split("ReadSchema")[1].split("\n")[0]


def test_l2_beyond_single_precision_loses_no_row(spark):
    rows = [(str(k), [float(np.float32(2e19) * (1 + k * 1e-3))] * 4) for k in range(5)]
    corpus = spark.createDataFrame(rows, "id string, values array<float>")
    asked = spark.createDataFrame([("q", rows[3][1])], "qid string, vector array<float>")
    got = topk(corpus, asked, 3, metric="l2", dim=4).orderBy("rank").collect()
    assert len(got) == 3 and got[0]["id"] == "3"


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_recall_of_the_registered_approximate_search(spark, scale):
    folder = f"/root/testdata/{scale}"
    exact, some = ({(r["qid"], r["id"]) for r in QUERIES[name](spark, folder).collect()} for name in ("topk_ivf", "topk_ivf_probed"))
    assert len(some) == len(exact) and len(some & exact) / len(exact) >= 0.9


def test_centres_are_trained_on_all_rows_unless_a_bound_is_given(spark):
    rng = np.random.default_rng(4)
    vectors = np.vstack([rng.normal(c, 0.01, (700, 2)) for c in ([0, 0], [9, 0])])
    corpus = table(spark, vectors, "id", "values")
    index = build_cells(corpus, 2, 2, "l2")
    means = np.stack([np.float32(vectors[:700]).mean(0), np.float32(vectors[700:]).mean(0)])
    assert np.allclose(index.centres[index.centres[:, 0].argsort()], means, atol=1e-6)
    bounded = build_cells(corpus, 2, 2, "l2", training_rows=100)
    assert np.abs(bounded.centres[bounded.centres[:, 0].argsort()] - means).max() > 1e-6
    assert bounded.rows.count() == 1400


def test_a_scan_passes_on_k_rows_per_query_and_core(spark):
    """Not per split of the corpus, whose number grows with it."""
    rng = np.random.default_rng(7)
    rows = table(spark, rng.normal(size=(400, DIM)), "id", "values").repartition(40)
    queries = rng.normal(size=(10, DIM))
    partial = search._scan(rows, pa.array(range(10)), queries, rows.schema["id"].dataType, 5, "cosine")
    assert partial.count() <= 10 * 5 * spark.sparkContext.defaultParallelism


def test_twenty_thousand_queries_are_one_scan(spark, monkeypatch):
    monkeypatch.setattr(search, "_scan_batches", lambda *_: pytest.fail("searched in batches"))
    turned = F.array(*[F.sin(F.col("qid") + i).cast("float") for i in range(2)])
    asked = spark.range(20_000).withColumnRenamed("id", "qid").withColumn("vector", turned)
    found = topk(table(spark, [[1.0, 0.0], [0.0, 1.0], [-1.0, -1.0]], "id", "values"), asked, 1, dim=2)
    assert found.count() == 20_000


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_equal_scores_of_many_batches_keep_the_lowest_ids_and_few_others(monkeypatch, metric):
    """All rows are as near; ids come in no order, and a query set holds those of its matches only."""
    monkeypatch.setattr(search, "SETTLE_PAIRS", 50)
    turns = np.linspace(0, 2 * np.pi, 900)
    rows = np.stack([np.cos(turns), np.sin(turns), np.zeros(900)], axis=1)
    ids = [f"{i:04d}" for i in np.random.default_rng(2).permutation(900)]
    found = search.QuerySet(pa.array(["q", "r"]), np.array([[0.0, 0.0, 1.0], [0.0, 0.0, 2.0]]), 3, metric)
    for r in range(0, 900, 90):
        found.offer(pa.array(ids[r : r + 90]), rows[r : r + 90])
        assert found.held <= 50 + 90
    got = found.result(pa.string(), pa.string()).to_pydict()
    assert sorted(zip(got["qid"], got["id"], strict=True)) == [(q, i) for q in "qr" for i in ("0000", "0001", "0002")]


def test_scores_kept_by_single_precision_are_those_of_double(spark):
    """Scores closer together than single precision tells apart still rank by their ninth place."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    corpus = np.float32(centre + rng.normal(scale=3e-4, size=(6_000, 64))).astype(float)
    queries = np.float32(centre + rng.normal(scale=3e-4, size=(40, 64))).astype(float)
    found = search.QuerySet(pa.array(range(40)), queries, 4, "cosine")
    for r in range(0, 6_000, 2_500):
        found.offer(pa.array(range(r, min(r + 2_500, 6_000))), corpus[r : r + 2_500])
    got = found.result(pa.int64(), pa.int64()).to_pydict()
    units = [m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None] for m in (queries, corpus)]
    for q in range(40):
        scores = np.round(np.einsum("j,ij->i", units[0][q], units[1]), 9)
        kth = np.sort(scores)[-4]
        hits = [(i, s) for p, i, s in zip(got["qid"], got["id"], got["score"], strict=True) if p == q]
        assert len(hits) == 4 and all(abs(scores[i] - s) < 3e-9 and s >= kth - 3e-9 for i, s in hits)


def test_rows_below_a_querys_bar_are_looked_at_once_for_all(monkeypatch):
    """Once every query has its matches, a slice whose highest product stays below the bars costs no look at single pairs."""
    rng = np.random.default_rng(11)
    queries = np.abs(rng.normal(size=(30, DIM)))
    found = search.QuerySet(pa.array(range(30)), queries, 2, "cosine")
    found.offer(pa.array(range(60)), np.repeat(queries, 2, axis=0))
    looked = []
    monkeypatch.setattr(search.np, "flatnonzero", lambda a, whole=np.flatnonzero: looked.append(np.size(a)) or whole(a))
    far = -np.abs(rng.normal(size=(3_000, DIM)))
    far[1_234] = queries[7]  # no better id than 14 and 15
    found.offer(pa.array(range(60, 3_060)), far)
    assert sum(looked) < 3_000 * 5
    got = found.result(pa.int64(), pa.int64()).to_pydict()
    assert sorted(zip(got["qid"], got["id"], strict=True)) == [(q, i) for q in range(30) for i in (2 * q, 2 * q + 1)]
