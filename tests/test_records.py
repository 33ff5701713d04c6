"""Records, payloads, the vector table, snapshots and versions."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from askquarry.functions.hashing import hash_embed
from askquarry.operators import records as R
from askquarry.operators import cleaning, vector_table
from askquarry.operators.cleaning import boilerplate_lines, drop_lines
from askquarry.operators.search import ModelMismatch, topk
from askquarry.operators.vector_table import Load, VectorTable, stale_keys
from askquarry.session import scratch_path


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, url string, content string, embedding array<float>")


def test_payload_leaves_nulls_out_and_reads_back(spark):
    rows = chunk_rows(spark, [("1", None, 'say "hi"\n{x}', [1.0]), ("2", "u", "é", [1.0])])
    shaped = R.vector_records(rows, "ns")
    assert [f.name for f in shaped.schema] == [f.name for f in R.VECTOR_RECORD]
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in R.VECTOR_RECORD]
    payloads = {r["id"]: json.loads(r["metadata"]) for r in shaped.collect()}
    assert payloads == {
        "1": {"content": 'say "hi"\n{x}', "id": "1"},
        "2": {"content": "é", "url": "u", "id": "2"},
    }
    back = shaped.select(R.read_payload(F.col("metadata")).alias("p")).select("p.*").collect()
    assert {r["content"] for r in back} == {'say "hi"\n{x}', "é"}


def test_original_doc(spark):
    row = spark.createDataFrame([("a\nb",)], "c string").select(R.original_doc_json(F.col("c")).alias("j")).first()
    assert json.loads(row["j"]) == {"original_doc": "a\nb"}


def test_wrong_sizes_are_reported(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, values array<float>")
    assert sorted(r["id"] for r in R.wrong_size(rows, 2).collect()) == [2, 3]
    assert {(r["dim"], r["n_vectors"]) for r in R.embedding_sizes(rows).collect()} == {(2, 1), (1, 1), (None, 1)}


def live(table, namespace=None):
    return sorted((r["namespace"], r["id"], r["values"]) for r in table.current(namespace).collect())


def test_vector_table(spark):
    def recs(rows, ns):
        return R.vector_records(chunk_rows(spark, [(i, "u", "t", [v]) for i, v in rows]), ns)

    table = VectorTable(spark, scratch_path(spark, "vt"), {"model": "m", "dim": 1})
    assert live(table) == []
    table.upsert(recs([("1", 1.0), ("2", 2.0)], "a"))
    table.upsert(recs([("1", 9.0)], "b"))
    load = table.upsert(recs([("2", 5.0), ("3", 3.0)], "a"))
    once = live(table)
    assert once == [("a", "1", [1.0]), ("a", "2", [5.0]), ("a", "3", [3.0]), ("b", "1", [9.0])]
    table.upsert(recs([("2", 5.0), ("3", 3.0)], "a"), load)
    assert live(table) == once and len(table.loads()) == 3
    table.delete(recs([("2", 0.0)], "a"))
    assert live(table, "a") == [("a", "1", [1.0]), ("a", "3", [3.0])]
    table.upsert(recs([("2", 7.0)], "a"))
    assert ("a", "2", [7.0]) in live(table)
    small = table.compact(scratch_path(spark, "vt"))
    assert live(small) == live(table) and small.loads() == [0]
    assert table.current().schema["values"].metadata == {"model": "m", "dim": 1}


def test_unfinished_load_is_not_read(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(R.vector_records(chunk_rows(spark, [("1", "u", "t", [1.0])]), "a"))
    half = R.vector_records(chunk_rows(spark, [("2", "u", "t", [1.0])]), "a").withColumn("deleted", F.lit(False))
    half.write.partitionBy("namespace").parquet(f"{table.root}/data/commit=half")
    assert [r[1] for r in live(table)] == ["1"]


def one(spark, value, ns="a", id="1"):
    return R.vector_records(chunk_rows(spark, [(id, "u", "t", value)]), ns)


def test_a_delete_between_two_batches_of_a_stream_survives(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(one(spark, [1.0]), Load("stream", 0))
    table.delete(one(spark, [0.0]))
    table.upsert(one(spark, [2.0], id="2"), Load("stream", 1))
    assert live(table) == [("a", "2", [2.0])]
    table.upsert(one(spark, [1.0]), Load("stream", 0))  # the first batch again stays below the delete
    assert live(table) == [("a", "2", [2.0])] and len(table.loads()) == 3


def test_compaction_in_place_knows_what_it_holds(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(one(spark, [1.0]), Load("s", 0))
    table.upsert(one(spark, [2.0]), Load("s", 1))
    table.delete(one(spark, [0.0], id="3"))
    assert table.tidy() and len(table.loads()) == 1 and not table.tidy()
    table.upsert(one(spark, [1.0]), Load("s", 0))
    table.upsert(one(spark, [1.5]), Load("s", 1))
    assert live(table) == [("a", "1", [2.0])]
    table.upsert(one(spark, [3.0]), Load("s", 2))
    assert live(table) == [("a", "1", [3.0])]
    table.compact()
    table.upsert(one(spark, [2.5]), Load("s", 2))
    table.upsert(one(spark, [4.0]), Load("other", 0))
    assert live(table) == [("a", "1", [4.0])]


def test_a_number_of_the_log_is_taken_once(spark, monkeypatch):
    path = scratch_path(spark, "vt")
    first, second = VectorTable(spark, path), VectorTable(spark, path)
    first.upsert(one(spark, [1.0]))
    log = VectorTable._log
    # the second writer looked before the first wrote
    monkeypatch.setattr(VectorTable, "_log", lambda self: [] if self is second else log(self))
    second.upsert(one(spark, [2.0], "b"))
    monkeypatch.undo()
    assert first.loads() == [0, 1] and live(first) == [("a", "1", [1.0]), ("b", "1", [2.0])]


def embedded(spark, dim, column="values"):
    text = spark.createDataFrame([("1", "u", "some words")], "id string, url string, content string")
    return hash_embed(text, "content", column, dim)


def test_the_model_travels_with_the_table(spark):
    path = scratch_path(spark, "vt")
    VectorTable(spark, path).upsert(R.vector_records(embedded(spark, 16, "embedding"), "a"))
    stored = VectorTable(spark, path).current()
    assert topk(stored, embedded(spark, 16, "vector").withColumnRenamed("id", "qid"), 1).count() == 1
    with pytest.raises(ModelMismatch):
        topk(stored, embedded(spark, 32, "vector").withColumnRenamed("id", "qid"), 1)
    for other in (R.vector_records(embedded(spark, 32, "embedding"), "a"), one(spark, [1.0] * 16)):
        with pytest.raises(ModelMismatch):
            VectorTable(spark, path).upsert(other)
    VectorTable(spark, path).delete(stored)
    VectorTable(spark, path).compact()
    assert VectorTable(spark, path).current().schema["values"].metadata["dim"] == 16


def test_a_vector_of_the_wrong_size_fails_its_load(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"), {"model": "m", "dim": 2})
    table.upsert(one(spark, None))
    with pytest.raises(Exception, match="has not 2 values"):
        table.upsert(one(spark, [1.0]))
    assert len(table.loads()) == 1


def test_more_keys_than_are_broadcast(spark, monkeypatch):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    for v in (1.0, 2.0, 3.0):
        table.upsert(R.vector_records(chunk_rows(spark, [(str(k), "u", "t", [v + k]) for k in range(int(v) * 2)]), "a"))
    few = live(table)
    monkeypatch.setattr(vector_table, "BROADCAST_KEYS", 0)
    assert live(table) == few == [("a", str(k), [3.0 + k]) for k in range(6)]


def test_loads_are_sorted_and_have_bloom_filters(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(R.vector_records(chunk_rows(spark, [(str(k), "u", "t", [1.0]) for k in (3, 1, 2)]).coalesce(1), "a"))
    (file,) = table.current().inputFiles()
    column = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0).column(0)
    assert column.path_in_schema == "id" and (column.statistics.min, column.statistics.max) == ("1", "3")
    assert [r["id"] for r in table.current().collect()] == ["1", "2", "3"]
    assert spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration())
    ).getFooter().getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0


def test_namespace_prunes_folders(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(R.vector_records(chunk_rows(spark, [("1", "u", "t", [1.0])]), "a"))
    plan = table.current("a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(namespace" in plan


def test_shrunk_document_leaves_no_stale_chunks(spark):
    table = VectorTable(spark, scratch_path(spark, "vt"))
    table.upsert(R.vector_records(chunk_rows(spark, [("1", "u", "t", [1.0]), ("2", "u", "t", [1.0])]), "a"))
    table.delete(stale_keys(table, "a", chunk_rows(spark, [("1", "u", "t", [1.0])])))
    assert [r[1] for r in live(table)] == ["1"]


def test_changes(spark):
    schema = "id string, content string"
    before = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", None)], schema)
    after = spark.createDataFrame([("1", "a"), ("2", "x"), ("5", "e"), ("4", None)], schema)
    got = {(r["id"], r["change"]) for r in R.changes(before, after).collect()}
    assert got == {("2", "update"), ("3", "delete"), ("5", "insert")}


def test_versions_are_numbers_and_at_least_one(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    versions = spark.createDataFrame([("a", "2"), ("a", "10"), ("a", "9"), ("c", "0")], "name string, version string")
    got = R.latest_versions(names, versions, "name", "version").collect()
    assert {(r["name"], r["latest_version"]) for r in got} == {("a", 10), ("b", 1), ("c", 1)}


@pytest.mark.parametrize("limit", [10, 0])
def test_boilerplate(spark, monkeypatch, limit):
    monkeypatch.setattr(cleaning, "BROADCAST_LINES", limit)
    monkeypatch.setattr(cleaning, "BROADCAST_HASHES", limit)
    rows = [(f"d{i}", f"title {i}\n  legal line \nbody {i}\nlegal line") for i in range(6)] + [("e", "legal line"), ("n", None)]
    docs = spark.createDataFrame(rows, "url string, content string")
    lines = boilerplate_lines(docs, min_docs=5)
    assert [(r["line"], r["n_docs"]) for r in lines.collect()] == [("legal line", 7)]
    cleaned = {r["url"]: r["content"] for r in drop_lines(docs, lines, "url").collect()}
    assert cleaned["d3"] == "title 3\nbody 3" and cleaned["e"] == "" and cleaned["n"] is None
    assert len(cleaned) == len(rows)


def test_plain_and_gathered_loads_agree(spark):
    rows = R.vector_records(chunk_rows(spark, [("1", "u", "t", [1.0]), ("2", "u", "t", [2.0])]), F.col("id"))
    for gather in (False, True):
        table = VectorTable(spark, scratch_path(spark, "vt"))
        table.upsert(rows, gather=gather)
        assert live(table) == [("1", "1", [1.0]), ("2", "2", [2.0])]
