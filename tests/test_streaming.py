"""Draining folders: incremental runs, several sources, restarts."""

from pathlib import Path

from pyspark.sql import functions as F

from askquarry.operators.plugins import extract_text, utf8_pages
from askquarry.operators.vector_table import VectorTable
from askquarry.plans.ingest import records_from_documents
from askquarry.sources import corpus
from askquarry.streaming import drain


def write(folder: Path, name: str, text: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def run(spark, folder, root):
    drain.drain(drain.stream_files(spark, str(folder)), root, "raw")
    return sorted(
        (r["path"].rsplit("/", 1)[-1], bytes(r["content"]).decode()) for r in drain.drained(spark, root, "raw").collect()
    )


def test_only_new_files_are_added(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    write(inbox, "a.txt", "one")
    write(inbox, "empty.txt", "")
    assert run(spark, inbox, root) == [("a.txt", "one")]
    assert run(spark, inbox, root) == [("a.txt", "one")]
    write(inbox, "b.txt", "two")
    write(inbox, "a.txt", "changed")
    assert run(spark, inbox, root) == [("a.txt", "one"), ("b.txt", "two")]


def test_glob_and_listing(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, "a.txt", "one")
    write(inbox, "b.bin", "four")
    rows = corpus.list_files(spark, str(inbox), "*.bin").collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["length"]) for r in rows] == [("b.bin", 4)]


def to_records(batch):
    texts = extract_text(batch.select(F.col("path").alias("url"), "content"), "content", utf8_pages, "text")
    return records_from_documents(texts.select("url", F.col("text").alias("content")), "n")


def test_two_streams_one_vector_table_equal_one_batch(spark, tmp_path):
    root = str(tmp_path / "out")
    table = VectorTable(spark, f"{root}/vectors")
    folders = [tmp_path / "one", tmp_path / "two"]

    def load():
        for folder in folders:
            drain.drain_to_vectors(
                drain.stream_files(spark, str(folder), max_files=1),
                table,
                drain.checkpoint_path(root, folder.name, "vectors"),
                to_records,
                compact_share=None,
            )

    write(folders[0], "a.txt", "alpha beta")
    write(folders[0], "b.txt", "gamma " * 600)
    write(folders[1], "c.txt", "delta")
    load()
    write(folders[1], "d.txt", "epsilon")
    load()
    load()
    whole = corpus.merge_corpora(
        corpus.raw_files(spark, str(f)).select("path", "content") for f in folders
    )
    expected = sorted((r["id"], r["values"], r["metadata"]) for r in to_records(whole).collect())
    assert sorted((r["id"], r["values"], r["metadata"]) for r in table.current().collect()) == expected
    assert len(expected) == 5 and len(table.loads()) == 4
    table.compact()
    load()
    assert sorted((r["id"], r["values"], r["metadata"]) for r in table.current().collect()) == expected


def test_a_deleted_key_stays_deleted_when_the_stream_goes_on(spark, tmp_path):
    root = str(tmp_path / "out")
    table = VectorTable(spark, f"{root}/vectors")

    def load():
        stream = drain.stream_files(spark, str(tmp_path / "in"))
        drain.drain_to_vectors(stream, table, drain.checkpoint_path(root, "in", "vectors"), to_records)

    write(tmp_path / "in", "a.txt", "alpha")
    load()
    table.delete(table.current())
    write(tmp_path / "in", "b.txt", "beta")
    load()
    (row,) = table.current().collect()
    assert "beta" in row["metadata"]


def test_an_empty_source_drains_to_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert run(spark, tmp_path / "in", str(tmp_path / "out")) == []
    write(tmp_path / "in", "a.txt", "one")
    assert run(spark, tmp_path / "in", str(tmp_path / "out")) == [("a.txt", "one")]


def test_missing_second_corpus(spark):
    first = corpus.documents(spark.createDataFrame([("u", "t")], "a string, b string"), "a", "b")
    merged = corpus.merge_corpora([first, corpus.optional_table(spark, "askquarry_not_there")])
    assert [tuple(r) for r in merged.collect()] == [("u", "t")]
    first.createOrReplaceTempView("askquarry_there")
    assert corpus.merge_corpora([first, corpus.optional_table(spark, "askquarry_there")]).count() == 2


def test_url_like(spark):
    df = spark.createDataFrame([(2, "x.pdf"), (1, "y.pdf"), (0, "z.html")], "id int, url string")
    assert [r["id"] for r in corpus.url_like(df, "%.pdf", 1).collect()] == [1]
