"""Boilerplate lines: lines that many documents share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askquarry.session import materialize

LINE_END = re.compile(r"\r?\n")

SALTS = 16
#: Hashes of frequent lines that are broadcast, and lines to drop, with their characters.
BROADCAST_HASHES = 2_000_000
BROADCAST_LINES, BROADCAST_CHARS = 500_000, 32 * 1024 * 1024


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, r"\r?\n"), lambda line: F.trim(line))


def boilerplate_lines(docs: DataFrame, text: str = "content", min_docs: int = 5) -> DataFrame:
    """Lines found in at least ``min_docs`` documents, with that number.

    Each document counts a line once, which is settled inside the row. Hashes of lines are counted first, so
    texts of lines cross the network only where a hash is frequent; these are then counted as texts, partly before the
    shuffle, so a line that a third of the documents hold sends one row per task.
    """
    distinct = F.array_distinct(F.filter(_lines(F.col(text)), lambda line: line != ""))
    hashes = F.transform(distinct, lambda line: F.xxhash64(line))
    hashed = docs.select(F.explode(F.coalesce(hashes, F.array().cast("array<bigint>"))).alias("h"))
    frequent = materialize(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("h"), "frequent-lines")
    if frequent.count() <= BROADCAST_HASHES:
        frequent = F.broadcast(frequent)
    lines = docs.select(F.explode(F.coalesce(distinct, F.array().cast("array<string>"))).alias("line"))
    counted = lines.withColumn("h", F.xxhash64("line")).join(frequent, "h", "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"))
    return counted.filter(F.col("n_docs") >= min_docs)


def drop_lines(docs: DataFrame, lines: DataFrame, key: str, text: str = "content") -> DataFrame:
    """Remove the given lines from every document, keeping the order of the rest.

    The lines are written out and their size checked. Up to ``BROADCAST_LINES`` of them and ``BROADCAST_CHARS`` characters are
    a set that every task holds, and no text is moved. More meet the documents by hash, salted by document so that a
    line with very many documents is spread over ``SALTS`` tasks; each text then filters itself against its own short list.
    Documents with nothing left become empty text; those without any of the lines, and nulls, stay as they are.
    """
    lines = materialize(lines.select("line"), "lines-to-drop")
    size = lines.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("line")), F.lit(0)).alias("chars")).first()
    if size["n"] <= BROADCAST_LINES and size["chars"] <= BROADCAST_CHARS:
        return _drop_known(docs, frozenset(lines.toArrow()["line"].to_pylist()), text)
    hashes = F.array_distinct(F.transform(_lines(F.col(text)), lambda line: F.xxhash64(line)))
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS))
    held = docs.select(key, salt.alias("salt"), F.explode(F.coalesce(hashes, F.array().cast("array<bigint>"))).alias("h"))
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    known = lines.select(F.xxhash64("line").alias("h"), F.col("line")).withColumn("salt", F.explode(salts))
    hits = held.join(known, ["salt", "h"]).groupBy(key).agg(F.collect_set("line").alias("_drop"))
    kept = F.filter(
        F.split(F.col(text), r"\r?\n"), lambda line: ~F.array_contains(F.col("_drop"), F.trim(line))
    )
    cleaned = F.when(F.col("_drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return docs.join(hits, key, "left").withColumn(text, cleaned).drop("_drop")


def _drop_known(docs: DataFrame, lines: frozenset[str], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lines)
    schema = docs.schema

    def without(value: str | None) -> str | None:
        if value is None:
            return None
        every = LINE_END.split(value)
        kept = [line for line in every if line.strip(" ") not in shared.value]
        return value if len(kept) == len(every) else "\n".join(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            cleaned = pa.array([without(v) for v in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), cleaned)

    return docs.mapInArrow(run, schema)
