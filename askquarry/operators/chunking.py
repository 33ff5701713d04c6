"""Chunking: text columns to ordered chunks, as expressions inside the row.

No step here shuffles. Each function returns an array of chunk texts;
``explode_chunks`` turns it into rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askquarry.functions.arrays import evaluate_once
from askquarry.functions.text import sentences, words

# Chunk limit, overlap and the answering model's window, in tokens.
CHUNK_TOKENS = 500
CHUNK_OVERLAP = 10
MODEL_WINDOW = 4096


def window_chunks(
    text: Column,
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
    tokens: Callable[[Column], Column] = words,
) -> Column:
    """Sliding token windows: chunk *i* starts ``size - overlap`` tokens after the one before.

    A null text gives null and a text without tokens an empty array, so
    neither yields a row.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap

    def cut(toks: Column) -> Column:
        n = F.size(toks)
        count = F.greatest(F.lit(1), F.ceil((n - overlap) / F.lit(step))).cast("int")
        starts = F.when(n > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(toks, i * step + 1, F.lit(size)), " "))

    return F.when(text.isNotNull(), evaluate_once(tokens(text), cut))


def sentence_pieces(text: Column, size: int = CHUNK_TOKENS) -> Column:
    """Sentences with single spaces; one above ``size`` words is cut into word windows."""
    return F.flatten(F.transform(sentences(text), lambda s: window_chunks(s, size, 0)))


def sentence_chunks(df: DataFrame, text: str, out: str, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Fill chunks with whole sentences up to ``size`` words.

    The next chunk starts with as many trailing whole sentences of the chunk
    before as fit both in ``overlap`` words and, with the sentence that did not
    fit, in ``size``. The fold keeps only the bounds of each chunk, and looks
    back over at most ``overlap`` sentences when one closes; texts are sliced
    once at the end.
    """
    pieces, counts, bounds = "_pieces", "_counts", "_bounds"
    c = F.col
    nothing = F.array().cast("array<struct<first:int,last:int>>")

    def trailing(start: Column, i: Column, room: Column) -> Column:
        """How many pieces before ``i``, back to ``start`` at most, fit in ``room`` words."""
        looks = F.sequence(F.lit(1), F.lit(overlap)) if overlap else F.array().cast("array<int>")

        def look(acc: Column, j: Column) -> Column:
            n = F.get(c(counts), F.greatest(i - j, F.lit(0)))
            fits = acc["open"] & (i - j >= start) & (acc["words"] + n <= room)
            return F.struct(
                F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
                F.when(fits, acc["words"] + n).otherwise(acc["words"]).alias("words"),
                fits.alias("open"),
            )

        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(True).alias("open"))
        return F.aggregate(looks, none, look)

    def step(acc: Column, i: Column) -> Column:
        n = F.get(c(counts), i)
        full = acc["used"] + n > size
        lead = F.when(full, trailing(acc["start"], i, F.least(F.lit(overlap), F.lit(size) - n)))
        closed = F.array(F.struct(acc["start"].alias("first"), (i - 1).alias("last")))
        return F.struct(
            F.when(full, i - lead["n"]).otherwise(acc["start"]).alias("start"),
            F.when(full, lead["words"] + n).otherwise(acc["used"] + n).alias("used"),
            F.when(full, F.concat(acc["done"], closed)).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["start"].alias("first"), (F.size(c(pieces)) - 1).alias("last")))
        return F.concat(acc["done"], last)

    start = F.struct(F.lit(0).alias("start"), F.lit(0).alias("used"), nothing.alias("done"))
    positions = F.sequence(F.lit(0), F.size(c(pieces)) - 1)
    joined = F.transform(
        c(bounds),
        lambda b: F.array_join(F.slice(c(pieces), b["first"] + 1, b["last"] - b["first"] + 1), " "),
    )
    return (
        df.withColumn(pieces, sentence_pieces(c(text), size))
        .withColumn(counts, F.transform(c(pieces), lambda s: F.size(F.split(s, " "))))
        .withColumn(bounds, F.when(F.size(c(pieces)) > 0, F.aggregate(positions, start, step, finish)))
        .withColumn(out, joined)
        .drop(pieces, counts, bounds)
    )


def explode_chunks(df: DataFrame, chunks: str, content: str = "content") -> DataFrame:
    """One row per chunk with its number; rows without chunks drop out.

    The coalesce keeps the optimizer from adding a non-empty filter below the
    chunking, where the whole chunk expression would be computed again.
    """
    keep = [F.col(c) for c in df.columns if c != chunks]
    some = F.coalesce(F.col(chunks), F.array().cast("array<string>"))
    return df.select(*keep, F.posexplode(some).alias("chunk_no", content))


def chunk_documents(
    docs: DataFrame,
    text: str = "content",
    method: str = "window",
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Rows ``(…, chunk_no, content)`` of every document that has text."""
    if method == "window":
        chunked = docs.withColumn("_chunks", window_chunks(F.col(text), size, overlap))
    elif method == "sentence":
        chunked = sentence_chunks(docs, text, "_chunks", size, overlap)
    else:
        raise ValueError(f"unknown chunking method {method!r}")
    return explode_chunks(chunked.drop(text), "_chunks", "content")


def chunkless(docs: DataFrame, text: str = "content") -> DataFrame:
    """The documents that give no chunks: null text or no words in it."""
    return docs.filter(F.col(text).isNull() | (F.size(words(F.col(text))) == 0))


def with_chunk_id(chunks: DataFrame, url: str = "url", chunk_no: str = "chunk_no") -> DataFrame:
    """Add ``id``: the md5 of url and chunk number, the same on every run."""
    key = F.concat(F.col(url), F.lit("#"), F.col(chunk_no).cast("string"))
    return chunks.withColumn("id", F.md5(key))


def within_budget(ranked: DataFrame, group: str, rank: str, n_tokens: str, budget: int) -> DataFrame:
    """Leading rows of each group while their running token sum stays within ``budget``."""
    running = Window.partitionBy(group).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("used_tokens", F.sum(n_tokens).over(running)).filter(F.col("used_tokens") <= budget)
