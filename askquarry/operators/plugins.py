"""Plug-in stages: caller-supplied extractors, splitters and models run over Arrow batches.

A plug-in is a *factory*: a function without arguments, called once per partition
on the executor, that returns the function doing the work. Clients, tokenizers
and models are so built once per partition and never pickled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Texts per embedding request; answer length in tokens, for a plain
# question and for the stages of the answer flow.
EMBED_BATCH = 150
PLAIN_ANSWER_TOKENS = 500
ANSWER_TOKENS = 200

TextsTo = Callable[[list[str]], list]
LanguageModel = Callable[[list[str], int], list[str]]


def rebatch(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Regroup batches into tables of exactly ``size`` rows, the last one shorter."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            waiting.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(waiting)
                waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting)


def call_in_batches(
    df: DataFrame, text: str, factory: Callable[[], TextsTo], out: str, out_type: T.DataType, batch_size: int
) -> DataFrame:
    """Add ``out``: the plug-in's value for each text, at most ``batch_size`` texts per call.

    Order is kept and null texts are not sent. A plug-in error fails the task.
    """
    arrow_type = to_arrow_type(out_type)
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, out_type)])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = None
        for table in rebatch(batches, batch_size):
            call = call or factory()
            texts = table.column(text).to_pylist()
            sent = [t for t in texts if t is not None]
            got = list(call(sent)) if sent else []
            if len(got) != len(sent):
                raise ValueError(f"plug-in returned {len(got)} values for {len(sent)} texts")
            results = iter(got)
            values = [None if t is None else next(results) for t in texts]
            full = table.select(kept).append_column(out, pa.array(values, type=arrow_type))
            yield from full.combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def embed_texts(
    df: DataFrame,
    text: str,
    factory: Callable[[], TextsTo],
    model: str,
    dim: int,
    out: str = "embedding",
    batch_size: int = EMBED_BATCH,
) -> DataFrame:
    """Embed a text column with a caller-supplied model; see ``call_in_batches``."""
    embedded = call_in_batches(df, text, factory, out, T.ArrayType(T.FloatType()), batch_size)
    return embedded.withColumn(out, F.col(out).alias(out, metadata={"model": model, "dim": dim}))


def generate_texts(
    df: DataFrame,
    prompt: str,
    factory: Callable[[], LanguageModel],
    out: str = "answer",
    max_tokens: int = ANSWER_TOKENS,
    batch_size: int = 16,
) -> DataFrame:
    """Run a caller-supplied language model over a prompt column.

    The model is called with the prompts and the longest answer it may give.
    """

    def limited() -> TextsTo:
        model = factory()
        return lambda prompts: model(prompts, max_tokens)

    return call_in_batches(df, prompt, limited, out, T.StringType(), batch_size)


def extract_text(
    df: DataFrame,
    content: str,
    factory: Callable[[], Callable[[bytes], list[str]]],
    out: str = "text",
    error: str = "error",
) -> DataFrame:
    """Decode documents: the extractor gives a document's pages, joined by newlines.

    One bad document does not stop the others: its text is null and ``error``
    holds the reason. The bytes are not carried on.
    """
    kept = [f for f in df.schema.fields if f.name != content]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(out, T.StringType()), T.StructField(error, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages_of = None
        for batch in batches:
            pages_of = pages_of or factory()
            texts, errors = [], []
            for raw in batch.column(content):
                try:
                    texts.append("\n".join(pages_of(raw.as_py())))
                    errors.append(None)
                except Exception as problem:
                    texts.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            full = pa.Table.from_batches([batch]).select(names)
            full = full.append_column(out, pa.array(texts, pa.string()))
            full = full.append_column(error, pa.array(errors, pa.string()))
            yield from full.to_batches()

    return df.mapInArrow(run, schema)


def split_texts(
    df: DataFrame, text: str, factory: Callable[[], Callable[[str], list[str]]], out: str = "chunks"
) -> DataFrame:
    """Chunk with a caller-supplied splitter, for example one counting a model's own tokens."""

    def per_batch() -> TextsTo:
        split = factory()
        return lambda texts: [split(t) for t in texts]

    return call_in_batches(df, text, per_batch, out, T.ArrayType(T.StringType()), 100)


def utf8_pages() -> Callable[[bytes], list[str]]:
    """Extractor for plain text; form feeds separate pages."""
    return lambda raw: raw.decode("utf-8").split("\f")
