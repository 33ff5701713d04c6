"""From documents to vector records, in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.operators.chunking import CHUNK_OVERLAP, CHUNK_TOKENS, chunk_documents, with_chunk_id
from askquarry.operators.records import vector_records
from askquarry.plans.answers import hashed


def chunk_table(
    docs: DataFrame,
    method: str = "window",
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
    embed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(url, content)`` documents to ``(id, url, chunk_no, content, embedding)``.

    With the built-in embedding the whole way is one stage without a shuffle.
    """
    embed = embed or hashed("content", "embedding")
    chunks = with_chunk_id(chunk_documents(docs.select("url", "content"), "content", method, size, overlap))
    return embed(chunks).select("id", "url", "chunk_no", "content", "embedding")


def records_from_documents(docs: DataFrame, namespace: str, **options) -> DataFrame:
    """Documents straight to vector records."""
    return vector_records(chunk_table(docs, **options), F.lit(namespace))
