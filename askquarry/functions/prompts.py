"""Prompt templates: ``{slot}`` markers filled from columns in one pass."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")

# Default wordings. Callers pass their own text with the same slots.
PLAIN = "You are a helpful assistant. Answer briefly.\nQuestion: {question}"

WITH_HISTORY = (
    "You are a helpful assistant. If you do not know the answer, say so.\n"
    "Earlier messages: {chat_history}\n"
    "Question: {question}"
)

RELEVANCE = (
    "Decide whether a question belongs to the topic: {topic}.\n"
    "A follow-up question belongs to it when the earlier messages do. "
    "Reply with one word, yes or no.\n"
    "Earlier messages: {chat_history}\n"
    "Question: {question}"
)

SEARCH_QUERY = (
    "Write one search query that would find documents answering the question, "
    "given the earlier messages. Reply with the query only.\n"
    "Earlier messages: {chat_history}\n"
    "Question: {question}"
)

WITH_CONTEXT = (
    "Answer the question from the documents and the earlier messages. "
    "If they do not hold the answer, say that you do not know.\n"
    "Earlier messages: {chat_history}\n"
    "Documents: {context}\n"
    "Question: {question}"
)

REFUSAL = "I can only answer questions about {topic}."


def slots(template: str) -> list[str]:
    return _SLOT.findall(template)


def render(template: str, **values: Column | str) -> Column:
    """One string expression; text coming from columns is never scanned for slots."""
    missing = sorted(set(slots(template)) - set(values))
    if missing:
        raise KeyError(f"no value for slots {missing}")
    parts = _SLOT.split(template)
    pieces = []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            if part:
                pieces.append(F.lit(part))
        else:
            value = values[part]
            value = value if isinstance(value, Column) else F.lit(value)
            pieces.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*pieces)


def history_text(history: Column) -> Column:
    """History as a JSON list of ``{"role", "content"}`` objects."""
    return F.to_json(history)
