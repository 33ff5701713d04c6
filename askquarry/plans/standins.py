"""Small offline plug-ins, for trying the plug-in stages without a model or a parser."""

from __future__ import annotations

import functools
import hashlib
import math
import re

from askquarry.functions.hashing import DEFAULT_DIM

WORD_BREAKS = re.compile(r"[ \t\r\n\f]+")
#: Words whose bucket a model remembers.
KNOWN_WORDS = 131_072


def pages_of_paragraphs():
    """Extractor whose pages are the lines of the text; junk marks make it fail."""

    def pages(raw: bytes) -> list[str]:
        text = raw.decode("utf-8")
        if "###" in text:
            raise ValueError("junk mark")
        return text.split("\n")

    return pages


def paragraph_splitter():
    return lambda text: [line for line in text.split("\n") if line.strip(" \t\r\f")]


def hash_model():
    """The built-in hashed embedding as a caller's model."""

    @functools.lru_cache(KNOWN_WORDS)
    def bucket(word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DEFAULT_DIM

    def embed_one(text: str) -> list[float]:
        counts = [0] * DEFAULT_DIM
        for word in filter(None, WORD_BREAKS.split(text)):
            counts[bucket(word)] += 1
        length = math.sqrt(sum(c * c for c in counts))
        return [c / length if length else 0.0 for c in counts]

    return lambda texts: [embed_one(t) for t in texts]


def echo_model():
    """Answers with the first words of the prompt's last line."""

    def answer(prompt: str, max_tokens: int) -> str:
        last = prompt.rsplit("\n", 1)[-1]
        return " ".join([w for w in WORD_BREAKS.split(last) if w][:max_tokens])

    return lambda prompts, max_tokens: [answer(p, max_tokens) for p in prompts]


UNKNOWN = "I do not know."


def reading_model():
    """Answers a prompt of the default context wording with the documents' sentence that shares most different words with the question.

    The earlier of equal ones; without sentences it says that it does not know.
    """

    def split(text: str) -> list[str]:
        return [w for w in WORD_BREAKS.split(text) if w]

    def answer(prompt: str, max_tokens: int) -> str:
        documents, _, question = prompt.partition("\nDocuments: ")[2].rpartition("\nQuestion: ")
        asked = set(split(question))
        # gaps after a stop become line ends, the other tabs spaces: a line's words lie between spaces only
        for end in ".!?":
            documents = documents.replace(f"{end} ", f"{end}\n").replace(f"{end}\t", f"{end}\n")
        lines = documents.replace("\r", "\n").replace("\f", "\n").replace("\t", " ").split("\n")
        # the empty words of a plain split are in no question
        best = max((line for line in lines if line.strip(" ")), key=lambda line: len(asked.intersection(line.split(" "))), default=UNKNOWN)
        return " ".join(split(best)[:max_tokens])

    return lambda prompts, max_tokens: [answer(p, max_tokens) for p in prompts]
