"""Text expressions. Patterns keep to syntax that Java and RE2 both accept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"[ \t\r\n\f]+"

# Element bodies that hold no readable text, and tags that end a line.
HIDDEN_ELEMENTS = ["script", "style", "nav"]
LINE_TAGS = "p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|title|body"
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


def words(text: Column) -> Column:
    """Whitespace-separated words, in order, without empty ones."""
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")


def html_patterns() -> list[tuple[str, str]]:
    """The (pattern, replacement) steps that turn markup into lines of text."""
    hidden = [(rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ") for tag in HIDDEN_ELEMENTS]
    return [
        (r"(?s)<!--.*?-->", " "),
        *hidden,
        (rf"(?i)</?({LINE_TAGS})\b[^>]*>", "\n"),
        (r"<[^>]*>", ""),
    ]


TIDY_PATTERNS = [
    (r"[ \t\r\f]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
]


def html_to_text(html: Column) -> Column:
    """Readable text of a web page: one line per block, entities decoded."""
    text = html
    for pattern, replacement in html_patterns():
        text = F.regexp_replace(text, pattern, replacement)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    for pattern, replacement in TIDY_PATTERNS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def sentences(text: Column) -> Column:
    """Sentences in order; a line end or a stop followed by a space closes one."""
    marked = F.regexp_replace(text, r"([.!?]+)[ \t\r\f]+", "$1\n")
    return F.filter(F.split(marked, r"[\r\n\f]+"), lambda s: F.size(words(s)) > 0)


def first_sentence(text: Column) -> Column:
    return F.coalesce(F.trim(F.get(sentences(text), F.lit(0))), F.lit(""))
