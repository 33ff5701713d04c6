"""Spelling variants by permuterm rotations (operator 11).

A word of n letters, marked with a terminator, has n + 1 rotations. A word whose letter c is edited is the rotation
``y$x`` + c, so words that differ in that letter alone, and the word without it, share the prefix ``y$x``.
Sorted by prefix they are neighbours, and such a group has at most one word per letter of the alphabet and the word without:
its size has nothing to do with how frequent words are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askquarry.llm import rolling
from askquarry.llm.common import LOWER, UPPER, Stages
from askquarry.session import ship_package

#: Letters that a word has at least, and occurrences.
SHORTEST, RAREST = 7, 2
#: A near word is a word's form from so many times its occurrences on.
DOMINANCE = 10
#: Fixed value: the letters of words, after A-Z are lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
#: Of the runs of every document, those whose checksum this divides lose a letter.
SLIPS = 31
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000

_RUNS = re.compile(LETTERS)
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def slipped(doc_id: int | None, run: str) -> str:
    """The run, without one letter where the checksum of ``<doc_id>:<run>`` is divisible by 31; a null id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIPS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    for rows, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
        for doc_id, text in zip(rows["doc_id"].to_pylist(), texts, strict=True):
            for run, n in Counter(_RUNS.findall(text.translate(_LOWER).decode())).items():
                # a run that loses a letter has to keep enough
                if len(run) >= SHORTEST and len(word := slipped(doc_id, run)) >= SHORTEST:
                    words[word] += n
        if len(words) >= COUNTED:
            yield told()
            words.clear()
    yield told()


def word_counts(docs: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(word, n) of the words of whole texts with at least seven letters and ``rarest`` occurrences.

    Occurrences are summed within each task before the shuffle, so a word in every document is one row per task.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = rows.mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, n): for every letter of every word the rotation that ends in it, cut before it.

    The rows without letter are the whole rotations, under which words with one letter more are found. The word
    itself is what follows the terminator in the prefix, the letter, and what precedes it.
    """
    word, size = F.col("word"), F.length("word")

    def turned(at):
        return F.concat(F.substring(word, at + 1, size), F.lit("$"), F.substring(word, F.lit(1), at))

    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(turned(i).alias("prefix"), F.lit("").alias("letter")))
    cut = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(F.concat(F.substring(word, i + 1, size), F.lit("$"), F.substring(word, F.lit(1), i - 1)).alias("prefix"), F.substring(word, i, F.lit(1)).alias("letter")),
    )
    return words.select("n", F.explode(F.concat(whole, cut)).alias("r")).select("r.*", "n")


def _unrotated(prefix, letter):
    return F.concat(F.substring_index(prefix, "$", -1), letter, F.substring_index(prefix, "$", 1))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n): each word's number of near words and the most frequent of them (ties: the smallest word).

    Each sorted group is scanned once and gives one row per member with what the group holds for it, never its
    pairs. Two words that differ by an inserted letter meet in a group for each place within a run of that letter; the place before
    the run is the one that counts.
    """
    group = Window.partitionBy("prefix")
    order = group.orderBy(F.col("letter") == "", F.desc("n"), "letter")
    scan = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    letter, n = F.col("letter"), F.col("n")
    is_cut, starts_run = letter != "", F.substring("prefix", -1, 1) != letter
    entry = F.when(is_cut, F.struct((-n).alias("minus_n"), _unrotated(F.col("prefix"), letter).alias("word")))
    rows = rotations(words).withColumns({
        "rank": F.row_number().over(order),
        "first": F.first(entry).over(scan),
        "second": F.nth_value(entry, 2).over(scan),
        "cuts": F.count_if(is_cut).over(scan),
        "starts": F.count_if(is_cut & starts_run).over(scan),
        "whole_n": F.max(F.when(~is_cut, n)).over(scan),
    })
    has_whole = F.col("whole_n").isNotNull()
    whole = F.when(has_whole, F.struct((-F.col("whole_n")).alias("minus_n"), _unrotated(F.col("prefix"), F.lit("")).alias("word")))
    other = F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first"))
    beside = F.col("cuts") - 1 + F.when(has_whole & starts_run, 1).otherwise(0)
    told = rows.select(
        _unrotated(F.col("prefix"), letter).alias("word"),
        "n",
        F.when(is_cut, beside).otherwise(F.col("starts")).alias("n_near"),
        F.when(is_cut, F.least(other, whole)).otherwise(F.col("first")).alias("best"),
        # one row of each word stands for it even without near words
        (~is_cut & F.col("prefix").endswith("$")).alias("itself"),
    ).where("n_near > 0 or itself")
    found = told.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n", "n_near", F.col("best.word").alias("near"), (-F.col("best.minus_n")).alias("near_n"))


def _roots(forms: DataFrame, stages: Stages) -> DataFrame:
    """(word, root) by following (word, to) to the end; occurrences grow tenfold with every step, so a few doublings do."""
    while True:
        hop = forms.select(F.col("word").alias("to"), F.col("to").alias("next"))
        jumped = forms.join(hop, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        jumped = stages.save(jumped, "roots")
        forms = jumped.select("word", "to")
        if jumped.where("moved").isEmpty():
            return forms.withColumnRenamed("to", "root")


def variants(docs: DataFrame, rarest: int = RAREST, dominance: int = DOMINANCE) -> DataFrame:
    """The distinct words of ``docs`` grouped by spelling: word, form, root, n, n_near, form_n.

    ``form`` is the word's most frequent near word (an edit of exactly one letter; ties: the smallest in code-point order) if
    it occurs at least ``dominance`` times as often, else null; ``root`` follows forms to the last. Null and
    empty texts have no words. Repeated rows count again. A null doc_id is written as nothing in checksums.
    No documents give no rows. Columns other than doc_id and text are not read. A task holds one text and
    the counts of at most ``COUNTED`` words besides that text's.
    """
    stages = Stages(docs.sparkSession, "spelling")
    words = stages.save(word_counts(docs, rarest), "words")
    form = F.col("near_n") >= dominance * F.col("n")
    near = near_words(words).select("word", F.when(form, F.col("near")).alias("form"), "n", "n_near", F.when(form, F.col("near_n")).alias("form_n"))
    near = stages.save(near, "near")
    roots = _roots(near.where("form is not null").select("word", F.col("form").alias("to")), stages)
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
