"""Mixing sources to target weights by balanced sampling with the cube method (operator 9)."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askquarry.llm.common import Stages, numbered, partitions, row_place
from askquarry.session import ship_package

#: Rows that one task balances together.
CHUNK_ROWS = 2_000
#: A document is taken at most so often.
MOST = 3
#: Targets are broadcast up to so many sources, and joined beyond.
BROADCAST_SOURCES = 10_000
#: Rows whose copies, some 60 bytes each, are broadcast to the documents; more meet them in a shuffle.
BROADCAST_ROWS = 1_000_000
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _before(rows: DataFrame, order: list[Column], sums: list[str], stages: Stages) -> DataFrame:
    """``rows`` with before_c for each column c of ``sums``: its sum over the rows that come earlier in the total ``order``.

    The rows are dealt by range; the sums of whole ranges, one row each, say where a range begins.
    """
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).withColumn("part", F.spark_partition_id())
    dealt = stages.save(dealt, "ordered")
    inner = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("part").agg(*(F.sum(c).alias(c) for c in sums))
    parts = parts.select("part", *(F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"first_{c}") for c in sums))
    inside = dealt.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(inner), F.lit(0)) for c in sums})
    known = inside.join(F.broadcast(parts), "part")
    return known.withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"first_{c}") for c in sums}).drop("part", *(f"first_{c}" for c in sums))


def targets(sizes: DataFrame, weights: int = 3, stages: Stages | None = None) -> DataFrame:
    """(source, source_size, n, target) of a table of (source, source_size, n), one row per source.

    Sources by code point, null last, weigh 1 to ``weights``, repeating, and share all sizes; none gets more than ``MOST``
    times its own. The capped ones are those with the least size per weight: going up in that order, a
    source is capped when its share of what the ones before leave is above its cap, and all others share the rest.
    Sources may be many: no task holds more than a range of them. An empty table gives no rows.
    """
    stages = stages or Stages(sizes.sparkSession, "targets")
    by_name = [F.col("source").isNull(), F.col("source")]
    weighed = _before(sizes.withColumn("one", F.lit(1)), by_name, ["one"], stages)
    weighed = weighed.withColumn("w", F.pmod("before_one", F.lit(weights)) + 1).withColumn("cap", F.lit(MOST) * F.col("source_size"))
    leveled = _before(weighed, [F.col("cap") / F.col("w"), *by_name], ["cap", "w"], stages)
    size, weight = leveled.agg(F.sum("source_size"), F.sum("w")).first()
    share = (F.lit(size) - F.col("before_cap")) / (F.lit(weight) - F.col("before_w"))
    level = leveled.agg(F.max(share)).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("w"))
    return leveled.select("source", "source_size", "n", target.cast("double").alias("target"))


# --- the cube method -------------------------------------------------------------------


def flight(sizes: list[int], chances: list[float], rng: random.Random) -> list[float]:
    """Chances moved to 0 or 1, but for two at most, with their sum and their sum by size unchanged.

    Three open items always have a direction that changes neither sum; a random step along it, fair in
    the mean, ends where one of the three is decided, and the next item takes its place.
    """
    out, open_ = list(chances), []
    for item, chance in enumerate(chances):
        if EPS < chance < 1 - EPS:
            open_.append(item)
        if len(open_) == 3:
            a, b, c = (sizes[i] for i in open_)
            step = (b - c, c - a, a - b) if a != b or b != c else (1, -1, 0)
            open_ = _move(out, open_, step, rng)
    return out


def _move(out: list[float], items: list[int], step: tuple[int, ...], rng: random.Random) -> list[int]:
    up = min(((1 - out[i]) / s if s > 0 else out[i] / -s) for i, s in zip(items, step, strict=True) if s)
    down = min((out[i] / s if s > 0 else (1 - out[i]) / -s) for i, s in zip(items, step, strict=True) if s)
    by = up if rng.random() * (up + down) < down else -down
    for i, s in zip(items, step, strict=True):
        out[i] += by * s
        out[i] = 0.0 if out[i] < EPS else 1.0 if out[i] > 1 - EPS else out[i]
    return [i for i in items if 0 < out[i] < 1]


def landing(sizes: list[int], chances: list[float]) -> list[float]:
    """The one or two items left open, rounded so that the sum by size, then the count, stays nearest."""
    out = [float(round(p)) if p < EPS or p > 1 - EPS else p for p in chances]
    open_ = [i for i, p in enumerate(out) if 0 < p < 1]
    ways = [[w >> k & 1 for k in range(len(open_))] for w in range(1 << len(open_))]

    def off(way: list[int]) -> tuple[float, float]:
        moved = [(v - out[i], sizes[i]) for v, i in zip(way, open_, strict=True)]
        return abs(sum(d * s for d, s in moved)), abs(sum(d for d, _ in moved))

    for i, v in zip(open_, min(ways, key=off), strict=True):
        out[i] = float(v)
    return out


def settle(sizes: list[int], chances: list[float], rng: random.Random) -> list[float]:
    """All chances decided: flown and landed by size class, the longest documents first.

    What a class misses of its words is spread over the chances of the shorter ones, so in the end only
    about the shortest documents' size is missed.
    """
    out = list(chances)
    classes: dict[int, list[int]] = {}
    for item, size in enumerate(sizes):
        classes.setdefault(size.bit_length(), []).append(item)
    rest, owed = sum(sizes), 0.0
    for size_class in sorted(classes, reverse=True):
        items = classes[size_class]
        more = owed / rest if rest else 0.0
        own = [sizes[i] for i in items]
        moved = [min(1.0, max(0.0, chances[i] + more)) for i in items]
        ended = landing(own, flight(own, moved, rng))
        owed += sum(s * (chances[i] - e) for i, s, e in zip(items, own, ended, strict=True))
        rest -= sum(own)
        for i, e in zip(items, ended, strict=True):
            out[i] = e
    return out


def decide(rows: DataFrame, stages: Stages, seed: int = 23, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(row, copies) for rows of (row, at, key, source, size), with source_size and target of each row's source.

    A source's documents are wanted target / source_size times each: the whole part is taken for all, the
    fraction is each one's chance. Chunks of a source are flown apart; the two open rows that each may leave meet again in
    later rounds, until every source is one chunk, in which all is settled. ``key`` and then the place ``at`` order the rows, so runs agree;
    both choose the chunk, so repeated rows are spread.
    """
    sources = stages.save(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), stages=stages), "targets")
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    known = F.broadcast(sources) if few else sources
    rows = rows.join(known.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))).otherwise(F.lit(1.0))
    whole = F.floor(wanted + EPS)
    rows = rows.withColumns({"whole": whole, "chance": F.greatest(wanted - whole, F.lit(0.0)), "held": F.col("n")})
    open_, done = rows, []
    while True:
        chunks = F.ceil(F.col("held") / chunk_rows)
        open_ = open_.withColumns({"chunks": chunks, "chunk": F.pmod(F.xxhash64(F.lit(seed), "key", "at"), chunks)})
        columns = ["row", "at", "key", "source", "size", "source_size", "target", "whole", "chance", "chunks"]
        schema = "row string, at long, key long, source string, size long, source_size long, target double, whole long, chance double, chunks long"
        flown = open_.select(*columns, "chunk").groupBy("source", "chunk").applyInPandas(_flown(columns, seed), schema)
        flown = stages.save(flown, "flown")
        still = F.col("chance").between(EPS, 1 - EPS)
        done.append(flown.where(~still))
        left = flown.where(still)
        if left.isEmpty():
            break
        held = left.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("held"))
        held = F.broadcast(held) if few else held
        open_ = left.join(held, F.col("source").eqNullSafe(F.col("s"))).drop("s", "chunks")
        seed += 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select("row", "source", "size", "source_size", "target", (F.col("whole") + F.round("chance").cast("long")).alias("copies"))


def _flown(columns: list[str], seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "at"], kind="stable")
        rng = random.Random(f"{seed}/{group['source'].iloc[0]}/{group['chunk'].iloc[0]}")
        sizes, chances = group["size"].tolist(), group["chance"].tolist()
        chances = (settle if group["chunks"].iloc[0] == 1 else flight)(sizes, chances, rng)
        return group.assign(chance=chances)[columns]

    return run


def _sized(rows: DataFrame, seed: int, *others: Column) -> DataFrame:
    """What ``decide`` reads of rows of (row, at, doc_id, text, source)."""
    text = F.col("text").cast("string")
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(text, F.lit("")))
    return rows.select("row", "at", key.alias("key"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), *others)


def taken_words(docs: DataFrame, seed: int = 23, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The mix's account, one row per row of ``docs``: doc_id, size, source_size, target, taken.

    A null text has size 0, null is a source of its own, repeated rows count each, an empty table gives no
    rows. Other columns are not read.
    """
    stages = Stages(docs.sparkSession, "mixing")
    ship_package(docs.sparkSession)
    number = F.monotonically_increasing_id()
    row, at = row_place(docs) or (number.cast("string"), number)
    rows = docs.select(row.alias("row"), at.alias("at"), "doc_id", "text", "source")
    rows = stages.save(_sized(rows, seed, F.col("doc_id")), "rows")
    found = decide(rows.drop("doc_id"), stages, seed, chunk_rows)
    found = found.join(rows.select("row", "doc_id"), "row")
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = 23, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The mixed rows with all columns of ``docs``, whatever their names; a row taken more than once is repeated.

    Rows are taken as in ``taken_words``; rows without words are taken as their source's share says. A table
    of Parquet files isn't copied: the rows' copies are broadcast to it up to ``BROADCAST_ROWS``, and joined by row beyond.
    """
    stages = Stages(docs.sparkSession, "mixing")
    ship_package(docs.sparkSession)
    rows = numbered(docs)
    sized = stages.save(_sized(rows.select("row", "at", "doc.doc_id", "doc.text", "doc.source"), seed), "rows")
    found = decide(sized, stages, seed, chunk_rows).where("copies > 0").select("row", F.col("copies").cast("int").alias("copies"))
    found = stages.save(found, "copies")
    stages.keep_only(found)
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return rows.join(found, "row").select("doc", copies.alias("copy")).select("doc.*")
