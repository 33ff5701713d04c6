"""Uniform shuffle into shards of exact sizes (operator 10). DataFrame functions only."""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askquarry.llm.common import Stages

SHARDS = 40
#: Source partitions that the matrix has at most; the driver holds its numbers, never rows.
SOURCES = 4096
#: Rows that one task permutes, about; the keys of a larger shard are sorted in several blocks.
BLOCK_ROWS = 5_000_000
#: Numbers of the matrix that are broadcast at most (8 bytes each).
BROADCAST_NUMBERS = 1_000_000


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` of ``good + bad``, at any size.

    Exact inversion around the mode: outcomes are tried outwards from the likeliest, each with its
    own probability, until a uniform number is used up.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    left = rng.random() - at_mode
    below = above = mode
    p_below = p_above = at_mode
    while left > 0 and (below > low or above < high):
        if below > low:
            p_below *= below * (bad - draws + below) / ((good - below + 1) * (draws - below + 1))
            below -= 1
            left -= p_below
            if left <= 0:
                return below
        if above < high:
            p_above *= (good - above) * (draws - above) / ((above + 1) * (bad - draws + above + 1))
            above += 1
            left -= p_above
            if left <= 0:
                return above
        if p_below + p_above < 1e-300:
            break
    return mode


def communication_matrix(rng: random.Random, sources: list[int], targets: list[int]) -> list[list[int]]:
    """Counts from each source to each target, as a uniform permutation would have them."""
    room, matrix = list(targets), []
    for count in sources:
        left, rest, row = count, sum(room), []
        for k, free in enumerate(room):
            rest -= free
            taken = hypergeometric(rng, free, rest, left)
            row.append(taken)
            room[k] -= taken
            left -= taken
        matrix.append(row)
    return matrix


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row's shard and slot: doc_id, size, text_crc32, shard, slot.

    A uniform shuffle under the law ``rows``: counts are at most one apart. Rows are dealt in four steps:
    exact counts from source partitions to shards are drawn, each source is permuted, its next counts of rows
    go to the shards, and each shard is permuted again, so slots are gapless from 0. Permuting is sorting by random keys; the
    blocks of a large shard are stretches of its keys, whose counts say where each begins. Sources are the partitions
    of the scan, so no key of the data can make one large; the matrix has a number per source and shard, however many
    rows there are. A null text counts as empty, null ids and repeated rows are
    rows like any other, other columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), "doc_id", text)
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("key"), F.spark_partition_id().alias("split"))
    rows = stages.save(rows.withColumn("source", F.pmod(F.col("split") * 8 + F.pmod("key", F.lit(8)), F.lit(SOURCES)).cast("int")).drop("split"), "rows")
    counts = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    sources, total = sorted(counts), sum(counts.values())
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    blocks = max(1, -(-max(sizes) // block_rows))
    matrix = communication_matrix(random.Random(seed), [counts[s] for s in sources], sizes)
    bounds = spark.createDataFrame([(s, list(accumulate(row))) for s, row in zip(sources, matrix, strict=True)], "source int, ends array<long>")
    if len(sources) * shards <= BROADCAST_NUMBERS:
        bounds = F.broadcast(bounds)
    order = ["doc_id", "size", "text_crc32"]
    rank = F.row_number().over(Window.partitionBy("source").orderBy("key", *order)) - 1
    sent = rows.withColumn("rank", rank).join(bounds, "source")
    number = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    sent = sent.select(*order, F.xxhash64(F.lit(seed + 1), "key").alias("key"), number.alias("shard"))
    block = F.shiftright(F.shiftrightunsigned("key", 33) * F.lit(blocks).cast("long"), 31).cast("int")
    sent = stages.save(sent.withColumn("block", block), "sent")
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "block").count()
    starts = starts.select("shard", "block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    if shards * blocks <= BROADCAST_NUMBERS:
        starts = F.broadcast(starts)
    place = F.row_number().over(Window.partitionBy("shard", "block").orderBy("key", *order)) - 1
    placed = sent.withColumn("place", place).join(starts, ["shard", "block"])
    return placed.select(*order, "shard", (F.col("start") + F.col("place")).alias("slot"))
