"""Exact deduplication by deterministic block naming (operator 7). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askquarry.llm.common import Stages, ascii_lower, numbered, partitions

#: Characters of a block.
BLOCK = 1024
#: Names of one bucket are below this, so bucket and rank make one integer.
RANKS = 1 << 40


def _name(rows: DataFrame, cols: list[str], stages: Stages, label: str) -> DataFrame:
    """``rows`` (row, pos and others) with the value ``cols`` replaced by its integer ``name``.

    Equal values get equal names and different values different ones: values are hashed into buckets only to
    spread them; within a bucket they are sorted and numbered by comparison. A value may hold a
    third of all rows, so a bucket is first numbered in parts, split by row, and only the first row of each
    value and part goes on to be numbered in the bucket.
    """
    n = partitions(rows.sparkSession)
    near = Window.partitionBy("bucket", "part").orderBy(*cols)
    same: Column = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(near))
    split = rows.withColumns({"bucket": F.pmod(F.xxhash64(*cols), F.lit(4 * n)), "part": F.pmod(F.xxhash64("row"), F.lit(n))})
    ranked = split.withColumns({"rank": F.dense_rank().over(near), "leads": ~(same & (F.row_number().over(near) > 1))})
    ranked = stages.save(ranked.withColumns({c: F.when(F.col("leads"), F.col(c)) for c in cols}), f"{label}-parts")
    stages.release()
    leads = ranked.where("leads").select("bucket", "part", "rank", *cols)
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*cols))
    names = leads.select("bucket", "part", "rank", (F.col("bucket") * RANKS + rank).alias("name"))
    named = stages.save(ranked.drop(*cols, "leads").join(names, ["bucket", "part", "rank"]).drop("bucket", "part", "rank"), f"{label}-names")
    stages.drop(ranked)
    return named


def identities(docs: DataFrame, stages: Stages, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, text_sha256, level, name): texts are equal exactly when level and name are.

    Blocks of ``block`` characters get names; then adjacent names are paired and the pairs named, until
    one name per document is left. The last of an odd number is paired with null.
    """
    norm = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select("row", "doc_id", norm.alias("norm"))
    blocks = F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), 0)
    rows = rows.select("row", "doc_id", F.sha2("norm", 256).alias("sha"), F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(blocks).alias("blocks"))
    rows = rows.select("row", "doc_id", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
    first = F.col("pos") == 0
    rows = rows.withColumns({c: F.when(first, F.col(c)) for c in ("doc_id", "sha")})
    named = _name(rows, ["block"], stages, "blocks")
    heads = named.where("pos = 0").select("row", "doc_id", F.col("sha").alias("text_sha256"))
    level, longest, ended = 0, named.agg(F.max("n")).first()[0] or 0, []
    named = named.select("row", "n", "pos", "name")
    while True:
        ended.append(named.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        half = F.floor(F.col("pos") / 2).alias("pos")
        side = [F.max(F.when(F.col("pos") % 2 == k, F.col("name"))).alias(c) for k, c in enumerate(("left", "right"))]
        pairs = named.where("n > 1").groupBy("row", "n", half).agg(*side)
        pairs = pairs.withColumn("n", F.ceil(F.col("n") / 2).cast("int"))
        level, longest = level + 1, -(-longest // 2)
        named = _name(pairs, ["left", "right"], stages, f"level-{level}")
    found = ended[0]
    for more in ended[1:]:
        found = found.union(more)
    return heads.join(found, "row")


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest doc_id stays, a null doc_id being smaller than any other; of several such rows one stays. Other
    columns are not read. ``row`` numbers the rows of this run.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return _grouped(rows, block, Stages(docs.sparkSession, "exact"))


def _grouped(named: DataFrame, block: int, stages: Stages) -> DataFrame:
    rows = stages.save(identities(named, stages, block), "identities")
    best = F.max(F.struct("doc_id", "row"))
    groups = stages.save(rows.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "groups")
    found = rows.join(groups, ["level", "name"])
    kept = F.col("row") == F.col("best.row")
    return found.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "row")


def deduplicated(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows that stay, with all columns of ``docs``, whatever their names.

    Of equal texts, null being empty, the row with the largest doc_id stays, of repeated rows with that id one;
    an empty table gives no rows, and a text of any length is compared whole. A table of Parquet
    files isn't copied: only the names of the rows that go are written.
    """
    stages = Stages(docs.sparkSession, "exact-kept")
    rows = numbered(docs)
    found = _grouped(rows.select("row", "doc.doc_id", "doc.text"), block, stages)
    gone = stages.save(found.where("not kept").select("row"), "gone")
    stages.keep_only(gone)
    return rows.join(gone, "row", "left_anti").select("doc.*")
