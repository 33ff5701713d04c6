"""Secret scan: patterns and character Markov models (operator 6). DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askquarry.functions.arrays import evaluate_once

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_ACCESS, MIN_VALUE = 16, 8

#: What the Markov models look at: runs of these characters, letters alone or digits alone too. Shorter ones hold too few pairs.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: A candidate is random when its log-likelihood ratio is so many times the square root of its character pairs;
#: the ratio of one pair has a standard deviation of about one, so a short run needs more per pair than a long one.
ERRORS = 2.5

# Words that ordinary identifiers are made of.
PARTS = (
    "account address array author base batch block buffer build cache change channel char check child class client "
    "close code column command config content context count create current data date default delete depth device "
    "document domain driver element engine error event export factory field file filter format frame group handler "
    "header height image import index input instance item language length library limit line list loader local lock "
    "manager matrix member memory message method model module monitor name network node number object offset option "
    "order output package page parent parser path pattern percent player point position prefix process project "
    "property query queue random range reader record region remote render report request resource response result "
    "return sample schema screen script search section select sender sequence server service session shape signal "
    "size socket source state status storage stream string style submit system table target task template text thread "
    "time title total track transfer type update upload user value vector version view width window worker write"
).split()


def labelled_samples(spark: SparkSession, n: int = 20_000) -> DataFrame:
    """(text, random): digests in several writings, and identifiers put together from words."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.rtrim(F.lit("="), F.base64(F.unhex(digest)))
    writings = F.array(digest, base64, F.substring(base64, 1, 24), F.upper(digest), F.md5(F.col("id").cast("string")))
    random = spark.range(n).select(F.get(writings, (F.col("id") % 5).cast("int")).alias("text"), F.lit(True).alias("random"))
    parts = F.array(*map(F.lit, PARTS))
    part = [F.get(parts, F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(PARTS))).cast("int")) for k in range(4)]
    number = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(3000)).cast("string")
    joined = [F.concat_ws("_", *part), F.concat_ws("-", *part[:3], number), F.concat(part[0], *map(F.initcap, part[1:])), F.concat_ws("_", *map(F.upper, part[:3]), number), F.concat_ws("/", *part[:3])]
    usual = spark.range(n).select(F.get(F.array(*joined), (F.col("id") % len(joined)).cast("int")).alias("text"), F.lit(False).alias("random"))
    return random.union(usual)


def pair_ratios(samples: DataFrame) -> list[float]:
    """log P(next | character, random) - log P(next | character, ordinary) for all pairs of the alphabet, smoothed.

    Counted in Spark from labelled (text, random); the table of at most 68 x 68 numbers comes to the driver.
    """
    chars = samples.where("text is not null").select("random", F.split("text", "").alias("c"))
    pairs = F.when(F.size("c") > 1, F.transform(F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.concat(F.get("c", i), F.get("c", i + 1))))
    counted = chars.select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count().collect()
    side = len(ALPHABET) + 1
    counts = {label: [[1.0] * side for _ in range(side)] for label in (True, False)}
    for r in counted:
        a, b = (ALPHABET.find(x) + 1 for x in (r["pair"][:1], r["pair"][1:]))
        counts[r["random"]][a][b] += r["count"]
    logs = {label: [[math.log(x / sum(row)) for x in row] for row in table] for label, table in counts.items()}
    return [logs[True][a][b] - logs[False][a][b] for a in range(side) for b in range(side)]


def is_random(token: Column, ratios: list[float], errors: float = ERRORS) -> Column:
    """Whether the summed ratio over the character pairs of a token is above its error."""
    side = len(ALPHABET) + 1
    table = F.array(*map(F.lit, ratios))
    codes = F.transform(F.split(token, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, code: Column) -> Column:
        more = F.when(acc["last"] >= 0, F.get(table, acc["last"] * side + code)).otherwise(0.0)
        return F.struct(code.alias("last"), (acc["sum"] + more).alias("sum"), (acc["n"] + 1).alias("n"))

    return F.aggregate(codes, start, step, lambda acc: acc["sum"] >= F.lit(errors) * F.sqrt(F.greatest(acc["n"] - 1, F.lit(1))))


def _spans(text: Column, pattern: str, kind: str, value: int = 0) -> Column:
    """Leftmost matches as (start, rank, kind, end, value), by the texts between them; code points."""
    regex = F.lit(pattern)
    lengths = F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, regex, 0).alias("hit"), F.regexp_extract_all(text, regex, value).alias("value")), lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("hit"), z["value"].alias("value")))

    def total(spans: Column) -> Column:
        return F.aggregate(spans, F.lit(0), lambda acc, z: acc + z["gap"] + z["hit"])

    def placed(all_: Column) -> Column:
        # sums up to a match by runs of about sqrt(n) matches, so that a text of very many stays cheap
        run = F.ceil(F.sqrt(F.size(all_))).cast("int")
        runs = F.transform(F.sequence(F.lit(1), F.size(all_), run), lambda k: F.slice(all_, k, run))
        return evaluate_once(runs, in_runs)

    def in_runs(runs: Column) -> Column:
        def with_sums(sums: Column) -> Column:
            before = lambda k: F.aggregate(F.slice(sums, 1, k), F.lit(0), lambda acc, x: acc + x)
            return F.flatten(F.transform(runs, lambda spans, k: in_run(spans, before(k))))

        return evaluate_once(F.transform(runs, total), with_sums)

    def in_run(spans: Column, before: Column) -> Column:
        return F.transform(spans, lambda z, i: one(z, before + total(F.slice(spans, 1, i))))

    def one(z: Column, before: Column) -> Column:
        start = before + z["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), (start + z["hit"]).alias("end"), z["value"].alias("value"))

    found = F.filter(evaluate_once(lengths, placed), lambda s: s["end"].isNotNull())
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(empty)


def scan(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base (array) and spans (array).

    Base spans are leftmost matches of the patterns; assignments with too short a value and short access
    keys are dropped after matching. The method adds runs of at least 12 characters that follow each other as in random
    strings rather than in identifiers (``is_random``). Spans are ordered by start,
    then kind. A span is (start, rank, kind, end, value), in code points, end exclusive. Null counts as empty, repeated rows get equal
    results, an empty table gives no rows, and texts of any length are read whole. One pass over
    the rows, no shuffle; other columns are not read. ``samples`` are labelled rows (text, random).
    """
    spark = docs.sparkSession
    ratios = pair_ratios(samples if samples is not None else labelled_samples(spark))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.filter(_spans(F.col("text"), ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= MIN_VALUE).alias("assign"),
        F.filter(_spans(F.col("text"), ACCESS, "access"), lambda s: s["end"] - s["start"] >= MIN_ACCESS).alias("access"),
        _spans(F.col("text"), HEX, "hex").alias("hex"),
        _spans(F.col("text"), CANDIDATE, "markov").alias("candidates"),
    )
    drawn = F.filter("candidates", lambda s: is_random(s["value"], ratios))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    rows = rows.select("doc_id", *counts, F.array_sort(F.concat(*KINDS[:3])).alias("base"), F.when(F.size("candidates") > 0, drawn).otherwise(F.col("candidates")).alias("markov"))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS[:3]], "base", F.array_sort(F.concat("base", "markov")).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
