"""Near duplicates by SetSketch registers (operator 5).

A text is the set of its word shingles. Register i of its sketch is the least of an exponential
variable over the set, on a logarithmic scale and cut to 16 bits, so registers of a union are the lesser ones
and equal registers are as frequent as shared elements. Bands of registers name the buckets in which candidates
meet; the registers of a pair then give its likeliest similarity, and pairs that may reach the
threshold are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.llm import rolling
from askquarry.llm.common import Stages, ascii_lower, numbered, text_key
from askquarry.llm.graph import components
from askquarry.session import ship_package

#: Sketches of one block that are compared with those of another in a task.
BLOCK = 512
#: Nodes whose text keys, 24 bytes each, are broadcast to the texts; more meet them in a shuffle.
BROADCAST_NODES = 2_000_000
#: Row pairs of a group that are looked at together.
PAIRS = 50_000


@dataclass(frozen=True)
class Near:
    """Parameters. A pair at the threshold is missed with probability (1 - threshold ** rows) ** bands:
    7e-8 at 0.85. ``margin`` is over five standard deviations of the estimate below the threshold."""

    shingle: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 28
    base: float = 1.001
    rate: float = 20.0
    margin: float = 0.2

    @property
    def registers(self) -> int:
        return self.rows * self.bands


#: The contract of the registered query; the default is that of the pipeline.
WORDS_3 = Near(shingle=3, percent=85)
WORDS_5 = Near(bands=40)


# --- sets and sketches -----------------------------------------------------------------


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text; of a shorter one the hash of its words; without words, none."""
    words, counts = rolling.grouped_words(texts)
    whole = rolling.window_hashes(words, size, rolling.BASES[1])
    at = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(whole[at : at + n - size + 1])
        elif n:
            yield rolling.window_hashes(words[at : at + n], n, rolling.BASES[1])
        else:
            yield np.zeros(0, np.uint64)
        at += n


def registers(elements: np.ndarray, near: Near) -> np.ndarray:
    """Register i: floor(1 - log_base(least of rate-exponential variables)), within 16 bits."""
    rng = np.random.default_rng(5)
    by = rng.integers(0, 1 << 63, near.registers, np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, near.registers, np.uint64)
    least = np.full(near.registers, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(elements), 2048):
        np.minimum(least, (elements[k : k + 2048, None] * by + plus).min(axis=0), out=least)
    uniform = ((least >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    value = -np.log1p(-uniform) / near.rate
    return np.clip(np.floor(1 - np.log(value) / np.log(near.base)), 0, 65535).astype("<u2")


SKETCHES = "doc_id long, k1 long, k2 long, s1 long, s2 long, n long, regs binary, bands array<long>"


def _sketched(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in rolling.text_groups(batches, rolling.GROUP_BYTES):
            out: list[list] = [[] for _ in range(5)]
            for elements in shingle_sets(texts, near.shingle):
                name = np.frombuffer(hashlib.blake2b(elements.tobytes(), digest_size=16).digest(), "<i8")
                regs, bands = None, None
                if len(elements):
                    sketch = registers(elements, near)
                    regs = sketch.tobytes()
                    width = 2 * near.rows
                    bands = [int.from_bytes(hashlib.blake2b(bytes([b]) + regs[b * width : (b + 1) * width], digest_size=8).digest(), "little", signed=True) for b in range(near.bands)]
                for column, value in zip(out, (int(name[0]), int(name[1]), len(elements), regs, bands), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            arrays = [rows["doc_id"], rows["k1"], rows["k2"], *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SKETCHES.split(", ")])

    return run


# --- pairs -----------------------------------------------------------------------------


def likely(above: np.ndarray, below: np.ndarray, na: np.ndarray, nb: np.ndarray, near: Near) -> np.ndarray:
    """The likeliest similarity of pairs from their counts of larger, smaller and (the rest) equal registers.

    With shares u and v of the two set sizes, a register is larger with probability p(u - v j) and smaller
    with p(v - u j), p(x) = -log_b(1 - x (b - 1) / b); the joint likelihood is maximised over a grid of j.
    """
    u, v = na / (na + nb), nb / (na + nb)
    b, best, at = near.base, np.full(len(above), -np.inf), np.zeros(len(above))
    equal = near.registers - above - below
    for j in np.linspace(0, 1, 41):
        more = -np.log1p(-np.clip(u - v * j, 1e-12, 1) * (b - 1) / b) / np.log(b)
        less = -np.log1p(-np.clip(v - u * j, 1e-12, 1) * (b - 1) / b) / np.log(b)
        fit = above * np.log(more) + below * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))
        at = np.where((fit > best) & (np.minimum(u, v) >= j * np.maximum(u, v) - 1e-9), j, at)
        best = np.maximum(best, np.where(np.minimum(u, v) >= j * np.maximum(u, v) - 1e-9, fit, -np.inf))
    return at


def _promising(near: Near):
    """Pairs whose likeliest similarity is not below the threshold by more than the margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("ra", "rb"))
            j = likely((a > b).sum(1), (a < b).sum(1), batch["na"].to_numpy(), batch["nb"].to_numpy(), near)
            yield batch.select(["a", "b"]).filter(pa.array(j >= near.percent / 100 - near.margin))

    return run


def _similar(x: np.ndarray, y: np.ndarray, near: Near) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= near.percent * (len(x) + len(y) - both)


def _confirmed(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["ea"], batch["eb"], strict=True):
                x, y = (np.frombuffer(e.as_buffer(), "<u8") for e in (x, y))
                good.append(_similar(x, y, near))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _group_pairs(side: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of every group [cut, next cut): side 1 with side 0, else with side 2, else with itself."""
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = side[start:end]
        left = np.flatnonzero(own == 1)
        right = np.flatnonzero(own == 0)
        if not len(right):
            right = np.flatnonzero(own == 2)
        step = max(1, PAIRS // max(1, len(right)))
        for k in range(0, len(left), step):
            part = left[k : k + step]
            if len(right):
                yield start + np.repeat(part, len(right)), start + np.tile(right, len(part))
            else:
                i, j = np.repeat(part, len(left)), np.tile(left, len(part))
                yield start + i[i < j], start + j[i < j]


GROUP = ["bucket", "i", "j", "what"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by group as tables of whole groups, with the rows at which groups begin and the last ends."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = np.stack([table[c].to_numpy() for c in GROUP], 1)
        cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        if len(cuts) > 1:
            yield table.slice(0, cuts[-1]), cuts
        rest = table.slice(cuts[-1]).combine_chunks()
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _likely_pairs(table: pa.Table, cuts: np.ndarray, near: Near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of groups that may be similar and are in different components, likeliest first within a part.

    A pair that meets in several buckets is named in that of its first equal band only.
    """
    comp, n, side, band = (table[c].to_numpy() for c in ("comp", "n", "side", "band"))
    regs = np.frombuffer(b"".join(table["regs"].to_pylist()), "<u2").reshape(table.num_rows, -1)
    held, count = [], 0

    def tested() -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        fits = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= near.percent * np.maximum(n[i], n[j]))
        i, j = i[fits], j[fits]
        first = (regs[i] == regs[j]).reshape(len(i), near.bands, near.rows).all(2).argmax(1) == band[i]
        i, j = i[first], j[first]
        similar = likely((regs[i] > regs[j]).sum(1), (regs[i] < regs[j]).sum(1), n[i], n[j], near)
        order = np.argsort(-similar, kind="stable")
        order = order[similar[order] >= near.percent / 100 - near.margin]
        return i[order], j[order]

    for found in _group_pairs(side, cuts):
        held.append(found)
        count += len(found[0])
        if count >= 50_000:
            yield tested()
            held, count = [], 0
    if held:
        yield tested()


def _paired(near: Near):
    """The rows that are in any likely pair of their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in _whole_groups(batches):
            seen = np.zeros(table.num_rows, bool)
            for i, j in _likely_pairs(table, cuts, near):
                seen[i] = seen[j] = True
            yield from table.filter(pa.array(seen)).combine_chunks().to_batches()

    return run


def _joined(near: Near):
    """Links that join the components of a group's likely pairs, confirmed on the full sets.

    Pairs that earlier links of the task have joined already need no test and give no row,
    so a task gives fewer links than it has rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in _whole_groups(batches):
            node, comp = table["node"].to_numpy(), table["comp"].to_numpy().tolist()
            sets = [np.frombuffer(e.as_buffer(), "<u8") for e in table["elements"]]
            above: dict[int, int] = {}
            links: list[tuple[int, int]] = []

            def top(c: int) -> int:
                while c in above:  # halving the path on the way
                    above[c] = above.get(above[c], above[c])
                    c = above[c]
                return c

            for left, right in _likely_pairs(table, cuts, near):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    ci, cj = top(comp[i]), top(comp[j])
                    if ci != cj and _similar(sets[i], sets[j], near):
                        above[ci] = cj
                        links.append((i, j))
            i, j = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])

    return run


def _elements(nodes: DataFrame, sets: DataFrame, docs: DataFrame, near: Near, stages: Stages) -> DataFrame:
    """(node, elements): the full sets of distinct nodes. Their texts are read again, no others kept."""
    wanted = stages.save(nodes.join(sets, "node").select("node", "k1", "k2"), "wanted")
    if wanted.count() <= BROADCAST_NODES:  # texts of no other node are moved
        wanted = F.broadcast(wanted)
    text = F.col("text").cast("string")
    texts = docs.select(*text_key(text), text.alias("text")).join(wanted, ["k1", "k2"]).select("node", ascii_lower(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, own in rolling.text_groups(batches, rolling.GROUP_BYTES):
            yield pa.RecordBatch.from_arrays([rows["node"], pa.array([e.tobytes() for e in shingle_sets(own, near.shingle)], pa.binary())], names=["node", "elements"])

    # rows of one text have one set
    elements = texts.mapInArrow(run, "node long, elements binary").groupBy("node").agg(F.first("elements").alias("elements"))
    elements = stages.save(elements, "elements")
    stages.release()
    return elements


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, near: Near, stages: Stages) -> DataFrame:
    """Of pairs (a, b) of nodes, those similar on their full sets."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    elements = _elements(nodes, sets, docs, near, stages)
    both = pairs.join(elements.toDF("a", "ea"), "a").join(elements.toDF("b", "eb"), "b")
    links = stages.save(both.mapInArrow(_confirmed(near), "a long, b long"), "links")
    stages.drop(elements)
    return links


def near_components(docs: DataFrame, near: Near, stages: Stages) -> DataFrame:
    """(doc_id, k1, k2, n, node, root) for every row: its set's size, its set and the component of its set.

    Equal sets are one node; without words node and root are null. First all of a bucket are held against its
    first node. Buckets whose nodes are then in one component are done: their other pairs
    cannot change it. In the others every pair between different components is estimated within a task: the largest component's nodes
    stay in blocks and the rest visit them. Only rows of likely pairs meet again, with their full sets, and the
    task confirms pairs until its components are joined; pairs are never rows. No link is lost but
    by the sketch's stated chances.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), *text_key(text), ascii_lower(F.coalesce(text, F.lit(""))).alias("text"))
    rows = stages.save(rows.mapInArrow(_sketched(near), SKETCHES), "sketches")
    fixed = [F.first(c).alias(c) for c in ("k1", "k2", "n", "regs", "bands")]
    sets = rows.where("n > 0").groupBy("s1", "s2").agg(*fixed).withColumn("node", F.monotonically_increasing_id())
    sets = stages.save(sets, "sets")
    stages.release()

    banded = sets.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = stages.save(banded.join(hubs.select("bucket", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")), "bucket"), "members")
    stages.release()
    fits = 100 * F.least("n", "hub_n") >= near.percent * F.greatest("n", "hub_n")
    stars = members.where((F.col("node") != F.col("hub")) & fits).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    slim = sets.select("node", "n", "regs")
    both = stars.join(slim.toDF("a", "na", "ra"), "a").join(slim.toDF("b", "nb", "rb"), "b")
    tried = stages.save(both.mapInArrow(_promising(near), "a long, b long"), "stars")
    links = _verified(tried, sets, docs, near, stages)
    stages.drop(tried)

    label = components(links, stages)
    placed = members.join(label.select("node", "root"), "node", "left").select("bucket", "band", "node", "n", F.coalesce("root", "node").alias("comp"))
    placed = stages.save(placed, "placed")
    shares = placed.groupBy("bucket", "comp").agg(F.count("*").alias("share"))
    largest = shares.groupBy("bucket").agg(F.max(F.struct("share", "comp")).alias("m"), F.sum("share").alias("of"))
    mixed = largest.where("of > m.share").select("bucket", F.col("m.comp").alias("main"), F.ceil(F.col("m.share") / BLOCK).alias("mains"), F.ceil((F.col("of") - F.col("m.share")) / BLOCK).alias("rests"))
    left = placed.join(mixed, "bucket").join(slim.drop("n"), "node")
    in_main = F.col("comp") == F.col("main")
    spread = F.xxhash64("node")
    own = F.when(in_main, F.pmod(spread, "mains")).otherwise(F.pmod(spread, "rests"))
    # a task: a block of the rest (1) with one of the main component (0), with another block of the rest (2), or with itself
    visits = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("mains") - 1), lambda k: F.struct(F.col("own").alias("i"), k.alias("j"), F.lit(0).alias("what"), F.lit(1).alias("side")))
    among = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("rests") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"), F.lit(1).alias("what"), F.when(k >= F.col("own"), 1).otherwise(2).alias("side")))
    hosts = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("rests") - 1), lambda k: F.struct(k.alias("i"), F.col("own").alias("j"), F.lit(0).alias("what"), F.lit(0).alias("side")))
    left = left.withColumn("own", own).withColumn("task", F.explode(F.when(in_main, hosts).otherwise(F.concat(visits, among))))
    rows_of = left.select("bucket", "band", "node", "n", "comp", "regs", "task.*")

    def by_group(table: DataFrame) -> DataFrame:
        return table.repartition(*GROUP).sortWithinPartitions(*GROUP)

    paired = stages.save(by_group(rows_of).mapInArrow(_paired(near), rows_of.schema), "paired")
    stages.drop(members, placed)
    if not paired.isEmpty():
        elements = _elements(paired.select("node").distinct(), sets, docs, near, stages)
        more = by_group(paired.join(elements, "node")).mapInArrow(_joined(near), "a long, b long")
        label = components(links.union(stages.save(more, "more")), stages)
        stages.drop(elements, paired)
    named = stages.save(sets.join(label, "node", "left").select("s1", "s2", "node", F.coalesce("root", "node").alias("root")), "named")
    stages.drop(sets)
    return rows.select("doc_id", "k1", "k2", "s1", "s2", "n").join(named, ["s1", "s2"], "left").drop("s1", "s2")


def near_duplicates(docs: DataFrame, near: Near = WORDS_5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and k1, k2 (the text's key).

    component_id is the smallest doc_id that links reach, the row's own included. Rows without words are linked with
    nothing: their component is themselves. Null ids don't count for the smallest; a component without any
    other has a null component_id. Kept are rows whose doc_id is the component_id, nulls being equal. Repeated rows
    get equal results. Other columns are not read.
    """
    stages = Stages(docs.sparkSession, "near")
    rows = stages.save(near_components(docs, near, stages), "rows")
    least = rows.where("root is not null").groupBy(F.col("root")).agg(F.min("doc_id").alias("component_id"))
    found = rows.join(stages.save(least, "least"), "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.withColumn("component_id", component)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "k1", "k2")


def deduplicated(docs: DataFrame, near: Near = WORDS_5) -> DataFrame:
    """One row of every component, with all columns of ``docs``; rows without words all stay.

    The one with the smallest doc_id stays, null last; of repeated rows with that id one. Null and empty texts are without
    words, an empty table gives no rows. A table of Parquet files isn't copied.
    """
    stages = Stages(docs.sparkSession, "near-kept")
    rows = numbered(docs)
    found = near_components(rows.select("doc.doc_id", "doc.text"), near, stages)
    roots = stages.save(found.where("root is not null").select("k1", "k2", "root").distinct(), "roots")
    key = text_key(F.col("doc.text").cast("string"))
    slim = rows.select("row", F.col("doc.doc_id").alias("id"), *key).join(roots, ["k1", "k2"]).select("row", "id", "root")
    slim = stages.save(slim, "rooted")
    first = F.struct(F.col("id").isNull(), "id", "row")
    kept = slim.groupBy("root").agg(F.min(first).alias("first")).select("first.row")
    gone = stages.save(slim.select("row").join(kept, "row", "left_anti"), "gone")
    stages.keep_only(gone)
    return rows.join(gone, "row", "left_anti").select("doc.*")
