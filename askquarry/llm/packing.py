"""Best-fit packing of token sequences (operator 1)."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.llm.common import Stages
from askquarry.session import ship_package

CAPACITY = 1024
END_ID = 2
#: A bin with at most this many free places is emitted at once.
NEARLY_FULL = 2
#: Underfull bins that one task of a merge round takes.
MERGE_ITEMS = 200_000
#: Cached units of text in a Python worker.
CACHE_UNITS = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBERS = "members array<struct<doc_id: long, piece: int, start: long, length: long, ids_crc32: long>>"


# --- tokens ---------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones as they are, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Token ids of texts by a ``tokenizers`` file of byte-level pairs, as little-endian 32-bit bytes.

    The splitting pattern always cuts before a space that a visible character follows, so a
    text's ids are those of its units " word" one after another; every unit is
    encoded once and remembered. ``tiktoken`` merges the same vocabulary several times faster, so units go
    through it; texts with a special token's string are encoded whole by ``tokenizers``.
    """

    # A space that doesn't start a unit for certain, such as the first of two.
    UNSURE = re.compile(r" (?![!-~\w])")
    CUT = re.compile(r"(?= [!-~\w])")

    def __init__(self, path: str):
        import numpy as np
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        letters = _byte_letters()
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in self.tokenizer.get_vocab(False).items() if t not in special}
        self.pairs = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if self.special.search(text):
            return _packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.UNSURE.search(text):
            head, *units = [u for u in self.CUT.split(text) if u] or [""]
            tail = [u[1:] for u in units]
        else:
            head, *tail = text.split(" ")
        if len(self.later) > CACHE_UNITS or len(self.first) > CACHE_UNITS:
            self.later.clear()
            self.first.clear()
        if head not in self.first:
            self.first[head] = _packed_ids(self.pairs.encode_ordinary(head))
        try:
            return self.first[head] + b"".join(map(self.later.__getitem__, tail))
        except KeyError:
            self._learn([u for u in set(tail) if u not in self.later])
        return self.first[head] + b"".join(map(self.later.__getitem__, tail))

    def _learn(self, units: list[str]) -> None:
        """Encode new units in one call, and cut the ids where the units' bytes end."""
        import numpy as np

        ids = np.array(self.pairs.encode_ordinary(" " + " ".join(units)), "<u4")
        ends = np.cumsum([1 + len(u.encode()) for u in units])
        cuts = 4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)
        found, at = ids.tobytes(), 0
        for unit, cut in zip(units, cuts.tolist(), strict=True):
            self.later[unit] = found[at:cut]
            at = cut


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of each piece: full ones, but for the first where the length isn't a multiple."""
    first = length % capacity or capacity
    return [(0, first), *((s, s + capacity) for s in range(first, length, capacity))]


def tokenized(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32 and, on request, ids.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Other columns are
    not read. Repeated rows are pieces of their own. ``tokenizer`` is the path of a vocabulary file,
    public_tokenizers' byte_bpe_50k.json if None.
    """
    ship_package(docs.sparkSession)
    schema = PIECES + (", ids array<long>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        if tokenizer:
            path = tokenizer
        else:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        encoder = _encoder(path)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encoder.encode(text.as_py() or "") + end_id.to_bytes(4, "little")
                for k, (start, end) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * end]
                    row = [doc_id, k, start, end - start, zlib.crc32(part)]
                    row += [np.frombuffer(part, "<u4")] if with_ids else []
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            arrays = [pa.array(c, t) for c, t in zip(out, types[: len(names)], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


# --- bins -----------------------------------------------------------------------------


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still holds it.

    The bins' free places are bits of one integer, so the fullest fitting bin is its
    lowest set bit from the item's length on.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins = 0, []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fitting = open_rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        if room > n:
            by_room[room - n].append(at)
            open_rooms |= 1 << (room - n)
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, stages: Stages | None = None, merge_items: int = MERGE_ITEMS) -> DataFrame:
    """Pieces with sequence_id and offset.

    ``pieces`` has doc_id, piece, start, length and ids_crc32; no length is above the capacity. Hierarchical
    residual packing: each partition packs its pieces best-fit, longest first, and emits
    nearly full bins; underfull bins are the items of the next round, which has one task for every
    ``merge_items`` of them, so the rounds form a tree. Rounds end when one task has
    held all that was left, or when a round has closed less than a hundredth of its bins; what remains is
    emitted as it is. So every piece is placed, and no task holds more than about
    ``merge_items`` at once. Ties in length go by the order of the stored rows,
    which a repeated task reads again unchanged. No pieces give no rows.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    stages = stages or Stages(spark, "packing")
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    items = pieces.select(F.array(member).alias("members"), F.col("length").cast("long").alias("used"))
    done, number, last, before = [], 0, False, 0
    while True:
        packed = stages.save(items.mapInArrow(_round(capacity, number, last, merge_items), f"{MEMBERS}, offsets array<long>, used long, sequence_id long"), f"bins-{number}")
        done.append(packed.where(F.col("sequence_id").isNotNull()))
        if last:
            break
        left = packed.where(F.col("sequence_id").isNull()).select("members", "used")
        count, number = left.count(), number + 1
        tasks = -(-count // merge_items)
        last = tasks <= 1 or (number > 1 and count > 0.99 * before)
        before = count
        items = left.repartition(max(1, tasks))
        items = stages.save(items, f"left-{number}") if tasks > 1 else items
    bins = done[0]
    for more in done[1:]:
        bins = bins.union(more)
    flat = bins.select("sequence_id", F.explode(F.arrays_zip("members", "offsets")).alias("z"))
    return flat.select("z.members.*", "sequence_id", F.col("z.offsets").alias("offset"))


def _round(capacity: int, number: int, last: bool, merge_items: int):
    """Best-fit over a partition, ``merge_items`` items at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, base = [], 0, (number << 56) + (TaskContext.get().partitionId() << 32)
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= merge_items:
                yield from (out := _packed(held, capacity, base, last))
                base += sum(b.num_rows for b in out)
                held, rows = [], 0
        if rows:
            yield from _packed(held, capacity, base, last)

    return run


def _packed(batches: list[pa.RecordBatch], capacity: int, base: int, last: bool) -> list[pa.RecordBatch]:
    import numpy as np
    import pyarrow.compute as pc

    table = pa.Table.from_batches(batches).combine_chunks()
    # rows that came over the network arrive in any order
    first = pc.list_element(table["members"], 0)
    keys = {k: pc.struct_field(first, k) for k in ("doc_id", "piece", "start", "ids_crc32")}
    order = pc.sort_indices(pa.table({"used": table["used"], **keys}), [(k, "ascending") for k in ("used", *keys)])
    table = table.take(order)
    used = table["used"].to_pylist()
    bins = best_fit(used, capacity)
    sums = [sum(used[i] for i in b) for b in bins]
    members = pa.concat_arrays(table["members"].take(pa.array([i for b in bins for i in b], pa.int64())).chunks)
    sizes = pc.list_value_length(members).to_numpy()
    per_bin = np.add.reduceat(sizes, np.cumsum([0, *map(len, bins[:-1])]))
    ends = np.concatenate([[0], np.cumsum(per_bin)])
    flat = members.flatten()
    lengths = pc.struct_field(flat, "length").to_numpy()
    before = np.cumsum(lengths) - lengths
    offsets = pa.array(before - np.repeat(before[ends[:-1]], per_bin), pa.int64())
    at = pa.array(ends, pa.int32())
    ids = [base + k if last or capacity - s <= NEARLY_FULL else None for k, s in enumerate(sums)]
    columns = [pa.ListArray.from_arrays(at, flat), pa.ListArray.from_arrays(at, offsets), pa.array(sums, pa.int64()), pa.array(ids, pa.int64())]
    whole = pa.RecordBatch.from_arrays(columns, names=["members", "offsets", "used", "sequence_id"])
    return [whole.slice(k, 20_000) for k in range(0, whole.num_rows, 20_000)]


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, merge_items: int = MERGE_ITEMS
) -> DataFrame:
    """Each piece of each document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and has the end id alone; null ids and repeated rows are packed each, other columns are not read,
    a very long text is cut into pieces, an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "packing")
    pieces = stages.save(tokenized(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, stages, merge_items)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed token ids: sequence_id and ids, made by encoding the documents again.

    Joined by doc_id and piece, so the doc_ids have to be unique here.
    """
    ids = tokenized(docs, tokenizer, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids")
    parts = placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
