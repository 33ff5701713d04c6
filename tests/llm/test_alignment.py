"""Token alignment against brute force over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from askquarry.llm import alignment
from askquarry.llm.packing import _byte_letters

SCHEMA = "doc_id long, text string, row string, pair string, links string"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """The contract's columns, from both tokenizers over whole texts."""
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = _byte_letters()
    docs, counts = [], Counter()
    for doc_id, text, *_ in rows:
        full = " " + (text or "")
        ids_a, ids_b = a.encode(full, add_special_tokens=False).ids, b.encode(text or "")
        parts_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(parts_a) != full.encode() or b"".join(parts_b) != full.encode():
            docs.append((doc_id, [], [], [], []))
            continue
        ranges = []
        for parts in (parts_a, parts_b):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            ranges.append(own)
        ends = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups, start = [], 0
        for end in ends:
            groups.append(tuple([i for i, (s, e) in zip(ids, own, strict=True) if start <= s and e <= end] for ids, own in ((ids_a, ranges[0]), (ids_b, ranges[1]))))
            start = end
        links = [(i, j) for i, (s, e) in zip(ids_a, ranges[0], strict=True) for j, (u, v) in zip(ids_b, ranges[1], strict=True) if s < v and u < e]
        counts.update(links)
        docs.append((doc_id, ids_a, ids_b, groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    out = []
    for doc_id, ids_a, ids_b, groups, links in docs:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(told.encode()).hexdigest() if ids_a else ""
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def made_up():
    rng = random.Random(9)
    alphabet = [*"abcdefgh", " ", "  ", "\n", "\n\n", "\r\n", "\t", " \n", "\n ", "é", "ß", "ñ", "漢字", "🙂", "é", " ", "　", "\x1c", "\x85", "​", "'s", "'ll", "1", "23", ".", "...", "-", "|", "_", "\x00", " the", " and"]
    texts = [None, "", " ", "  ", "\n", "x", " x", "x ", "x\n", "\nx", "two words", "a ▁ sign", "▁", "<|endoftext|> plain </s> <s> <unk> <0x41>", "supercalifragilistic " * 30, "x" * 3000, "漢" * 500, "Hello, World! it's\nNext line\n\n  indented\ttab"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(250)]
    rows = [(k, t, "r", "p", "l") for k, t in enumerate(texts)]
    return [*rows, rows[14], rows[14], (None, texts[-1], None, None, None), (None, None, None, None, None)]


ROWS = made_up()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def tuples(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_alignment_equals_brute_force(docs):
    want = brute(ROWS)
    assert tuples(alignment.aligned(docs)) == want
    # beyond the broadcast the same by joins
    assert tuples(alignment.aligned(docs, broadcast_pairs=0)) == want


def test_memories_may_be_small(docs, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 2)
    aligner = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    for _, text, *_ in ROWS:
        lists = alignment._unit_lists(aligner, [(text or "").encode(), b"again again"])
        assert all(u in aligner.known for units in lists for u in units)


def test_no_documents(spark):
    assert tuples(alignment.aligned(spark.createDataFrame([], SCHEMA))) == []


def test_cuts_of_rising_lists():
    rng = random.Random(1)
    for _ in range(300):
        end = rng.randint(1, 40)
        a, b = (sorted({*rng.sample(range(1, end + 1), rng.randint(1, end)), end}) for _ in range(2))
        a, b = np.array(a), np.array(b)
        in_a, in_b = alignment.shared_cuts(a, b)
        assert a[in_a - 1].tolist() == b[in_b - 1].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        starts = lambda ends: [0, *ends[:-1].tolist()]
        want = [(i, j) for i, (s, e) in enumerate(zip(starts(a), a, strict=True)) for j, (u, v) in enumerate(zip(starts(b), b, strict=True)) if s < v and u < e]
        got = list(zip(*(x.tolist() for x in alignment.overlaps(a, b)), strict=True))
        assert got == want
    nothing = np.zeros(0, np.int64)
    assert [len(x) for x in alignment.shared_cuts(nothing, nothing)] == [0, 0]


def test_long_text_without_common_cuts_is_one_group():
    a, b = np.arange(2, 10_000, 2), np.array([*range(1, 9_998, 2), 9_998])
    assert [x.tolist() for x in alignment.shared_cuts(a, b)] == [[len(a)], [len(b)]]


def test_registered_query(spark, sf_dir):
    from askquarry.llm.queries import QUERIES

    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op13_token_alignment"](spark, sf_dir).collect()
    assert len(got) == texts.count() and all(r["n_links"] >= max(r["n_a"], r["n_b"]) >= r["n_groups"] > 0 for r in got)
    total = sum(r["n_links"] for r in got)
    counts = alignment.pair_counts(texts).collect()
    assert sum(r["n"] for r in counts) == total and sum(r["n"] ** 2 for r in counts) == sum(r["count_sum"] for r in got)
