"""Packing: every token once, no gap, no sequence too long, and nearly as few as can be."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from grantsieve.llm import packing
from grantsieve.llm.byte_level import ByteLevelEncoder, byte_of_sign
from grantsieve.llm.queries import QUERIES
from grantsieve.llm.tables import written
from grantsieve.llm.token_files import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


ODD = [
    "", " ", "  ", "\n", " \n a", "a  b", "a \n b \n", "x \t y\n\n  z ", "it's I'll 'tis don't", "1,234.5 (a), b)c d).",
    "word<|endoftext|> b", "a  <|endoftext|>", "<|endoftext|>", "Ünï cödé é, ß. ñ!", "日本語 テキスト。 そして", "🙂 🙂🙂 a🙂",
    "a b  c   d", "\x1c a \x1c\x1d b", "a\x85 b", "﻿a b", "end.) ...", "x..., y;:!?", "  lead", "trail  ", "a 's b",
    "​ a​b", "tab\tend ", "a 　b", "é é. á,", "²³ ½ x²,", "__a__ _b_.",
]


def test_ids_are_those_of_whole_texts(tokenizer, spark, small):
    rng = random.Random(3)
    signs = [" ", "  ", "\n", "\t", "a", "Bc", "é", "9", ".", ",", "'", "s", "ll", " ", " ", "日", "🙂", "_", ")", "\x1c", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    enc = ByteLevelEncoder(PATH)
    for _ in range(2):  # the second time from the memo
        got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
        assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    plain = ByteLevelEncoder(PATH, special_as_text=True)
    got = [np.frombuffer(b, plain.dtype).tolist() for b in plain.encode(texts)]
    assert got == [e.ids for e in plain.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [b"".join(plain.token_bytes[i] for i in ids) for ids in got] == [t.encode() for t in texts]
    assert sorted(byte_of_sign().values()) == list(range(256))


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, tokenizer, capacity=2048):
    """rows against documents (doc_id, text): returns the number of sequences."""
    want = defaultdict(int)
    for doc_id, text in docs:
        ids = whole(tokenizer, text)
        first = len(ids) % capacity or capacity
        for k, a in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[a : first + k * capacity]
            want[doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def fewest(sizes, capacity=2048):
    """No packing has fewer: tokens over capacity, and sizes of over half a sequence."""
    return max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


def test_query(spark, small, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = QUERIES["op12_packing"](spark, small).collect()
    n = check(rows, docs, tokenizer)
    assert n <= 1.01 * fewest([r["length"] for r in rows]) + 1


def test_edges(edge, edge_rows, empty, tokenizer):
    rows = packing.pack_documents(edge, PATH).collect()
    check(rows, [r[:2] for r in edge_rows], tokenizer)
    assert packing.pack_documents(empty, PATH).count() == 0


def test_rounds_bring_partitions_together(spark, tokenizer):
    """Partitions with a small document each: alone, every one of them needs a sequence."""
    rng = random.Random(1)
    docs = [(i, "word " * rng.randrange(1, 400)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(100)
    p = packing.Packing(block=7, open_bins=50)
    cut = written(packing.pieces(df, PATH, p), "pieces").repartition(100).select("*")
    packed = written(packing.pack(cut, p), "packed")
    rows = packing.placements(packed).collect()
    n = check(rows, docs, tokenizer)
    assert n <= 1.1 * fewest([r["length"] for r in rows])
    by_row = {r["row"]: r for r in rows}
    found = {}
    ids_of = {r["row"]: bytes(r["ids"]) for r in cut.collect()}
    for s in packing.sequences(packed, cut).collect():
        mine = sorted((r["offset"], k) for k, r in by_row.items() if r["sequence_id"] == s["sequence_id"])
        assert bytes(s["ids"]) == b"".join(ids_of[k] for _, k in mine) and list(s["starts"]) == [o for o, _ in mine]
        found[s["sequence_id"]] = 1
    assert len(found) == n


def test_best_fit_and_cuts():
    assert [s for s, _ in packing.best_fit([(3, [1]), (7, [2]), (5, [3]), (5, [4])], 10)] == [10, 10]
    assert packing.cuts(1, 4) == [0, 1] and packing.cuts(4, 4) == [0, 4] and packing.cuts(9, 4) == [0, 1, 5, 9]
    p = packing.Packing(capacity=10, slack=1, open_bins=2)
    done, left = packing.settled([(10, [1]), (9, [2]), (8, [3]), (7, [4]), (6, [5])], p)
    assert [s for s, _ in left] == [6, 7] and sorted(s for s, _ in done) == [8, 9, 10]
