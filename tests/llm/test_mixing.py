"""The mixing query, whole rows, against a plain raking over dictionaries."""

import re
import struct
from collections import defaultdict

import pytest
import xxhash

from grantsieve.llm import mixing
from grantsieve.llm.queries import QUERIES


def plain_topic(text):
    if text is None:
        return "other"
    if " | " in text:
        return "table"
    if re.search("licen[cs]e|copyright|all rights reserved", text.lower()):
        return "notice"
    return "numeric" if re.search("[0-9]{3}", text) else "other"


def plain_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_margin(tokens, listed, tempering):
    """Share of each value: its target, or its part of the share of `other`."""
    rest = {v: n**tempering for v, n in tokens.items() if v not in listed or v == "other"}
    share = {v: listed[v] if v not in rest else 0.0 for v in tokens}
    for v, n in rest.items():
        share[v] += listed.get("other", 0.0) * n / sum(rest.values())
    return {v: s / sum(share.values()) for v, s in share.items()}


def plain_draws(rows, targets=mixing.Targets()):
    """(cell, tokens, p, draw) by doc_id of rows (doc_id, text, source, lang), ids not null and unique."""
    cell = {d: (s or "other", x or "other", plain_topic(t)) for d, t, s, x in rows}
    words = {d: plain_words(t) for d, t, *_ in rows}
    tokens = defaultdict(float)
    for d, c in cell.items():
        tokens[c] += words[d]
    tokens = {c: n for c, n in tokens.items() if n}
    margins = []
    for i, listed in enumerate(targets.shares.values()):
        sums = defaultdict(float)
        for c, n in tokens.items():
            sums[c[i]] += n
        margins.append(plain_margin(sums, listed, targets.tempering))
    total, held, draw = sum(tokens.values()), set(), {c: n * targets.budget for c, n in tokens.items()}
    while True:
        for _ in range(targets.rounds):
            worst = 0.0
            for i, margin in enumerate(margins):
                want, have = {v: s * targets.budget * total for v, s in margin.items()}, defaultdict(float)
                for c, n in draw.items():
                    if c in held:
                        want[c[i]] -= n
                    else:
                        have[c[i]] += n
                factor = {v: max(want[v], 0.0) / h if h > 0 else 1.0 for v, h in have.items()}
                worst = max([worst, *[abs(h * factor[v] - h) / (total * targets.budget) for v, h in have.items()]])
                draw = {c: n if c in held else n * factor[c[i]] for c, n in draw.items()}
            if worst < targets.tolerance:
                break
        over = {c for c, n in draw.items() if c not in held and n > tokens[c] * (1 + 1e-9)}
        if not over:
            break
        held |= over
        draw.update({c: tokens[c] for c in over})
    seed = xxhash.xxh64_intdigest(struct.pack("<i", targets.seed), 42)
    out = {}
    for d, c in cell.items():
        p = min(draw[c], tokens[c]) / tokens[c] if c in tokens else targets.budget
        out[d] = (c, words[d], p, xxhash.xxh64_intdigest(str(d), seed) % 2**52 / 2**52)
    return out


def test_op2_equals_plain_raking(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    plain = plain_draws([tuple(r) for r in docs])
    assert all(abs(p - drawn) > 1e-6 for _, _, p, drawn in plain.values())  # none is on the edge
    got = {r["doc_id"]: r for r in QUERIES["op2_mixing"](spark, small).collect()}
    assert got.keys() == {d for d, (_, _, p, drawn) in plain.items() if drawn < p}
    assert 0 < len(got) < len(docs)
    sources = {r["doc_id"]: (r["source"], r["lang"]) for r in docs}
    for d, r in got.items():
        (_, _, topic), words, p, _ = plain[d]
        assert (r["source"], r["lang"], r["topic"], r["n_tokens"]) == (*sources[d], topic, words)
        assert r["p"] == pytest.approx(p, abs=1e-7)
