"""Learned operators against plain versions that fit and score in a few lines of their own."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_mixing import plain_draws
from tokenizers import Tokenizer

import corpus_pipeline
from grantsieve.llm import decontaminate, quality, token_files
from grantsieve.llm.queries import QUERIES


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def docs(spark, small):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def plain_quality(spark, small, docs):
    """Posterior of label 1 by doc_id, from class means and shrunk covariances."""
    x = {i: np.array(quality.statistics((r["text"] or "").encode())) for i, r in docs.items()}
    rows = [r for r in spark.read.parquet(f"{small}/labels.parquet").collect() if remainder(r["doc_id"], 5) and r["doc_id"] in x]
    classes = [np.array([x[r["doc_id"]] for r in rows if r["quality"] == y]) for y in (0, 1)]
    shares = [len(c) / len(rows) for c in classes]
    covs = [np.cov(c.T, bias=True) for c in classes]
    pooled = sum(p * c for p, c in zip(shares, covs))
    s, shrunk = quality.Shrinkage(), []
    for c in covs:
        c = (1 - s.pooled) * c + s.pooled * pooled
        shrunk.append((1 - s.diagonal) * c + s.diagonal * np.diag(np.diag(c)) + s.ridge * np.eye(len(c)))

    def log_density(v, mean, cov):
        d = v - mean
        return -(d @ np.linalg.solve(cov, d) + np.linalg.slogdet(cov)[1]) / 2

    def posterior(v):
        a, b = (log_density(v, c.mean(axis=0), cov) for c, cov in zip(classes, shrunk))
        return 1 / (1 + math.exp(-np.clip(s.temper * (b - a) + math.log(shares[1] / shares[0]), -500, 500)))

    return {i: posterior(v) for i, v in x.items()}


def test_op6_equals_a_plain_fit(spark, small, plain_quality):
    got = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, small).collect()}
    assert got.keys() == plain_quality.keys()
    for i, want in plain_quality.items():
        assert got[i]["score"] == pytest.approx(want, abs=1e-6)
        assert got[i]["held_out"] == (remainder(i, 5) == 0)
        if abs(want - 0.3) > 1e-6:
            assert got[i]["predicted"] == (want >= 0.3)


def test_statistics_of_a_text():
    found = dict(zip(quality.STATISTICS, quality.statistics("A b# c|d !\nA b# c|d !\n\nzoë 12".encode())))
    assert found["words"] == pytest.approx(math.log1p(10))
    assert found["symbols"] == pytest.approx(math.log(4 / 10 + 0.02))
    assert found["exclaims"] == pytest.approx(math.log(2 / 10 + 0.02))
    assert found["lines"] == pytest.approx(math.log(3 / 10 + 0.02))
    assert found["repeated_lines"] == pytest.approx(math.log(1 / 3 + 0.02))


def test_quality_stage_keeps_what_the_plain_fit_accepts(spark, small, docs, plain_quality):
    given = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, given, small).collect()
    assert {r["doc_id"] for r in kept} == {i for i, p in plain_quality.items() if p >= 0.3}
    assert all(tuple(r) == tuple(docs[r["doc_id"]]) for r in kept)


def smallest_of_groups(texts, percent=80):
    """The smallest id of each group linked by shared shingles, all pairs compared; texts by id."""
    def shingles(text):
        w = [x for x in "".join(" " if c in " \t\n\v\f\r" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, group = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) > 0:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i for i in ids if root(i) == i}


def test_near_duplicate_stage_equals_all_pairs(spark, small, docs):
    given = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, given, small).collect()
    assert {r["doc_id"] for r in kept} == smallest_of_groups({i: r["text"] for i, r in docs.items()})
    assert all(tuple(r) == tuple(docs[r["doc_id"]]) for r in kept)


def holders_of_items(texts, items, budget=decontaminate.Budget()):
    """Ids of the texts within an item's edit budget, every item aligned with every text in full.

    Texts are laid end to end with more signs between them than any budget could bridge.
    """
    gap = np.zeros(max(budget.edits(len(i)) for i in items) + 1, np.int32)
    parts = [np.concatenate([gap, decontaminate.codes(decontaminate.plain(t or "")).astype(np.int32)]) for t in texts.values()]
    signs, first = np.concatenate(parts), np.cumsum([0] + [len(x) for x in parts[:-1]])
    steps, found = np.arange(len(signs) + 1, dtype=np.int32), np.zeros(len(parts), bool)
    for item in items:
        row = np.zeros(len(signs) + 1, np.int32)
        for c in decontaminate.codes(item):
            new = row + 1
            np.minimum(new[1:], row[:-1] + (signs != c), out=new[1:])
            row = np.minimum.accumulate(new - steps) + steps  # signs of the text left out
        found |= np.minimum.reduceat(row[1:], first) <= budget.edits(len(item))
    return {i for i, f in zip(texts, found) if f}


def test_run_equals_the_plain_stages(spark, small, docs, plain_quality):
    """Whole rows of the pipeline against plain versions of all five stages, one after the other."""
    items = [decontaminate.plain(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert min(map(len, items)) >= 24  # items that are aligned
    left = {i: r["text"] for i, r in docs.items() if plain_quality[i] >= 0.3}
    stages = [len(docs), len(left)]
    left = {i: left[i] for i in smallest_of_groups(left)}
    stages.append(len(left))
    for i in holders_of_items(left, items):
        del left[i]
    stages.append(len(left))
    draws = plain_draws([(i, t, docs[i]["source"], docs[i]["lang"]) for i, t in left.items()])
    left = {i: t for i, t in left.items() if draws[i][3] < draws[i][2]}
    stages.append(len(left))
    assert all(a > b for a, b in zip(stages, stages[1:])) and left  # each stage decides something

    tokenizer, at, want = Tokenizer.from_file(token_files.vocabulary()), 0, []
    for i in sorted(left):
        ids = tokenizer.encode(left[i] or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = corpus_pipeline.run(spark, small)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == want


def test_op3_equals_plain_backoff(spark, small, docs):
    def words(text):
        return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()

    def grams(word, n):
        return [f"<{word}>"[i : i + n] for i in range(len(word) + 3 - n)]

    counts = [defaultdict(Counter) for _ in range(6)]
    for i, r in docs.items():
        if remainder(i, 3) != 1 and r["lang"] is not None:
            for w in words(r["text"]):
                counts[0][w][r["lang"]] += 1
                for n in range(1, 6):
                    for g in grams(w, n):
                        counts[n][g][r["lang"]] += 1
    langs = sorted({x for c in counts[0].values() for x in c})
    sums = [{x: sum(c[x] + 0.5 for c in t.values()) for x in langs} for t in counts]

    def logs(n, unit):
        return np.array([math.log((counts[n][unit][x] + 0.5) / sums[n][x]) for x in langs])

    def word_score(w):
        if w in counts[0]:
            return logs(0, w)
        for n in range(5, 0, -1):
            if known := [g for g in grams(w, n) if g in counts[n]]:
                return np.mean([logs(n, g) for g in known], axis=0)
        return np.zeros(len(langs))

    got = {r["doc_id"]: r for r in QUERIES["op3_langid"](spark, small).collect()}
    assert got.keys() == docs.keys()
    for i, r in docs.items():
        assert got[i]["held_out"] == (remainder(i, 3) == 1)
        found = words(r["text"])
        if not found:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        total = sum(c * word_score(w) for w, c in Counter(found).items())
        best = int(np.argmax(total))
        assert got[i]["lang_pred"] == langs[best]
        assert got[i]["score"] == pytest.approx(1 / np.exp(total - total[best]).sum(), abs=1e-6)
