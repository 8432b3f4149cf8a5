"""The pipeline's stages against plain versions of what they decide."""

import random
import zlib

import numpy as np

import corpus_pipeline
from grantsieve.llm import token_files


def test_stages_keep_columns_and_take_effect(spark, small):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small).cache()
        assert out.columns == columns, name
        assert out.join(docs, "doc_id", "left_anti").isEmpty()
        counts.append(out.count())
        docs = out
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    left = docs.orderBy("doc_id").collect()
    assert not any(i.lower() in r["text"].lower() for r in left for i in items)
    t, at = Tokenizer.from_file(token_files.vocabulary()), 0
    got = corpus_pipeline.STAGES[-1][1](spark, docs, small).orderBy("doc_id").collect()
    for r, g in zip(left, got, strict=True):
        ids = t.encode(r["text"], add_special_tokens=False).ids + [2]
        assert tuple(g) == (r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_stages_on_empty_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_near_duplicates_stage_links_from_80_percent(spark, small):
    """Pairs of 180 shingles with 4 words replaced (160 of 200 in common: 0.80), of 200 with 4
    (180 of 220: 0.82), and of 170 with 4 (150 of 190: 0.79, not linked)."""
    rng = random.Random(5)
    rows, gone = [], set()
    for shingles in (180, 200, 170):
        for _ in range(12):
            words = [f"w{rng.randrange(10**9)}" for _ in range(shingles + 4)]
            copy = [f"v{rng.randrange(10**9)}" if i in (20, 60, 100, 140) else w for i, w in enumerate(words)]
            first = len(rows)
            rows += [(first, " ".join(words)), (first + 1, " ".join(copy))]
            if shingles != 170:
                gone.add(first + 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "'en' as lang", "'a' as source", "length(text) as n_chars"
    )
    left = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, small).select("doc_id").collect()
    assert {r["doc_id"] for r in left} == {i for i, _ in rows} - gone
