"""Rules as a table: equal to the rules as literals, whatever their number."""

import random
import re

import pytest

from grantsieve import Profile
from grantsieve.operators import rule_table
from grantsieve.operators.records import with_topic_tags
from grantsieve.operators.rule_table import labels_by_category, phrase_index, rule_hits, rule_index
from grantsieve.functions.tagging import literal_start

TEXTS = [
    (1, "Machine learning, and cyber-infrastructure for climate change."), (2, None), (3, ""),
    (4, "nanotech NANOTECHNOLOGY \x01 quantum computing quantum computing"), (5, "x" * 100_000 + " education research"),
    (6, "Übermachine learning is no word start; machine\nlearning neither"), (4, "a second row of one key: robotics"),
]


def tagged(index, df, salts=8):
    hits = rule_hits(df, index, ("id",), "t", salts)
    return {(r["id"], r["category"]): r["labels"] for r in labels_by_category(hits, ("id",)).collect()}


@pytest.mark.parametrize("bound", [rule_table.BROADCAST_SIGNS, -1])
def test_equal_to_the_literal_form(spark, small, monkeypatch, bound):
    monkeypatch.setattr(rule_table, "BROADCAST_SIGNS", bound)
    rules = {
        c: {x: [p for p in ps if literal_start(p)] for x, ps in labels.items() if any(map(literal_start, ps))}
        for c, labels in Profile().rules.items()
    }
    rules["own"] = {"Learning": [r"\bmachine learning\b"], "Quantum": [r"\bquantum\b", r"\bqu"], "X": [r"\bx"]}
    rows = [(i, t) for i, t in TEXTS if i != 4] + [(4, TEXTS[3][1])]
    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("cast(doc_id + 100 as int) as id", "text as t")
    df = spark.createDataFrame(rows, "id int, t string").unionByName(docs)
    want = {}
    for r in with_topic_tags(df.selectExpr("id", "t"), "t", rules).collect():
        for c in rules:
            if r["tags"][c]:
                want[r["id"], c] = r["tags"][c]
    got = tagged(rule_index(spark, rules), df)
    assert got == want and (4, "own") in got and (6, "own") not in got


def test_rows_of_one_key_empty_tables_and_other_columns(spark):
    index = rule_index(spark, {"c": {"B": [r"\brobotics\b"], "A": [r"\bquantum\b"]}})
    df = spark.createDataFrame(TEXTS, "id int, t string").selectExpr("*", "'k' as category", "1 as place", "2 as head")
    assert tagged(index, df) == {(4, "c"): ["B", "A"]}
    assert tagged(index, df.limit(0)) == {}
    none = spark.createDataFrame([], "category string, label string, place int, phrase string")
    assert tagged(phrase_index(none), df) == {}


def test_thousands_of_rules(spark, small):
    docs = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()]
    words = sorted({w for t in docs for w in re.findall(r"(?<![^\W_])[a-z0-9]+(?![^\W_])", t)})
    rng, rules = random.Random(3), {}
    while len(rules) < 5000:
        n = rng.choice((1, 1, 2))
        p = " ".join(rng.choices(words, k=n))
        rules[p if rng.random() < 0.7 else p[: rng.randint(1, len(p))].rstrip()] = None
    rows = [(f"c{i % 3}", p, i, p) for i, p in enumerate(rules)]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    index = phrase_index(spark.createDataFrame(rows, "category string, label string, place int, phrase string"))
    hits = rule_hits(df, index, ("id",), "t")
    found = {}
    for i, t in enumerate(docs):
        low = t.lower()
        for c, p, _, _ in rows:
            if p in low and re.search(rf"(?<![^\W_]){re.escape(p)}(?![^\W_])", low):
                found.setdefault((i, c), []).append(p)
    assert {(r["id"], r["category"]): r["labels"] for r in labels_by_category(hits, ("id",)).collect()} == found
    few = rule_hits(df, phrase_index(spark.createDataFrame(rows[:3], "category string, label string, place int, phrase string")), ("id",), "t")
    size = [len(h._jdf.queryExecution().optimizedPlan().toString()) for h in (hits, few)]
    assert abs(size[0] - size[1]) < 100


def test_phrases_are_texts_not_patterns(spark):
    rows = [("c", "Dots", 0, "a.b (c)*"), ("c", "Quote", 1, r"x\Ey"), ("c", "No start", 2, "(c)"), ("c", "C++", 3, "C++")]
    index = phrase_index(spark.createDataFrame(rows, "category string, label string, place int, phrase string"))
    df = spark.createDataFrame([(1, "A.B (C)* and x\\eY"), (2, "axb (c) c+"), (3, "in c++, too"), (4, None)], "id int, t string")
    assert tagged(index, df) == {(1, "c"): ["Dots", "Quote"], (3, "c"): ["C++"]}


def test_rules_without_a_literal_start_are_refused(spark):
    with pytest.raises(ValueError, match="no literal start"):
        rule_index(spark, {"c": {"x": [r"\w+ing\b"]}})
