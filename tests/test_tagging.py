import random
import re

from pyspark.sql import functions as F

from grantsieve.contract.rules import WORD_RULES
from grantsieve.functions.fixed_values import TOPIC_RULES
from grantsieve.functions.tagging import joined_tags
from grantsieve.operators.records import with_topic_tags


def tag(spark, texts, rules):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = with_topic_tags(df, "t", rules).orderBy("i").collect()
    return [{c: list(r.tags[c]) for c in rules} for r in rows]


def model(text, rules):
    return {
        c: [label for label, ps in labels.items() if any(re.search(p, text or "", re.I) for p in ps)]
        for c, labels in rules.items()
    }


def test_declared_order_and_repeated_labels(spark):
    got = tag(spark, ["Deep learning in QUANTUM cells", "", None], TOPIC_RULES)
    assert got[0]["research_domains"] == ["Cellular Biology", "Quantum", "Machine Learning"]
    assert got[0]["methods_approaches"] == ["Machine Learning"]
    assert got[1] == got[2] == {c: [] for c in TOPIC_RULES}


def test_word_boundaries(spark):
    texts = ["ai", "\u00e9ai", "e\u0301ai", "ai_", "(AI)", "a\u0131", "a\u0130.", "ai\u00b2", "\x01ai", "ai\x01s", "\U0001d4d0ai", "\U0001f600ai\U0001f600"]
    assert [t["research_domains"] for t in tag(spark, texts, TOPIC_RULES)] == [
        model(t, TOPIC_RULES)["research_domains"] for t in texts
    ]


def test_rules_against_caseless_search(spark):
    rng = random.Random(3)
    words = sorted({
        re.sub(r"\\b|[?()\[\]]", "", p).replace("- ", "-")
        for labels in TOPIC_RULES.values() for ps in labels.values() for p in ps
    })
    noise = ["the", "cellophane", "\u017fecurity", "\u212a12", "K 12", "broaden participation", "nano\u0301", "open source", "early career"]
    glue = [" ", " ", "-", "_", "\u00e9", "\u0301", ".", "\n", "\x01", ""]
    texts = []
    for _ in range(400):
        picks = [rng.choice(words + noise) for _ in range(rng.randint(0, 8))]
        text = "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice(glue) for w in picks)
        texts.append(text)
    assert tag(spark, texts, TOPIC_RULES) == [model(t, TOPIC_RULES) for t in texts]


def test_own_rules_with_any_form_of_pattern(spark, small):
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    assert tag(spark, docs, WORD_RULES) == [model(t, WORD_RULES) for t in docs]


def test_joined_tags(spark):
    df = spark.createDataFrame([("ai quantum",)], "t string")
    row = with_topic_tags(df, "t", TOPIC_RULES).select(*joined_tags(F.col("tags"), TOPIC_RULES)).first()
    assert row.tags_research_domains == "Quantum; AI" and row.tags_populations == ""


def test_patterns_keep_their_meaning(spark):
    import re

    from pyspark.sql import functions as F

    from grantsieve.functions.patterns import ANY_CASE, portable, required_literal

    text = "big biology takes 20 years; color of cafes, foo large na\xefve bar_x a-b"
    patterns = [
        r"\b\d+ years\b", r"\b[a-z]+ology\b", r"\bfoo\b(?!bar)", r"\bcolou{0,1}r\b", r"\bna\wve\b", r"\x62ig", r"\Bology\b",
        r"\w\W\w", r"[\w-]+\b", r"\bx?big\b", r"o\b", r"\S\s\S", r"\Big\b", r"\b(?:foo|baz)\b", r"\bye\b", r"\bo\w*x\b",
    ]
    for p in patterns:
        got = spark.createDataFrame([(text,)], "t string").select(F.col("t").rlike(ANY_CASE + portable(p))).first()[0]
        assert got == bool(re.search(p, text, re.I)), p
        if re.search(p, text, re.I):
            assert required_literal(p) in text, p


def test_escaped_backslashes_and_named_groups(apply):
    from grantsieve.functions.patterns import ANY_CASE, portable

    cases = {r"a\\bc": r"a\bc", r"\bx\\b": "x\\b", r"(?P<part_1>ab)+c": "ababc", r"\\\bend": r"\end", r"\(?P<x>": "(P<x>"}
    for pattern, text in cases.items():
        got = apply([text, "none of it"], lambda c, p=pattern: c.rlike(ANY_CASE + portable(p)))
        assert got == [True, False], pattern
