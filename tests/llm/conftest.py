import pytest

from grantsieve.llm.shipping import ship_package

LONG = "word%d stays here and there with other words of some length that make a line long enough"
SHARED = "  This very line is Shared by many documents and is over forty signs long\t"


@pytest.fixture(scope="session")
def spark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, odd signs."""
    rows = [(i, f"{LONG % i}\n{SHARED}\nend of {i}", "en", "a", 1) for i in range(10, 17)]
    rows += [rows[0], rows[1], (10, "another text of a known id\n" + SHARED, "en", "a", 2)]
    rows += [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t\n ", "fr", "b", 3),
        (None, "no id " * 9 + "\n" + SHARED, "en", "b", 4), (None, None, None, None, None),
        (4, "x" * 200_000, "de", "b", 5), (5, "!!?? 12 ³ ½ ²", "de", "b", 6),
        (6, "\n".join(f"Ärger {i} über Öl" for i in range(5000)), "de", "c", 7),
        (7, "one two three", "en", "c", 8), (8, "ONE two three", "en", "c", 9), (9, "One TWO  three", "en", "c", 10),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows with further columns whose names operators use."""
    df = spark.createDataFrame(edge_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr(
        "*", "1 as kept", "'k' as key", "2 as h1", "3 as tag", "4 as score", "5 as n_words", "6 as host",
        "7 as salt", "8 as id", "9 as label", "'s' as s", "0 as _p", "1 as _u", "1 as n", "1 as m",
    ).repartition(3)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
