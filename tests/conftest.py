import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from grantsieve.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate one column expression over a list of strings, in order."""
    from pyspark.sql import functions as F

    def run(values, expression):
        df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
        rows = df.select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in rows]

    return run
