"""A corpus from documents to token files, one operator of grantsieve.llm per stage.

Each stage is written as Parquet and read again as the next one's docs. The first four return
rows of documents unchanged: what a stage rejects is gone for the stages after it.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from grantsieve.llm import decontaminate, mixing, near_dup, quality  # noqa: E402
from grantsieve.llm.queries import quality_model, token_table  # noqa: E402
from grantsieve.llm.shipping import ship_package  # noqa: E402
from grantsieve.llm.tables import table, written  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Stages on word shingles link at 0.8. 200 values in 40 bands of 5: a pair at 0.8 shares no
#: band with a probability of 1.3e-7.
LINKING = near_dup.Linking(percent=80, functions=100)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; fitted as in op6."""
    ship_package(spark)
    _, model = quality_model(docs, table(spark, sf_dir, "labels"))
    score = quality.score(quality.text_statistics(F.col("text")), model)
    return docs.select(*COLUMNS).filter(score >= 0.3)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked at 0.8 or more; rows without a doc_id stay."""
    ship_package(spark)
    found = near_dup.near_duplicates(docs.select("doc_id", "text"), LINKING)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return decontaminate.without_passages(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of tokens."""
    ship_package(spark)
    return mixing.mix(docs.select(*COLUMNS))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back: doc_id, start, n_tokens, ids_crc32."""
    ship_package(spark)
    return token_table(spark, docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: SQL cannot express the classifier, the raking nor the tokenizer; tests/llm holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
