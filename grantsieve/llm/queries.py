"""Registered queries, one per operator, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, host_rules, langid, line_dedup, merkle, mixing, near_dup, packing, pii, quality,
    token_alignment, token_files,
)
from ..session import shared_folder
from .shipping import ship_package
from .tables import id_crc, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_pii(spark, sf_dir):
    return pii.pii_digest(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark, sf_dir):
    """Drawn documents with their probability and tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    text = F.col("text")
    docs = written(
        docs.select(
            "doc_id", "source", "lang", mixing.topic_of(text).alias("topic"), mixing.n_words(text).alias("n_tokens"),
            F.coalesce(F.col("doc_id").cast("string"), text).alias("key"),
        ),
        "weights",
    )
    columns = {d: F.col(d) for d in ("source", "lang", "topic")}
    found = mixing.calibrated(docs, mixing.Targets(), columns, F.col("n_tokens"), F.col("key"))
    return found.filter("drawn < p").select(
        *[f"doc.{c}" for c in ("doc_id", "source", "lang", "topic", "n_tokens")], "p"
    )


@query
def op3_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_crc() % 3 == 1, F.lit(False))
    model = langid.fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


@query
def op4_host_rules(spark, sf_dir):
    return host_rules.apply_host_rules(table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def quality_model(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, quality.Discriminant]:
    """Statistics of all docs (doc_id, x), and the model of the labelled ones not held out."""
    stats = written(docs.select("doc_id", quality.text_statistics(F.col("text")).alias("x")), "statistics")
    learned = labels.select("doc_id", F.col("quality").alias("y")).filter(id_crc() % 5 != 0)
    return stats, quality.fit(stats.join(learned, "doc_id"))


@query
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats, model = quality_model(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_crc() % 5 == 0, F.lit(False))
    scored = stats.select("doc_id", held_out.alias("held_out"), quality.score(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op7_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat.digest(chat.format_turns(given.unionByName(planted)))


@query
def op8_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark, sf_dir):
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_token_files(spark, sf_dir):
    return token_table(spark, table(spark, sf_dir, "documents"))


@query
def op11_merkle(spark, sf_dir):
    return merkle.digest(table(spark, sf_dir, "documents"))


@query
def op12_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), token_files.vocabulary("byte_bpe_50k.json"))


@query
def op13_token_alignment(spark, sf_dir):
    a, b = (token_files.vocabulary(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), a, b)


def token_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    files = token_files.write_tokens(docs, folder, token_files.vocabulary())
    return token_files.read_documents(spark, files)
