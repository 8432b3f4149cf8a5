"""Reading tables, writing intermediate ones, and texts inside tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space of every word and line contract: space, tab, \n, \v, \f, \r.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here and survives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_join(
    rows: DataFrame, facts: DataFrame, keys: list[str], by: str, parts: str = "8", how: str = "inner"
) -> DataFrame:
    """rows joined with facts, which has one narrow row per key; the rows of a key go to `parts`
    tasks by hash of the column `by`. parts: SQL, of the keys alone, as both sides compute it."""
    spread = rows.withColumn("_salt", F.expr(f"cast(pmod(xxhash64({by}), {parts}) as int)"))
    repeated = facts.withColumn("_salt", F.expr(f"explode(sequence(0, {parts} - 1))"))
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text; null without an id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def utf8(texts: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty. Bytes split at exactly the white space above."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
