"""Lines that many documents share: native, by ranges of line hashes, as per-document bitmaps."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import SPACE, written


@dataclass(frozen=True)
class Rule:
    """Keys of at least min_chars code points in at least min_docs documents lose all lines
    but those in one document. salts: parts that the occurrences of one key are split into."""

    min_chars: int = 40
    min_docs: int = 5
    salts: int = 32


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased (all else as it is)."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is much faster than translate() and does the same where all is ASCII
    plain = F.length(bare) == F.octet_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def occurrences(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Long lines as (h1, h2, salt, doc_id, tag, n_lines, pos), range-partitioned by hash and
    salt, then sorted by document (largest first) and position.

    tag tells rows of one doc_id with different texts apart. The 128-bit hash stands for the key.
    """
    text = F.col("text")
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64(text).alias("tag"), lines_of(text).alias("lines")
    ).select("doc_id", "tag", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= rule.min_chars)
    hashed = keyed.select(
        F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(rule.salts)).cast("int").alias("salt"),
        "doc_id", "tag", "n_lines", "pos",
    )
    return hashed.repartitionByRange("h1", "h2", "salt").sortWithinPartitions(
        "h1", "h2", "salt", F.desc("doc_id"), "pos"
    )


def shared_keys(found: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(h1, h2, keeper) of keys in enough documents; keeper is the largest doc_id.

    Streams each range in its order: a row that starts another document counts one, and the
    first one is the part's largest. Parts of a key then meet as one row per part.
    """
    in_order = W.partitionBy("h1", "h2", "salt").orderBy(F.desc("doc_id"), "pos")
    before = F.lag("doc_id").over(in_order)
    firsts = found.withColumn("before", before).filter(
        F.col("before").isNull() | (F.col("before") != F.col("doc_id"))
    )
    parts = firsts.groupBy("h1", "h2", "salt").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
    return parts.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("keeper")).filter(
        F.col("n") >= rule.min_docs
    ).select("h1", "h2", "keeper")


def keep_bitmaps(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, tag, n_dropped, keep) of documents that lose lines.

    keep is the run-length-compressed bitmap of kept lines: array<struct<start, length>>.
    Documents that are not listed keep every line. No text is returned.
    """
    found = written(occurrences(docs, rule), "occurrences")
    keys = shared_keys(
        found.repartitionByRange("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", F.desc("doc_id"), "pos"), rule
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(rule.salts - 1))))
    dropped = found.join(keys, ["h1", "h2", "salt"]).filter(F.col("doc_id") != F.col("keeper"))
    row = ("doc_id", "tag", "n_lines")
    island = F.col("pos") - F.dense_rank().over(W.partitionBy(*row).orderBy("pos"))
    runs = dropped.select(*row, "pos", island.alias("island")).groupBy(*row, "island").agg(
        F.min("pos").alias("start"), F.max("pos").alias("last")
    )
    per_doc = runs.groupBy(*row).agg(
        F.sort_array(F.collect_list(F.struct("start", "last"))).alias("d"),
        F.sum(F.col("last") - F.col("start") + 1).alias("n_dropped"),
    )
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("d", i)["last"] + 1)
    until = lambda i: F.coalesce(F.get("d", i)["start"], F.col("n_lines"))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("d")),
        lambda i: F.struct(begin(i).alias("start"), (until(i) - begin(i)).alias("length")),
    )
    return per_doc.select("doc_id", "tag", "n_dropped", F.filter(gaps, lambda g: g["length"] > 0).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The kept lines of a text, joined by \\n; all of it where keep is null."""
    lines = lines_of(text)
    kept = F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row: doc_id, n_lines before dropping, n_dropped, text of the lines that stay.

    A null or empty text is one empty line. Rows without a doc_id are in no document: their
    lines neither count nor go. Rows of one doc_id are one document: a line that all of them
    hold counts once, and repeated rows lose the same lines. Other columns of docs, of
    whatever name, are ignored.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    joined = rows.join(keep_bitmaps(docs, rule), ["doc_id", "tag"], "left")
    return joined.select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        kept_text(F.col("text"), F.col("keep")).alias("text"),
    )


def digest(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    return dedup_lines(docs, rule).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )
