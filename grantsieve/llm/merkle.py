"""Merkle manifest of a table: a tree of hashes per source, one over the sources, and proofs.

Proofs come from pointer jumping. Every node holds the siblings on its way to an ancestor, at
first its parent; a join of the table with itself appends the ancestor's own way, so the
distance doubles until every node has reached the root. The leaves of a run share the way of
their run, so they take it over in one last join and never take part in the doubling.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import id_crc, salted_join, written

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; those of the sources have numbers from 0.
OVER_SOURCES = -1
#: Rows of one ancestor that a task of a jump may get.
_ROWS_OF_ANCESTOR = 4096


def digest_of(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_input(**replaced: Column) -> Column:
    """The fields of a row, each as byte count, colon and value, or as a dash without one."""
    fields = [replaced.get(f, F.col(f)).cast("string") for f in FIELDS]
    sized = [F.concat(F.octet_length(f).cast("string"), F.lit(":"), f) for f in fields]
    return F.concat(*[F.coalesce(s, F.lit("-")) for s in sized])


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, altered): the leaf of each row, and that of its tampered form,
    where it is tampered with: text in lower case where 5 divides the id's crc32."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        digest_of(leaf_input()).alias("leaf"),
        F.when(id_crc() % 5 == 0, digest_of(leaf_input(text=lowered(F.col("text"))))).alias("altered"),
    )


@dataclass(frozen=True)
class Manifest:
    """runs: (tree, run, n, members, hash), a row per run of leaves of one source; members are
    its leaves in order. links: (t, l, p) of every node above the leaves and its parent
    (at, al, ap), with the siblings before and behind it. n_links, depth: of the links, and of
    the longest way to the root. root: null for an empty table."""

    runs: DataFrame
    links: DataFrame
    n_links: int
    depth: int
    root: str | None


def _in_order(found: DataFrame) -> tuple[DataFrame, int, int]:
    """Leaves with tree, pos and n: the source's rank, their place in it and its size; then the
    largest source's size and the number of sources.

    Places are offsets in ranges of (source, doc_id, leaf) plus what earlier ranges hold, so
    no source is gathered anywhere. One row per range and source is joined back.
    """
    key = ("source", "doc_id", "leaf")
    # hashed first: choosing ranges reads its input twice
    ranged = written(found, "leaves").repartitionByRange(*key).sortWithinPartitions(*key)
    offset = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = written(ranged.select("*", F.spark_partition_id().alias("part"), offset.alias("at")), "ranges")
    of_source, earlier = W.partitionBy("source"), (W.unboundedPreceding, -1)
    parts = ranged.groupBy("part", "source").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    parts = written(
        parts.select(
            "part", "source", "first",
            F.coalesce(F.sum("rows").over(of_source.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("base"),
            F.sum("rows").over(of_source).alias("n"),
        ),
        "parts",
    )
    starts = parts.filter("base = 0")
    # one row per range: how many sources start in earlier ones
    before = starts.groupBy("part").agg(F.count("*").alias("here")).select(
        "part", F.coalesce(F.sum("here").over(W.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before")
    )
    ranked = starts.withColumn("rank", F.row_number().over(W.partitionBy("part").orderBy("first")) - 1).join(before, "part")
    trees = ranked.select(F.col("source").alias("_source"), (F.col("before") + F.col("rank")).alias("tree"))
    facts = parts.join(trees, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("part").alias("_part"), "_source", "tree", "n", (F.col("base") - F.col("first")).alias("shift")
    )
    same = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = ranged.join(facts, same).select(
        "tree", (F.col("at") + F.col("shift")).alias("pos"), "n", "doc_id", "leaf", "altered"
    )
    size = starts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count("*").alias("trees")).first()
    return placed, size["most"], size["trees"]


def _runs(nodes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(tree, n, run, members, hash): every FAN consecutive nodes; a node alone in its tree
    keeps its hash."""
    members = F.sort_array(F.collect_list(F.struct("pos", "hash", *keep)))
    run = nodes.groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("run")).agg(members.alias("members"))
    hashes = F.array_join(F.transform("members", lambda m: m["hash"]), "")
    return run.withColumn("hash", F.when(F.col("n") == 1, hashes).otherwise(digest_of(hashes)))


def _above(runs: DataFrame) -> DataFrame:
    """Runs as the nodes of the level above."""
    return runs.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), "hash")


def _siblings(members: Column, i: Column) -> Column:
    """Hashes before and behind the i-th member."""
    hashes = F.transform(members, lambda m: m["hash"])
    return F.struct(
        F.array_join(F.slice(hashes, F.lit(1), i), "").alias("before"),
        F.array_join(F.slice(hashes, i + 2, F.size(members)), "").alias("behind"),
    )


_WAY = "array<struct<before:string,behind:string>>"


def _climb(nodes: DataFrame, level: int, n: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Builds the levels above nodes whose largest tree has n of them. Returns the links of
    all levels and the topmost nodes (tree, level, hash)."""
    links, tops = [], []
    while True:
        tops.append(nodes.filter("n = 1").select("tree", F.lit(level).alias("level"), "hash"))
        if n <= 1:
            return links, tops
        runs = written(_runs(nodes.filter("n > 1")), "runs")
        child = runs.select("tree", "run", "members", F.posexplode("members").alias("i", "m"))
        links.append(child.select(
            F.col("tree").alias("t"), F.lit(level).alias("l"), F.col("m.pos").alias("p"),
            F.col("tree").alias("at"), F.lit(level + 1).alias("al"), F.col("run").alias("ap"),
            F.array(_siblings(F.col("members"), F.col("i"))).alias("way"), F.lit(None).cast("string").alias("subroot"),
        ))
        nodes, level, n = _above(runs), level + 1, -(-n // FAN)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(found: DataFrame) -> Manifest:
    """The manifest of rows of ``leaves``. Rows of a source stand by doc_id, null first, those
    of one doc_id by their hash; rows without a source have a tree of their own, the first."""
    placed, most, trees = _in_order(found)
    runs = written(_runs(placed.withColumnRenamed("leaf", "hash"), ("doc_id", "altered")), "runs")
    own, tops = _climb(_above(runs), 1, -(-most // FAN))
    subroots = written(_all(tops), "subroots")
    # a subroot is the leaf of the upper tree: a step without siblings
    step = subroots.select(
        F.col("tree").alias("t"), F.col("level").alias("l"), F.lit(0).cast("bigint").alias("p"),
        F.lit(OVER_SOURCES).cast("bigint").alias("at"), F.lit(0).alias("al"), F.col("tree").alias("ap"),
        F.array().cast(_WAY).alias("way"), F.col("hash").alias("subroot"),
    )
    upper = subroots.select(
        F.lit(OVER_SOURCES).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).alias("n"), "hash"
    )
    over, top = _climb(upper, 0, trees)
    links = written(_all([*own, step, *over]), "links")
    root = _all(top).select("hash").first()  # one row, or none
    return Manifest(runs, links, links.count(), len(own) + 1 + len(over), root and root["hash"])


def ways(m: Manifest) -> DataFrame:
    """(t, l, p, way, subroot) of every node above the leaves: all siblings up to the root.

    An ancestor at distance d has FAN**d nodes below it, so its row is repeated by that many
    over the rows that a task may get, and they meet it in as many parts.
    """
    paths, reach = m.links, 1
    while reach < m.depth:
        below = min(FAN**reach, m.n_links)
        far = paths.filter((F.col("l") > reach) | (F.col("t") == OVER_SOURCES)).select(
            F.col("t").alias("at"), F.col("l").alias("al"), F.col("p").alias("ap"),
            *[F.col(c).alias(f"far_{c}") for c in ("at", "al", "ap", "way", "subroot")],
        )
        met = salted_join(paths, far, ["at", "al", "ap"], "t, l, p", str(-(-below // _ROWS_OF_ANCESTOR)), "left")
        paths = written(
            met.select(
                "t", "l", "p", *[F.coalesce(f"far_{c}", c).alias(c) for c in ("at", "al", "ap")],
                F.concat("way", F.coalesce("far_way", F.array().cast(_WAY))).alias("way"),
                F.coalesce("subroot", "far_subroot").alias("subroot"),
            ),
            "ways",
        )
        reach *= 2
    return paths.select("t", "l", "p", "way", "subroot")


def proofs(m: Manifest) -> DataFrame:
    """(doc_id, leaf, altered, subroot, proof) of every leaf; proof lists, from its run up to
    the root, the hashes before and behind the node at hand."""
    path = ways(m).filter((F.col("l") == 1) & (F.col("t") != OVER_SOURCES)).select(
        F.col("t").alias("tree"), F.col("p").alias("run"), "way", "subroot"
    )
    member = m.runs.join(path, ["tree", "run"]).select(
        "n", "members", "way", "subroot", F.posexplode("members").alias("i", "m")
    )
    own = F.when(F.col("n") == 1, F.array().cast(_WAY)).otherwise(F.array(_siblings(F.col("members"), F.col("i"))))
    return member.select("m.doc_id", F.col("m.hash").alias("leaf"), "m.altered", "subroot", F.concat(own, "way").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: digest_of(F.concat(s["before"], h, s["behind"])))


def digest(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Null fields are dashes in the leaf, unlike empty ones; a row without a doc_id is never
    tampered with. Repeated rows have equal leaves at different places, each with its proof.
    An empty table gives no row. Other columns of docs, of whatever name, are ignored.
    """
    m = build(leaves(docs))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["behind"])), "")
    out = proofs(m).select(
        "doc_id", "leaf", "subroot", F.lit(m.root).cast("string").alias("root"),
        digest_of(siblings).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
