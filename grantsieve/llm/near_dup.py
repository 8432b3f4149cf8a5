"""Near-duplicate documents: min-max signatures propose, full shingle sets confirm."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import connected_components
from .shingles import MinMax, jaccard_counts, lowered_words, sequence_hash, shingle_set
from .tables import salted_join, utf8, written


@dataclass(frozen=True)
class Linking:
    """Link at 100 * intersection >= percent * union. 63 hash functions give 126 values, in 25
    bands of 5: a pair at 0.85 shares no band with a probability of 4e-7. pairs_in_part: pairs
    of one text that are confirmed together."""

    percent: int = 85
    functions: int = 63
    rows: int = 5
    pairs_in_part: int = 256


#: Tasks that a bucket of known size is spread over.
_BUCKET_PARTS = "cast(size div 256 + 1 as int)"


def sketches(text: Column, linking: Linking = Linking()) -> Column:
    """Struct of n_shingles, h1 and h2 (hash of the word sequence), bands (null without words)."""

    @F.arrow_udf("struct<n_shingles:bigint,h1:bigint,h2:bigint,bands:array<bigint>>")
    def sketch(texts: pa.Array) -> pa.Array:
        minmax = MinMax(linking.functions, linking.rows)
        rows = []
        for t in utf8(texts):
            words = lowered_words(t)
            s = shingle_set(words)
            rows.append((len(s), *sequence_hash(words), minmax.band_keys(s) if len(s) else None))
        c = list(zip(*rows)) or [()] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
             pa.array(c[3], pa.list_(pa.int64()))],
            ["n_shingles", "h1", "h2", "bands"],
        )

    return sketch(text)


def confirmed_counts(text_a: Column, text_b: Column) -> Column:
    """Struct (both, either): sizes of intersection and union of two texts' full sets."""

    @F.arrow_udf("struct<both:bigint,either:bigint>")
    def counts(a: pa.Array, b: pa.Array) -> pa.Array:
        rows, last, last_set = [], None, np.empty(0, np.uint64)
        for x, y in zip(utf8(a), utf8(b)):
            if x != last:
                last, last_set = x, shingle_set(lowered_words(x))
            rows.append(jaccard_counts(last_set, shingle_set(lowered_words(y))))
        c = list(zip(*rows)) or [(), ()]
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in c], ["both", "either"])

    return counts(text_a, text_b)


def _text_pairs(pairs: DataFrame, texts: DataFrame, linking: Linking) -> DataFrame:
    """pairs (a, b, ..) with text_a and text_b; texts is (id, text), ids unique.

    The pairs of one a go to a task for each pairs_in_part of them, each with the text of a:
    texts are repeated by the number of pairs, so a hub of a third of all rows is no hot key.
    """
    parts = pairs.groupBy("a").agg((F.count("*") / linking.pairs_in_part + 1).cast("int").alias("parts"))
    parts = written(parts, "parts")
    spread = salted_join(pairs, parts.filter("parts > 1"), ["a"], "b", how="left").withColumn(
        "part", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")
    )
    left = texts.join(parts, F.col("id") == F.col("a")).select(
        "a", F.col("text").alias("text_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    right = spread.drop("parts").join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return right.join(left, ["a", "part"]).drop("part")


def _confirm(pairs: DataFrame, texts: DataFrame, linking: Linking) -> DataFrame:
    """Pairs (a, b) with the sizes of intersection and union; texts is (id, text), ids unique."""
    full = _text_pairs(pairs, texts, linking)
    return full.select("a", "b", confirmed_counts(F.col("text_a"), F.col("text_b")).alias("c")).select("a", "b", "c.*")


def foreign_shingles(text_hub: Column, text: Column) -> Column:
    """array<bigint> of the shingles of text that the hub's text does not hold."""

    @F.arrow_udf("array<bigint>")
    def extras(hubs: pa.Array, texts: pa.Array) -> pa.Array:
        rows, last, last_set = [], None, np.empty(0, np.uint64)
        for x, y in zip(utf8(hubs), utf8(texts)):
            if x != last:
                last, last_set = x, shingle_set(lowered_words(x))
            rows.append(np.setdiff1d(shingle_set(lowered_words(y)), last_set, assume_unique=True).view(np.int64))
        return pa.array(rows, pa.list_(pa.int64()))

    return extras(text_hub, text)


def _open_pairs(
    seated: DataFrame, measured: DataFrame, labels: DataFrame, texts: DataFrame, linking: Linking
) -> DataFrame:
    """Pairs (a, b) of one bucket and different components that may link: all that can, without
    listing all pairs of a bucket.

    Let H be any set that stands for a hub's group: here the hub's shingles and those that over
    a quarter of the group holds. Let k_x = |x & H| and e_x = x - H. Then |x & y| is at most
    min(k_x, k_y) + |e_x & e_y|, and a link needs |x & y| >= p(|x| + |y|) / (100 + p). So x
    needs `need` shingles in e_x & e_y, y being taken at its least possible size:
    * need > 0: in any one order, the first |e_x| - need + 1 of e_x hold a shingle that y's
      hold too. The order is rarest first; pairs meet by join on the shingle, which a quarter
      of the group holds at most.
    * else the pair may do without; such pairs meet by their hub, where k_x and k_y suffice.
    """
    p = linking.percent
    labelled = seated.join(labels.withColumnRenamed("v", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.filter("id <> hub").groupBy("key", "size").agg(
        F.min("label").alias("x"), F.max("label").alias("y")
    ).filter("x <> y").select("key", "size")
    spokes = salted_join(labelled.filter("id <> hub"), mixed, ["key", "size"], "id", _BUCKET_PARTS).select(
        "hub", "id", "label", F.col("n_shingles").alias("n")
    ).distinct()
    sizes = measured.select(F.col("a").alias("hub"), F.col("b").alias("id"), "both")
    spokes = written(spokes.join(sizes, ["hub", "id"]), "spokes")
    groups = spokes.groupBy("hub").agg(F.count("*").alias("members"))

    full = _text_pairs(spokes.select(F.col("hub").alias("a"), F.col("id").alias("b")), texts, linking)
    extras = F.explode(foreign_shingles(F.col("text_a"), F.col("text_b")))
    foreign = written(full.select(F.col("a").alias("hub"), F.col("b").alias("id"), extras.alias("s")), "foreign")
    counts = foreign.groupBy("hub", "s").agg(F.count("*").alias("c"))
    counts = salted_join(counts, groups, ["hub"], "s").withColumn("common", F.expr("4 * c > members"))
    counts = written(counts.filter("common or c > 1"), "counts")  # others count for nothing below
    foreign = written(
        foreign.join(counts.drop("members"), ["hub", "s"]).select("hub", "id", "s", "c", "common"), "counted"
    )
    held = foreign.filter("common").groupBy("hub", "id").agg(F.count("*").alias("more"))
    need = f"ceil({p} * (n + ceil({p} * n / 100.0)) / {100 + p}.0) - k"
    spokes = spokes.join(held, ["hub", "id"], "left").withColumn("k", F.expr("both + coalesce(more, 0)"))
    spokes = written(spokes.withColumn("need", F.expr(need).cast("int")).drop("both", "more"), "needs")

    own = W.partitionBy("hub", "id")
    first = foreign.filter("not common and c > 1").join(spokes, ["hub", "id"])
    # shingles of one member only come first in the order and lead nowhere: they count, unlisted
    first = first.withColumn("rank", F.row_number().over(own.orderBy("c", "s")) + F.col("n") - F.col("k") - F.count("*").over(own))
    first = written(
        first.filter("rank <= n - k - greatest(need, 1) + 1").select("hub", "s", "id", "label", "n", "k"), "first"
    )
    near_size = f"l.id < r.id and l.label <> r.label and 100 * least(l.n, r.n) >= {p} * greatest(l.n, r.n)"
    sharing = first.alias("l").join(first.alias("r"), F.expr(f"l.hub = r.hub and l.s = r.s and {near_size}"))
    close = spokes.filter("need <= 0")
    without = close.alias("l").join(
        close.alias("r"),
        F.expr(f"l.hub = r.hub and {near_size} and {p} * (l.n + r.n) <= {100 + p} * least(l.k, r.k)"),
    )
    pair = (F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    return sharing.select(*pair).union(without.select(*pair)).distinct()


def near_duplicates(docs: DataFrame, linking: Linking = Linking()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    1. Texts of one word sequence become one class, named by its smallest doc_id.
    2. Classes meet in the buckets of their bands. In each bucket all members are compared
       with its hub, the member that shares most places in buckets.
    3. Members of a bucket that are not connected yet are compared with each other, where what
       is known of them and the hub leaves a link possible. No pair that could link is left out.
    4. Components of the links, carried back to documents.

    Buckets and hubs of any size are spread: their rows are salted by id, what is known of the
    bucket or hub is repeated for each salt.

    Empty texts and rows without a doc_id are linked with nothing; the latter are kept and
    have no component. Rows of one doc_id are one node whatever their texts. Other columns of
    docs, of whatever name, are ignored.
    """
    tag = F.xxhash64("text").alias("tag")
    sketched = docs.select("doc_id", tag, sketches(F.col("text"), linking).alias("s")).select("doc_id", "tag", "s.*")
    sketched = written(sketched, "sketches")
    named = sketched.filter("doc_id is not null and n_shingles > 0")
    classes = written(
        named.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "tag")).alias("m"))
        .select("h1", "h2", F.col("m.doc_id").alias("uid"), F.col("m.tag").alias("tag")),
        "classes",
    )
    # one text for each class; its name is a number of its own where one doc_id names several
    first = classes.select(F.col("uid").alias("doc_id"), "tag", "h1", "h2")
    own = named.join(first, ["doc_id", "tag", "h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    own = written(own.withColumn("id", F.xxhash64("h1", "h2")), "own")

    # buckets with at least two members, their hubs
    places = own.select("id", "n_shingles", F.explode("bands").alias("key"))
    sizes = places.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    places = written(salted_join(places, sizes, ["key"], "id"), "places")
    degrees = places.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = written(places.join(degrees, "id"), "ranked")
    hubs = ranked.groupBy("key", "size").agg(F.max(F.struct("degree", "id", "n_shingles")).alias("h")).select(
        "key", "size", F.col("h.id").alias("hub")
    )
    seated = salted_join(ranked, hubs, ["key", "size"], "id", _BUCKET_PARTS)
    seated = written(seated.select("key", "size", "id", "n_shingles", "hub"), "seated")

    # texts of the classes that are in any bucket
    wanted = own.join(seated.select("id").distinct(), "id", "left_semi").select("doc_id", "tag", "id")
    texts = docs.select("doc_id", "text", tag).filter("doc_id is not null").dropDuplicates(["doc_id", "tag"])
    texts = written(texts.join(wanted, ["doc_id", "tag"]).select("id", "text"), "texts")

    spokes = seated.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    spokes = written(spokes, "pairs")
    measured = written(_confirm(spokes, texts, linking), "measured")
    linked = F.expr(f"100 * both >= {linking.percent} * either")
    links = measured.filter(linked).select("a", "b")
    labels = connected_components(links)

    still_open = written(_open_pairs(seated, measured, labels, texts, linking), "open")
    more = _confirm(still_open, texts, linking).filter(linked).select("a", "b")
    links = written(links.union(more), "links")

    # from classes to documents
    members = written(
        named.select("doc_id", "h1", "h2", F.xxhash64("h1", "h2").alias("id")).join(
            classes.select("h1", "h2", "uid"), ["h1", "h2"]
        ).select("doc_id", "id", "uid"),
        "members",
    )
    names = classes.select(F.xxhash64("h1", "h2").alias("id"), "uid")
    by_name = links.join(names.withColumnRenamed("id", "a").withColumnRenamed("uid", "ua"), "a").join(
        names.withColumnRenamed("id", "b").withColumnRenamed("uid", "ub"), "b"
    ).select(F.col("ua").alias("a"), F.col("ub").alias("b"))
    repeated = members.groupBy("doc_id").agg(F.min("uid").alias("least"), F.max("uid").alias("most")).filter("least <> most").select("doc_id")
    through = members.join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("uid").alias("b"))
    found = connected_components(by_name.union(through))
    per_doc = members.groupBy("doc_id").agg(F.min("uid").alias("v")).join(found, "v", "left").select(
        "doc_id", F.coalesce("label", "v").alias("component_id")
    )
    return sketched.select("doc_id", "n_shingles").join(per_doc, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )
