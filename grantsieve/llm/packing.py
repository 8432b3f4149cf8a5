"""Best-fit packing of documents into sequences, by partitions and then up a tree of them.

Every partition packs its own pieces. Nearly full bins leave as sequences. What is left,
underfull bins, are the items of the next round, in which a few partitions' bins meet; rounds go
on until all have met. A task holds a bounded number of pieces or bins at any time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .byte_level import byte_level_encoder, text_slices
from .tables import written

END_ID = 0


@dataclass(frozen=True)
class Packing:
    """Sequences of at most `capacity` tokens. Bins with a gap of at most `slack` are done.

    `block`: pieces that a partition packs at a time. `fan`: parts that meet in a round.
    `open_bins`: the least full bins that a part hands on. Two bins of one part never fit
    together, so at most one of them is half empty: a part can save one sequence only by
    meeting others, and bins beyond this number are done without a loss worth having.
    """

    capacity: int = 2048
    slack: int = 8
    block: int = 50_000
    fan: int = 8
    open_bins: int = 2_000


MEMBER = "row:bigint,doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint"
PIECES = MEMBER.replace(":", " ") + ", ids binary"
BINS = f"part int, sequence_id bigint, size bigint, open boolean, members array<struct<{MEMBER}>>"
_FIELDS = [f.split(":")[0] for f in MEMBER.split(",")]

Item = tuple[int, list[tuple]]


def cuts(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of n tokens: full ones, but for the first."""
    return [0, *range((n - 1) % capacity + 1, n + 1, capacity)]


def pieces(docs: DataFrame, vocabulary_path: str, packing: Packing = Packing()) -> DataFrame:
    """A row per piece of a document: its ids as little-endian bytes, where it starts in the
    document, and the crc32 of its ids as 32-bit numbers. `row` numbers the pieces.

    A document is its text's ids and an end id; a null text is empty. Only documents of more
    than `capacity` tokens are cut.
    """
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], PIECES).schema)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = byte_level_encoder(vocabulary_path), TaskContext.get().partitionId() << 33
        end = np.array([END_ID], enc.dtype).tobytes()
        for batch in batches:
            for part, texts in text_slices(batch, 1):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode([t or "" for t in texts])):
                    ids = np.frombuffer(ids + end, enc.dtype)
                    bounds = cuts(len(ids), packing.capacity)
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        crc = zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        rows.append((row, doc_id, k, a, b - a, crc, ids[a:b].tobytes()))
                        row += 1
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_fit(items: list[Item], capacity: int) -> list[Item]:
    """Bins of the items, largest first, each put where the least room is left."""
    bins: list[list] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room for r more
    for size, members in sorted(items, key=lambda x: (-x[0], x[1][0])):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b][0] += size
            bins[b][1].extend(members)
        else:
            b, room = len(bins), capacity
            bins.append([size, list(members)])
        room -= size
        by_room[room].append(b)
        rooms |= 1 << room
    return [(size, members) for size, members in bins]


def settled(bins: list[Item], p: Packing) -> tuple[list[Item], list[Item]]:
    """Bins that are done, and the others, at most `open_bins`, the least full ones."""
    bins = sorted(bins, key=lambda x: (x[0], x[1][0]))
    n = min(p.open_bins, sum(size < p.capacity - p.slack for size, _ in bins))
    return bins[n:], bins[:n]


def _batches(bins: list[Item], part: int, base: int, still_open: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    member = schema.field("members").type.value_type
    for i in range(0, len(bins), 5_000):
        some = bins[i : i + 5_000]
        columns = list(zip(*[m for _, ms in some for m in ms]))
        flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, member)], fields=list(member))
        offsets = np.cumsum([0, *[len(ms) for _, ms in some]])
        arrays = [
            pa.array([part] * len(some), pa.int32()), pa.array(range(base + i, base + i + len(some)), pa.int64()),
            pa.array([size for size, _ in some], pa.int64()), pa.array([still_open] * len(some), pa.bool_()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, type=schema.field("members").type),
        ]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _first_id(round_: int, part: int) -> int:
    return round_ << 56 | part << 32


def pack_parts(cut: DataFrame, p: Packing) -> DataFrame:
    """Bins of every partition's pieces. Blocks follow each other: what one leaves open are
    items of the next."""
    schema = to_arrow_schema(cut.sparkSession.createDataFrame([], BINS).schema)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base, items = _first_id(0, part), []
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            for i in range(0, len(rows), p.block):
                items += [(m[4], [m]) for m in rows[i : i + p.block]]
                if len(items) >= p.block:
                    done, items = settled(best_fit(items, p.capacity), p)
                    yield from _batches(done, part, base, False, schema)
                    base += len(done)
        done, left = settled(best_fit(items, p.capacity), p)
        yield from _batches(done, part, base, False, schema)
        yield from _batches(left, part, base + len(done), True, schema)

    return cut.select(*_FIELDS).mapInArrow(pack, BINS)


def pack_bins(open_bins: DataFrame, p: Packing, round_: int) -> DataFrame:
    """The next round: open bins of `fan` parts as the items of one."""
    schema = to_arrow_schema(open_bins.sparkSession.createDataFrame([], BINS).schema)

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        items = [
            (size, [tuple(m.values()) for m in members])
            for size, members in zip(group["size"].to_pylist(), group["members"].to_pylist())
        ]
        done, left = settled(best_fit(items, p.capacity), p)
        base = _first_id(round_, part)
        return pa.Table.from_batches(
            [*_batches(done, part, base, False, schema), *_batches(left, part, base + len(done), True, schema)], schema
        )

    met = open_bins.withColumn("part", F.expr(f"cast(part div {p.fan} as int)"))
    return met.groupBy("part").applyInArrow(pack, BINS)


def pack(cut: DataFrame, p: Packing = Packing()) -> DataFrame:
    """(sequence_id, size, members) of every sequence of the given pieces; members stand in
    their order in the sequence."""
    rounds = [written(pack_parts(cut, p), "bins")]
    last = rounds[0].agg(F.max("part").alias("part")).first()["part"]  # one number
    while last:
        rounds.append(written(pack_bins(rounds[-1].filter("open"), p, len(rounds)), "bins"))
        last //= p.fan
    out = rounds[-1]
    for r in rounds[:-1]:
        out = out.unionByName(r.filter("NOT open"))
    return out.select("sequence_id", "size", "members")


def placements(packed: DataFrame) -> DataFrame:
    """A row per piece with its sequence and its offset there."""
    member = packed.select("sequence_id", "members", F.posexplode("members").alias("i", "m"))
    before = F.aggregate(
        F.slice("members", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda n, m: n + m["length"]
    )
    return member.select("m.*", "sequence_id", before.alias("offset"))


def sequences(packed: DataFrame, cut: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the ids of every sequence, and where its pieces start.

    A sequence's pieces, at most its capacity, meet by sequence; ids move once.
    """
    ids = placements(packed).select("row", "sequence_id", "offset").join(cut.select("row", "ids"), "row")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    grouped = ids.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", whole.alias("ids"), F.col("parts.offset").alias("starts"))


def pack_documents(docs: DataFrame, vocabulary_path: str, p: Packing = Packing()) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of docs is a document, rows with a repeated or null doc_id too. A null or empty
    text is a piece of the end id alone. An empty table gives no row. Other columns of docs, of
    whatever name, are ignored.
    """
    cut = written(pieces(docs, vocabulary_path, p), "pieces")
    return placements(pack(cut, p)).drop("row")
