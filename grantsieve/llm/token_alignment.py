"""Two vocabularies' tokens of the same texts, aligned by the bytes they stand for.

Texts are encoded whole by both. Where tokens of both end and the next ones start with a space,
a text is cut into windows; a window is known by its ids alone, so it is aligned once while it
stays in the memo. Blocks of documents number their windows and the linked id pairs, only
pairs and their counts meet corpus-wide, and each block gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .byte_level import byte_level_encoder, plain_words, text_slices
from .tables import written

_BLOCK_BYTES = 16_000_000
_ID_BITS = 16
_MEMO_WORDS = 150_000
#: No id of either vocabulary: parts the two sides of a window's key.
_BETWEEN = b"\xff\xff"


def _found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among the others; both ascend."""
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


class PieceEncoder:
    """Ids of a sentencepiece model, as 16-bit bytes, from a memo of words.

    No piece holds a space behind another sign, so nothing is merged across the start of a word
    and a text's ids are its words' ids. A model with such pieces, and texts that start with a
    space, hold spaces next to other white space or the model's own sign for it, are encoded
    whole. Texts are not empty.
    """

    def __init__(self, model):
        self.model = model
        pieces = map(model.id_to_piece, range(model.get_piece_size()))
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u2").tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > _MEMO_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        words = [plain_words(t) if self.by_word and t[0] != " " and "▁" not in t else None for t in texts]
        new = set().union(*filter(None, words)).difference(young)
        known = new.intersection(old)
        young.update(zip(known, map(old.__getitem__, known)))
        new = list(new.difference(known))
        young.update(zip(new, self._ids(new)))
        whole = iter(self._ids([t for t, w in zip(texts, words) if w is None]))
        return [next(whole) if w is None else b"".join(map(young.__getitem__, w)) for w in words]


class Aligner:
    """Vocabulary A: byte-level of the tokenizers library, of a space and the text. B: a
    sentencepiece model, of the text, to which it adds the space. Special strings are text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = byte_level_encoder(a_path, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.pieces = PieceEncoder(self.b)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = self.a.token_bytes
        if max(len(self.a_bytes), len(self.b_bytes)) >= 1 << _ID_BITS:
            raise ValueError("vocabularies of 65,535 ids or more are not supported")
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in v]) for v in (self.a_bytes, self.b_bytes))
        self.written = [[f"{i}{sign}" for i in range(1 << _ID_BITS)] for sign in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both; None for an empty text or one that the ids do not give back."""
        full = [t for t in texts if t]
        both = iter(zip(full, self.a.encode([" " + t for t in full]), self.pieces.encode(full)))
        out = []
        for t in texts:
            if not t:
                out.append(None)
                continue
            _, a, b = next(both)
            a, b, want = np.frombuffer(a, self.a.dtype), np.frombuffer(b, "<u2"), (" " + t).encode()
            # entries of a byte-level vocabulary stand for the text's own bytes: none may be missing
            same = int(self.a_size[a].sum()) == len(want) and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == want
            out.append((a, b) if same else None)
        return out

    def windows(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Keys of the windows of texts laid end to end, and how many end before each of the
        given token places of A, at which texts start or end."""
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.searchsorted(b_ends, a_ends)
        shared = np.flatnonzero(b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends)
        nth_b = at[shared]
        anchor = self.a_space[a[np.minimum(shared + 1, len(a) - 1)]] & self.b_space[b[np.minimum(nth_b + 1, len(b) - 1)]]
        bound = np.zeros(len(a) + 1, bool)
        bound[starts] = True
        anchor |= bound[shared + 1]
        a_cut, b_cut = shared[anchor] + 1, nth_b[anchor] + 1
        a_data, b_data = a.astype("<u2").tobytes(), b.tobytes()
        a_stop, b_stop = (2 * a_cut).tolist(), (2 * b_cut).tolist()
        keys = [
            a_data[i:j] + _BETWEEN + b_data[k:m] for i, j, k, m in zip([0, *a_stop], a_stop, [0, *b_stop], b_stop)
        ]
        return keys, np.searchsorted(a_cut, starts, side="right")

    def align(self, keys: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Windows by their keys, all at once: the groups of each as text, their numbers, the
        numbers of links, and the linked pairs as a << 16 | b, window after window.

        Between two neighbouring ends, of either side, lie exactly one token of A and one of B,
        and each overlap of two tokens is one such stretch.
        """
        ids = np.frombuffer(b"".join(keys), "<u2")
        window = np.repeat(np.arange(len(keys)), [len(k) // 2 for k in keys])
        middle = np.flatnonzero(ids == 0xFFFF)
        place = np.arange(len(ids)) - middle[window]
        a, b, a_window = ids[place < 0], ids[place > 0], window[place < 0]
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_shared, b_shared = _found(a_ends, b_ends), _found(b_ends, a_ends)
        ends = np.sort(np.concatenate([a_ends, b_ends[~b_shared]]), kind="stable")
        a_at = np.searchsorted(a_ends, ends)
        pairs = a[a_at].astype(np.uint32) << np.uint32(_ID_BITS) | b[np.searchsorted(b_ends, ends)]
        n_groups = np.bincount(a_window[a_shared], minlength=len(keys))
        n_links = np.bincount(a_window[a_at], minlength=len(keys))
        # tokens in the order of the text: by group, A's before B's; each with the sign behind it
        group = np.concatenate([np.cumsum(a_shared) - a_shared, np.cumsum(b_shared) - b_shared])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        last = np.concatenate([a_shared, b_shared])
        sign = np.where(last, 1 + side, 0)[order].tolist()
        number = np.concatenate([a, b])[order].tolist()
        tokens = [self.written[k][i] for k, i in zip(sign, number)]
        stops = np.cumsum(np.bincount(window, minlength=len(keys)) - 1).tolist()
        texts = ["".join(tokens[i:j])[:-1] for i, j in zip([0, *stops], stops)]
        return texts, n_groups, n_links, pairs


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


@dataclass
class Block:
    """Documents whose windows and pairs are numbered together."""

    aligner: Aligner
    number: dict[bytes, int] = field(default_factory=dict)
    texts: list[str] = field(default_factory=list)
    n_groups: list[np.ndarray] = field(default_factory=list)
    n_links: list[np.ndarray] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)
    lists: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def _numbers(self, keys: list[bytes]) -> np.ndarray:
        """Windows by number; new ones are aligned."""
        new = list(set(keys).difference(self.number))
        if new:
            self.number.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
            texts, *arrays = self.aligner.align(new)
            self.texts += texts
            for kept, x in zip((self.n_groups, self.n_links, self.links), arrays):
                kept.append(x)
        return np.fromiter(map(self.number.__getitem__, keys), np.uint32, len(keys))

    def add(self, doc_ids: list[int | None], texts: list[str | None]) -> list[str]:
        """Takes documents in and returns their groups as text."""
        self.size += sum(len(t) for t in texts if t)
        ids = self.aligner.encode(texts)
        good = [x for x in ids if x is not None]
        windows, bounds = np.empty(0, np.uint32), iter(())
        if good:
            starts = np.cumsum([len(a) for a, _ in good])
            keys, ends = self.aligner.windows(*(np.concatenate(side) for side in zip(*good)), starts)
            windows = self._numbers(keys)
            bounds = iter(zip([0, *ends.tolist()], ends.tolist()))
        out, text_of = [], self.texts.__getitem__
        for doc_id, pair in zip(doc_ids, ids):
            own = windows[slice(*next(bounds))] if pair is not None else windows[:0]
            groups = ";".join(map(text_of, own.tolist()))
            n_a, n_b = map(len, pair) if pair is not None else (0, 0)
            self.rows.append((doc_id, n_a, n_b, hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
            self.lists.append(own)
            out.append(groups)
        return out

    def pages(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The documents and the windows as compressed tables, then the pairs and their counts."""
        joined = lambda arrays, kind: np.concatenate([*arrays, np.empty(0, kind)])
        windows, links = joined(self.lists, np.uint32), joined(self.links, np.uint32)
        n_links, n_groups = joined(self.n_links, np.int64), joined(self.n_groups, np.int64)
        pairs, rank = np.unique(links, return_inverse=True)
        times = np.bincount(windows, minlength=len(self.texts))
        # sums of whole numbers far below 2 ** 53
        counts = np.bincount(rank, np.repeat(times, n_links), len(pairs)).astype(np.int64)
        bounds = np.cumsum([0, *[len(x) for x in self.lists]])
        sums = [_sums(n[windows], bounds) for n in (n_groups, n_links)]
        doc_ids, n_a, n_b, sha = zip(*self.rows)
        columns = [pa.array(c, pa.int64()) for c in (doc_ids, n_a, n_b, *sums)]
        docs = pa.table([*columns, pa.array(sha), _lists(bounds, windows)], [*DOC[:6], "windows"])
        of_windows = pa.table([_lists(np.cumsum([0, *n_links]), rank.astype(np.uint32))], ["pairs"])
        return [_packed(docs), _packed(of_windows)], pairs.astype(np.int64), counts


DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
DOCS = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in DOC)
BLOCKS = "block bigint, pages array<binary>, pair bigint, n bigint"


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums between neighbouring bounds."""
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(values, pa.uint32()))


def _packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _list_values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.int64)
    one = column.combine_chunks()
    return one.offsets.to_numpy(), one.values.to_numpy()


def blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows (block, pages) with a block's documents and windows, and rows (block, pair, n) with
    the id pairs linked in it and how often."""
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], BLOCKS).schema)

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32

        def rows(block: Block) -> Iterator[pa.RecordBatch]:
            pages, pairs, counts = block.pages()
            columns = [[number], [pages], [None], [None]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            for i in range(0, len(pairs), 50_000):
                p = pairs[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), number)), pa.nulls(len(p), schema.field("pages").type), pa.array(p),
                     pa.array(counts[i : i + 50_000])], schema=schema,
                )

        block = Block(tool)
        for batch in batches:
            for part, texts in text_slices(batch, 1):
                block.add(part.column(0).to_pylist(), texts)
                if block.size >= _BLOCK_BYTES:
                    yield from rows(block)
                    number, block = number + 1, Block(tool)
        if block.rows:
            yield from rows(block)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(align, BLOCKS)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best) over all blocks: links that hold the pair, and whether no pair of its B
    id has more. pair is a << 16 | b."""
    totals = written(found.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.expr(f"pair & {(1 << _ID_BITS) - 1}")
    # a row per id of vocabulary B, 65,535 at most: small enough to be sent to all tasks
    most = totals.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    rated = totals.withColumn("b", b).join(F.broadcast(most), "b")
    return rated.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(pages: pa.Table, stats: pa.Table) -> pa.Table:
    """Documents of one block with n_best and count_sum, from the counts of its pairs."""
    docs, links = map(_unpacked, pages["pages"][0].as_py())
    order = np.argsort(stats["pair"].to_numpy())
    at, rank = _list_values(links["pairs"])
    bounds, windows = _list_values(docs["windows"])
    sums = []
    for column in (stats["best"].cast(pa.int64()), stats["n"]):
        of_window = _sums(column.to_numpy()[order][rank], at)
        sums.append(pa.array(_sums(of_window[windows], bounds), pa.int64()))
    return pa.table([docs[c] for c in DOC[:6]] + sums, list(DOC))


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    A text that is null, empty or not given back by its ids has no tokens: zeros and an empty
    hash. Every row of docs is a document, rows with a repeated or null doc_id too, and counts.
    An empty table gives no row. Other columns of docs, of whatever name, are ignored.
    """
    found = written(blocks(docs, a_path, b_path), "blocks")
    asked = found.filter("pair IS NOT NULL").select(F.col("block").alias("of"), "pair")
    stats = asked.join(pair_counts(found), "pair").select("of", "pair", "n", "best")
    pages = found.filter("pages IS NOT NULL").select("block", "pages")
    return pages.groupBy("block").cogroup(stats.groupBy("of")).applyInArrow(_scored, DOCS)


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups): the aligned groups of every document, `a1,a2|b1;a3|b2,b3` by ids."""

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, 1):
                groups = Block(aligner(a_path, b_path)).add(part.column(0).to_pylist(), texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(groups, pa.string())], ["doc_id", "groups"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(align, "doc_id bigint, groups string")
