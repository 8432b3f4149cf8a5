"""Benchmark passages in documents: shared character q-grams by diagonal band, then alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Budget:
    """An item of m characters may differ by edit_rate * m edits, or fewer where q-grams could
    not show it. Items of under exact_chars characters tell little when changed: they are found
    unchanged only, and where they neither start nor end inside a word.
    block_chars: characters of items that are searched in one pass over the documents."""

    q: int = 8
    edit_rate: float = 0.1
    exact_chars: int = 24
    block_chars: int = 8_000_000

    def edits(self, m: int) -> int:
        """Most edits that still leave one shared q-gram at least: m - q + 1 - k * q >= 1."""
        return max(0, min(int(self.edit_rate * m), (m - self.q) // self.q)) if m >= self.exact_chars else 0

    def shared(self, m: int) -> int:
        """q-gram lemma: so many positions of the item keep their q-gram under the budget."""
        return m - self.q + 1 - self.edits(m) * self.q


# small enough for a core's own cache
_CHUNK_CHARS = 120_000
_PAIRS = 256
_P = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str) -> str:
    """Lower case, with single spaces for white space."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of the q characters from each position on."""
    wide = chars.astype(np.uint64)
    h = np.zeros(max(0, len(chars) - q + 1), np.uint64)
    for i in range(q):
        h *= _P
        h += wide[i : i + len(h)]
    h ^= h >> np.uint64(29)
    h *= _P
    return h


def _in_word(chars: np.ndarray, at: int) -> bool:
    """Whether a word runs on across this place."""
    return 0 < at < len(chars) and all(c < 0x110000 and chr(c).isalnum() for c in chars[at - 1 : at + 1].tolist())


class Index:
    """q-grams of one block of items, as sorted hashes with their places."""

    def __init__(self, items: list[tuple[object, str]], budget: Budget):
        self.budget = budget
        texts = [(i, plain(t or "")) for i, t in items]
        texts = [(i, codes(t)) for i, t in texts if t]
        # too short for a q-gram: looked up whole, by length
        self.short: dict[int, list[tuple[object, np.ndarray]]] = {}
        for i, t in texts:
            if len(t) < budget.q:
                self.short.setdefault(len(t), []).append((i, t))
        texts = [(i, t) for i, t in texts if len(t) >= budget.q]
        self.ids, self.texts = [i for i, _ in texts], [t for _, t in texts]
        hashes = [gram_hashes(t, budget.q) for t in self.texts]
        item = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        grams = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        bits = min(26, max(16, (16 * len(self.grams)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.grams >> self.shift] = True
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([budget.edits(len(t)) for t in self.texts], np.int64)
        self.need = np.array([budget.shared(len(t)) for t in self.texts], np.int64)

    def search(self, texts: list[str]) -> list[list[dict]]:
        """For each text one match per item found: the best region, as characters of the plain
        text. Texts are laid end to end, with a sign between them that no item holds."""
        out: list[list[dict]] = [[] for _ in texts]
        if not len(self.grams) and not self.short:
            return out
        at, group, size = 0, [], 0
        for k, t in enumerate(texts):
            group.append(codes(t))
            size += len(t)
            if size >= _CHUNK_CHARS or k == len(texts) - 1:
                self._search(group, out[at : k + 1])
                at, group, size = k + 1, [], 0
        return out

    def _search(self, group: list[np.ndarray], out: list[list[dict]]) -> None:
        q, gap = self.budget.q, np.full(1, 0xFFFFFFFF, np.uint32)
        chars = np.concatenate([x for t in group for x in (t, gap)])
        starts = np.cumsum([0] + [len(t) + 1 for t in group])
        self._short_items(group, out, chars, starts)
        if not len(self.grams):
            return
        h = gram_hashes(chars, q)
        where = np.flatnonzero(self.seen[h >> self.shift])
        gram = np.searchsorted(self.grams, h[where])
        gram[gram == len(self.grams)] = 0
        real = self.grams[gram] == h[where]
        where, gram = where[real], gram[real]
        # every place of the gram in the items
        times = self.count[gram]
        end = np.cumsum(times)
        posting = np.arange(end[-1] if len(end) else 0) - np.repeat(end - times, times) + np.repeat(self.first[gram], times)
        item, place, pos = self.item[posting], self.place[posting], np.repeat(where, times)
        doc = np.searchsorted(starts, pos, side="right") - 1
        # a document has to hold enough of an item's q-grams, wherever they are
        _, pair, hits = np.unique(doc * len(self.ids) + item, return_inverse=True, return_counts=True)
        enough = hits[pair] >= self.need[item]
        doc, item, place, pos = doc[enough], item[enough], place[enough], pos[enough]
        diagonal = pos - starts[doc] - place
        best = self._unchanged(group, doc, item, diagonal)
        self._bands(group, best, doc, item, place, diagonal)
        for (d, i), (edits, start, stop) in sorted(best.items()):
            out[d].append({"item_id": self.ids[i], "start": start, "end": stop, "edits": edits})

    def _short_items(self, group, out, chars, starts) -> None:
        for m, items in self.short.items():
            h = gram_hashes(chars, m)
            of_items = np.concatenate([gram_hashes(t, m) for _, t in items])
            where = np.flatnonzero(np.isin(h, of_items))
            found: dict[tuple[int, int], int] = {}
            for p in where.tolist():
                d = int(np.searchsorted(starts, p, side="right")) - 1
                a = p - int(starts[d])
                for n in np.flatnonzero(of_items == h[p]).tolist():
                    if (d, n) not in found and self._stands(group[d], items[n][1], a):
                        found[d, n] = a
            for (d, n), a in sorted(found.items()):
                out[d].append({"item_id": items[n][0], "start": a, "end": a + m, "edits": 0})

    @staticmethod
    def _stands(text: np.ndarray, item: np.ndarray, a: int) -> bool:
        """Whether the item stands there, as words of its own."""
        b = a + len(item)
        return np.array_equal(text[a:b], item) and not _in_word(text, a) and not _in_word(text, b)

    def _unchanged(self, group, doc, item, diagonal) -> dict[tuple[int, int], tuple[int, int, int]]:
        """The first place of each item that stands unchanged in a document: all its q-grams
        share a diagonal there, and need no alignment."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not len(doc):
            return best
        order = np.lexsort((diagonal, item, doc))
        d, i, x = doc[order], item[order], diagonal[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (x[1:] != x[:-1])
        heads = np.flatnonzero(new)
        full = np.diff(heads, append=len(d)) >= self.size[i[heads]] - self.budget.q + 1
        for d, i, x in zip(d[heads[full]].tolist(), i[heads[full]].tolist(), x[heads[full]].tolist()):
            text, m = self.texts[i], int(self.size[i])
            if (d, i) in best or x < 0:
                continue
            if m < self.budget.exact_chars and self._stands(group[d], text, x):
                best[d, i] = (0, x, x + m)
            elif m >= self.budget.exact_chars and np.array_equal(group[d][x : x + m], text):
                best[d, i] = (0, x, x + m)
        return best

    def _bands(self, group, best, doc, item, place, diagonal) -> None:
        """Counts distinct places of an item by band. Bands of 2w diagonals start every w = k + 1
        of them, so the diagonals of one match, which differ by k at most, share a band."""
        far = self.edits[item] > 0
        if not far.any():
            return
        doc, item, place, diagonal = doc[far], item[far], place[far], diagonal[far]
        w = self.edits[item] + 1
        band = np.floor_divide(diagonal, w)
        doc, item, place = (np.concatenate([x, x]) for x in (doc, item, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, doc))
        doc, item, place, band = doc[order], item[order], place[order], band[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        distinct = new.copy()
        distinct[1:] |= place[1:] != place[:-1]
        heads = np.flatnonzero(new)
        shared = np.add.reduceat(distinct.astype(np.int64), heads)
        good = heads[shared >= self.need[item[heads]]]
        pairs = [p for p in zip(doc[good].tolist(), item[good].tolist(), band[good].tolist()) if p[:2] not in best]
        pairs.sort(key=lambda p: -len(self.texts[p[1]]))
        for n in range(0, len(pairs), _PAIRS):
            some = pairs[n : n + _PAIRS]
            for (d, i, _), found in zip(some, self._align(group, some)):
                if found and best.get((d, i), (1 << 60,)) > found:
                    best[d, i] = found

    def _align(self, group, pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int] | None]:
        """For each (document, item, band), longest items first: (edits, start, end) of the
        item's best alignment whose diagonals lie in the band and k to either side; None over
        budget. Columns are diagonals, rows are pairs: a sign of all items is one step."""
        k = self.edits[[i for _, i, _ in pairs]]
        size = self.size[[i for _, i, _ in pairs]]
        low, width = np.array([b for _, _, b in pairs]) * (k + 1) - k, 4 * k + 2
        wide, longest = int(width.max()), int(size[0])
        items = np.zeros((len(pairs), longest), np.uint32)
        # far beyond the text: a sign that matches nothing
        padded = np.full((len(pairs), longest + wide), 0xFFFFFFFE, np.uint32)
        for n, (d, i, _) in enumerate(pairs):
            text, m, at = group[d], int(size[n]), int(low[n])
            items[n, :m] = self.texts[i]
            a, b = max(0, at), min(len(text), at + m + int(width[n]))
            if b > a:
                padded[n, a - at : b - at] = text[a:b]
        columns, big = np.arange(wide), np.int64(1 << 40)
        beyond = np.where(columns >= width[:, None], np.int64(1) << np.int64(60), np.int64(0))
        key = np.maximum(np.broadcast_to(columns, beyond.shape), beyond)  # the cost, and below it where the alignment began
        for r in range(longest):
            n = int(np.searchsorted(-size, -r, side="left"))  # items that have a sign here
            if r % 16 == 15 and (key[:n].min(axis=1) >> 40 > k[:n]).all():
                break
            step = key[:n] + (padded[:n, r : r + wide] != items[:n, r : r + 1]) * big
            step[:, :-1] = np.minimum(step[:, :-1], key[:n, 1:] + big)
            # a sign more in the text: from the diagonal to the left
            step = np.minimum.accumulate(step - columns * big, axis=1) + columns * big
            key[:n] = np.maximum(step, beyond[:n])
        at = np.argmin(key >> 40, axis=1)
        ends = key[np.arange(len(pairs)), at]
        return [
            (e >> 40, max(0, a + (e & (1 << 40) - 1)), min(len(group[d]), a + c + m)) if e >> 40 <= most else None
            for (d, _, _), e, a, c, m, most in zip(pairs, ends.tolist(), low.tolist(), at.tolist(), size.tolist(), k.tolist())
        ]


MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>"


def passages(text: Column, index: Index) -> Column:
    """Matches of one index in a text column; null has none."""
    match = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])

    @F.arrow_udf(MATCHES)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array(index.search([plain(t or "") for t in texts.to_pylist()]), pa.list_(match))

    return found(text)


def item_blocks(benchmark: DataFrame, budget: Budget = Budget()) -> Iterator[Index]:
    """The benchmark, a block of bounded size at a time; each is searched over all documents."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").orderBy("item_id", "text").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
        if size >= budget.block_chars:
            yield Index(block, budget)
            block, size = [], 0
    if block:
        yield Index(block, budget)


def find_passages(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the best region of each item in each document, as
    places in the document's plain form (see ``plain``).

    Documents without a passage have no row. Null texts on either side match nothing; null
    ids are carried along; repeated documents and items give repeated rows. Other columns of
    either table, of whatever name, are ignored.
    """
    parts = [
        docs.select("doc_id", F.explode(passages(F.col("text"), index)).alias("m")).select("doc_id", "m.*")
        for index in item_blocks(benchmark, budget)
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_passages(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """Rows of docs, with all their columns, whose text holds no item."""
    for index in item_blocks(benchmark, budget):
        docs = docs.filter(F.size(passages(F.col("text"), index)) == 0)
    return docs
