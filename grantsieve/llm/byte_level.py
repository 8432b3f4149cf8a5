"""Token ids of whole texts by byte-level vocabularies, from a memo of their words."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MEMO_WORDS = 250_000
_GROUP = 256
_SLICE_BYTES = 2_000_000
# a space that no other sign than white space follows starts no word
_LOOSE = re.compile(r" (?:\s|\Z)").search
_CUT = re.compile(r" (?=\S)").split
_ENDING = re.compile(r"(?<=[A-Za-z0-9])[.,;:!?)]+\Z").search
_END_SIGNS = frozenset(".,;:!?)")


def byte_of_sign() -> dict[str, int]:
    """The signs by which byte-level vocabularies write bytes: printable ones as themselves,
    all others, in order, as the signs from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_words(text: str) -> list[str] | None:
    """The words between spaces; None where a space stands next to other white space behind it
    or ends the text."""
    return None if _LOOSE(text) else text.split(" ")


class ByteLevelEncoder:
    """Ids as little-endian bytes of ``dtype``.

    The vocabulary's pre-tokenizer always starts a token at a space that a sign other than
    white space follows. So the ids of a text are those of its words, each with the space in
    front, one after another. Words are encoded once while they stay in the memo; new ones go
    to the tokenizer many in one text and are told apart by the bytes of their tokens. Texts
    that hold a special string are encoded whole, unless special strings count as text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"] if not special_as_text]
        signs = byte_of_sign()
        entries = sorted((i, s) for s, i in self.tokenizer.get_vocab(with_added_tokens=False).items())
        self.token_bytes = [b""] * self.tokenizer.get_vocab_size()
        for i, s in entries:
            self.token_bytes[i] = bytes(signs[c] for c in s) if all(c in signs for c in s) else s.encode()
        self.sizes = np.array([len(b) for b in self.token_bytes], np.int64)
        self.dtype = np.dtype("<u2" if len(self.token_bytes) <= 1 << 16 else "<u4")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in found]

    def _learn(self, words: set[str]) -> None:
        """Words by their keys: a word behind a space as it is, the start of a text behind a space."""
        young, old, ended = self.young, self.old, []
        words = words.difference(young)
        if old and words:
            known = words.intersection(old)
            young.update(zip(known, map(old.__getitem__, known)))
            words.difference_update(known)
        ending = [w for w in words if w[-1] in _END_SIGNS]
        words.difference_update(ending)
        for w in ending:
            if w[0] != " " and (end := _ENDING(w)):  # a run of such signs is a token of its own
                word, signs = w[: end.start()], " " + w[end.start() :]
                ended.append((w, word, signs))
                words.update(x for x in (word, signs) if x not in young)
            else:
                words.add(w)
        missing = list(words)
        starts = [w for w in missing if w[0] == " "]
        for w, ids in zip(starts, self._ids([w[1:] for w in starts])):
            young[w] = ids.tobytes()
        spaced = [w for w in missing if w[0] != " "]
        groups = [spaced[i : i + _GROUP] for i in range(0, len(spaced), _GROUP)]
        for group, ids in zip(groups, self._ids([" " + " ".join(g) for g in groups])):
            ends = np.cumsum(self.sizes[ids])
            cuts = np.cumsum([len(w.encode()) + 1 for w in group])
            at = np.searchsorted(ends, cuts)
            if (ends[np.minimum(at, len(ends) - 1)] != cuts).any():  # should a library see another white space
                young.update((w, i.tobytes()) for w, i in zip(group, self._ids([" " + w for w in group])))
                continue
            data, stops = ids.tobytes(), ((at + 1) * self.dtype.itemsize).tolist()
            young.update((w, data[a:b]) for w, a, b in zip(group, [0, *stops], stops))
        for w, word, end in ended:
            young[w] = young[word] + young[end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self.young) > _MEMO_WORDS:
            self.old, self.young = self.young, {}
        whole = [any(s in t for s in self.special) for t in texts]
        words = []
        for t, as_one in zip(texts, whole):
            w = [""] if as_one else _CUT(t) if _LOOSE(t) else t.split(" ")
            w[0] = " " + w[0]
            words.append(w)
        self._learn(set().union(*words))
        get = self.young.__getitem__
        return [
            self._ids([t])[0].tobytes() if as_one else b"".join(map(get, w)) for t, w, as_one in zip(texts, words, whole)
        ]


@lru_cache(maxsize=2)
def byte_level_encoder(path: str, special_as_text: bool = False) -> ByteLevelEncoder:
    return ByteLevelEncoder(path, special_as_text)


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A batch in parts of bounded text size, each with its texts. Bytes that are not UTF-8
    count as replacement signs."""
    data = batch.column(column).cast(pa.large_binary())
    begin = size = 0
    lengths = pc.fill_null(pc.binary_length(data), 0).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= _SLICE_BYTES or i == len(lengths) - 1:
            texts = data.slice(begin, i + 1 - begin).to_pylist()
            yield batch.slice(begin, i + 1 - begin), [None if t is None else t.decode("utf-8", "replace") for t in texts]
            begin, size = i + 1, 0
