"""Token ids as flat unsigned integer files with 64-bit document offsets."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark import TaskContext

END_ID = 2
_MEMO_CHUNKS = 250_000
_GROUP = 256
_ENDING = re.compile(rb"(?<=[A-Za-z0-9])[.,;:!?)]+\Z").search
_END_SIGNS = frozenset(b".,;:!?)")
_READ_IDS = 4_000_000
_BATCH_BYTES = 2_000_000


class Encoder:
    """Ids of whole texts, as little-endian 16- or 32-bit bytes.

    The vocabulary's pre-tokenizer never joins signs across white space, so a text's ids are
    those of its white-space-free chunks one after another. Chunks are encoded once while they
    stay in the memo. New ones of letters alone, each one word to the vocabulary, reach the
    tokenizer many in one text, and are told apart by the tokens that end a word. The vocabulary
    folds case, so A-Z are lower-cased first; what words of a-z are then split and folded by
    leaves them as they are, so for these a copy of the tokenizer splits at spaces alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        mark, steps = spec["model"]["end_of_word_suffix"], (spec["normalizer"] or {}).get("normalizers", ())
        if not mark or not any(n["type"] == "Lowercase" for n in steps):
            raise ValueError("a vocabulary with ends of words that folds case is needed")
        self.special = [t["content"].lower().encode() for t in spec["added_tokens"]]
        self.of_words = Tokenizer.from_file(path)
        self.of_words.normalizer, self.of_words.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(mark)]] = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in found]

    def _learn(self, chunks: set[bytes]) -> None:
        young, old, ended = self.young, self.old, []
        chunks = chunks.difference(young)
        if old and chunks:
            known = chunks.intersection(old)
            young.update(zip(known, map(old.__getitem__, known)))
            chunks.difference_update(known)
        ending = [c for c in chunks if c[-1] in _END_SIGNS]
        chunks.difference_update(ending)
        for c in ending:
            if end := _ENDING(c):  # a run of such signs is a token of its own
                word, signs = c[: end.start()], c[end.start() :]
                ended.append((c, word, signs))
                chunks.update(x for x in (word, signs) if x not in young)
            else:
                chunks.add(c)
        words = [c for c in chunks if c.isalpha() and c.islower()]  # of a-z
        others = {c: c.decode("utf-8", "replace") for c in chunks.difference(words)}
        of_letters = [c for c, text in others.items() if text.lower().isalpha()]
        for some, tokenizer in ((words, self.of_words), (of_letters, self.tokenizer)):
            groups = [some[i : i + _GROUP] for i in range(0, len(some), _GROUP)]
            texts = [b" ".join(g).decode("utf-8", "replace") for g in groups]
            for group, ids in zip(groups, self._ids(texts, tokenizer)):
                data, stops = ids.tobytes(), ((np.flatnonzero(self.ends_word[ids]) + 1) * self.dtype.itemsize).tolist()
                if len(stops) == len(group):  # else a letter that the vocabulary's library doesn't know as one
                    young.update((c, data[a:b]) for c, a, b in zip(group, [0, *stops], stops))
        alone = [c for c in (*others, *words) if c not in young]
        for c, ids in zip(alone, self._ids([c.decode("utf-8", "replace") for c in alone])):
            young[c] = ids.tobytes()
        for c, word, signs in ended:
            young[c] = young[word] + young[signs]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.young) > _MEMO_CHUNKS:
            self.old, self.young = self.young, {}
        folded = [t.lower() for t in texts]
        # lower-casing must not make a special string of a text
        chunks = [(t if any(s in low for s in self.special) else low).split() for t, low in zip(texts, folded)]
        self._learn(set().union(*chunks))
        get = self.young.__getitem__
        end = np.array([END_ID], self.dtype).tobytes()
        return [b"".join(map(get, c)) + end for c in chunks]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class TokenFiles:
    """A written set: `folder` holds for each shard ids (.bin), ends of documents (.off, 64-bit,
    counted from the shard's start), doc_ids (.doc); `shards` has (shard, n_docs, n_null,
    n_tokens, base), base being the ids of all shards before."""

    folder: str
    dtype: str
    n_shards: int
    shards: DataFrame


SHARD = "shard int, n_docs bigint, n_null bigint, n_tokens bigint, file string"


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= _BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str) -> TokenFiles:
    """Encodes docs (doc_id, text) and writes one shard per range of doc_id, in ascending order.

    Null doc_ids come first, rows of one doc_id in order of their text's hash; a null text is
    empty. A shard is written under a name of its attempt; the table of shards, written when
    all are done, names the attempts that count, so tasks that ran twice or got lost leave
    nothing but unused files. Other columns of docs are ignored.
    """
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], SHARD).schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, context = encoder(vocabulary_path), TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        shard = context.partitionId()
        name = f"{shard:06d}-{context.taskAttemptId()}-{uuid4().hex[:8]}"
        n_docs = n_null = n_tokens = 0
        fs.create_dir(root, recursive=True)
        streams = [fs.open_output_stream(f"{root}/{name}.{kind}") for kind in ("bin", "off", "doc")]
        try:
            for b in batches:
                ids, texts = b.column(0), [x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()]
                n_null += ids.null_count
                streams[2].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for part in _slices(texts):
                    encoded = enc.encode(part)
                    sizes = np.array([len(e) // enc.dtype.itemsize for e in encoded], "<i8")
                    streams[0].write(b"".join(encoded))
                    streams[1].write((n_tokens + np.cumsum(sizes)).astype("<i8").tobytes())
                    n_docs += len(part)
                    n_tokens += int(sizes.sum())
        finally:
            for s in streams:
                s.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((shard, n_docs, n_null, n_tokens, name), schema.types)], schema=schema
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    spark = docs.sparkSession
    rows.mapInArrow(write, SHARD).write.parquet(f"{folder}/shards")
    shards = with_bases(spark.read.schema(SHARD).parquet(f"{folder}/shards").collect())
    return TokenFiles(
        folder, encoder(vocabulary_path).dtype.str, len(shards), spark.createDataFrame(shards, f"{SHARD}, base bigint")
    )


def with_bases(shards: list[Row]) -> list[tuple]:
    """Prefix sums of the shards' ids: one short row per shard (task) on the driver."""
    base, out = 0, []
    for r in sorted(shards):
        out.append((*r, base))
        base += r["n_tokens"]
    return out


DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _ids(fs: pafs.FileSystem, path: str, dtype: np.dtype):
    """The shard's ids: mapped to memory where the file system is a mounted one."""
    if isinstance(fs, pafs.LocalFileSystem):
        mapped = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
        return lambda start, end: mapped[start:end]
    file = fs.open_input_file(path)
    return lambda start, end: np.frombuffer(file.read_at((end - start) * dtype.itemsize, start * dtype.itemsize), dtype)


def read_documents(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    One task per shard walks its documents with a bounded number of ids in memory.
    """
    dtype, folder = np.dtype(files.dtype), files.folder
    names = [x.split()[0] for x in DOCUMENTS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for shards in batches:
            for s in shards.to_pylist():
                ids = _ids(fs, f"{root}/{s['file']}.bin", dtype)
                with fs.open_input_stream(f"{root}/{s['file']}.off") as off, fs.open_input_stream(f"{root}/{s['file']}.doc") as doc:
                    done, before = 0, 0
                    while done < s["n_docs"]:
                        n = min(4096, s["n_docs"] - done)
                        ends = np.frombuffer(off.read(8 * n), "<i8")
                        docs = np.frombuffer(doc.read(8 * n), "<i8").copy()
                        starts = np.concatenate([[before], ends[:-1]])
                        null = np.arange(done, done + n) < s["n_null"]
                        crcs = []
                        for a, b in zip(starts.tolist(), ends.tolist()):
                            crc = 0
                            for at in range(a, b, _READ_IDS):
                                crc = zlib.crc32(ids(at, min(b, at + _READ_IDS)).astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, pa.int64(), mask=null), pa.array(starts + s["base"], pa.int64()),
                             pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())], names=names,
                        )
                        done, before = done + n, int(ends[-1])

    # a number of its own, as shards are tiny rows that would else be read by one task
    shards = files.shards.filter("n_docs > 0").repartition(max(1, files.n_shards), "shard")
    return shards.mapInArrow(read, DOCUMENTS)
