"""Language of a text: words first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """sample_docs: expected number of labelled documents per language that the model is
    fitted on (all, if there are fewer). It bounds the model's size: the model keeps every
    word and n-gram of the sample."""

    sample_docs: int = 3000
    longest: int = 5
    smoothing: float = 0.5
    memo: int = 200_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; other signs that count as word characters are left out."""
    return [
        x for w in _WORD.findall(text.lower())
        for x in ((w,) if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())
    ]


def grams_of(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def count_units(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """(lang, n, unit, count) of each batch of (lang, text); n = 0 for words."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text or ""))
        for lang, counts in words.items():
            for n in range(longest + 1):
                units: Counter = counts
                if n:
                    units = Counter()
                    for w, c in counts.items():
                        for g in grams_of(w, n):
                            units[g] += c
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(units), pa.string()), pa.array([n] * len(units), pa.int32()),
                     pa.array(units.keys(), pa.string()), pa.array(units.values(), pa.int64())],
                    names=["lang", "n", "unit", "count"],
                )


class Model:
    """Log frequencies of known units by language, and totals of a text's words."""

    def __init__(self, langs: list[str], tables: list[tuple[dict[str, int], np.ndarray]], memo: int):
        self.langs, self.tables, self.memo = langs, tables, memo

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("langs", "tables", "memo")}

    def _backoff(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest n-grams of which any is known; else nothing."""
        for n in range(len(self.tables) - 1, 0, -1):
            index, logs = self.tables[n]
            if known := [index[g] for g in grams_of(word, n) if g in index]:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.langs))

    def _reset(self) -> None:
        index, logs = self.tables[0]
        self.rows = dict(index)
        self.matrix = np.zeros((len(logs) + self.memo, len(self.langs)))
        self.matrix[: len(logs)] = logs

    def _row(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            row = self.rows[word] = len(self.rows)
            self.matrix[row] = self._backoff(word)
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """Most likely language and its posterior; ties go to the first in alphabetical order."""
        counts = Counter(words_of(text or ""))
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        if not hasattr(self, "rows"):
            self._reset()
        total, words = np.zeros(len(self.langs)), list(counts)
        for at in range(0, len(words), self.memo):  # a text may have more words than the memo
            part = words[at : at + self.memo]
            if len(self.rows) + len(part) > len(self.matrix):
                self._reset()
            total += np.array([counts[w] for w in part], float) @ self.matrix[[self._row(w) for w in part]]
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Model of rows (doc_id, lang, text) with a non-null lang.

    Documents are taken by hash of id at a rate of sample_docs to their language's number of
    documents, so the sample and the model stay of one size while the corpus grows; counting
    is a Spark job, and the sample's distinct units reach the driver as Arrow columns.
    """
    labelled = labelled.filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    langs, tables = sorted(sizes), []
    if not langs:
        return Model([], [], settings.memo)
    rates = F.create_map(*[F.lit(x) for lang in langs for x in (lang, settings.sample_docs / sizes[lang])])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.element_at(rates, F.col("lang"))
    counted = (
        labelled.filter(drawn).select("lang", "text")
        .mapInArrow(lambda it: count_units(it, settings.longest), "lang string, n int, unit string, count bigint")
        .groupBy("n", "unit").agg(
            *[F.sum(F.when(F.col("lang") == x, F.col("count"))).alias(f"c{i}") for i, x in enumerate(langs)],
        )
    )
    from .tables import written

    counted = written(counted, "units")
    for n in range(settings.longest + 1):
        units = counted.filter(F.col("n") == n).drop("n").orderBy("unit").toArrow()
        counts = np.column_stack([units[f"c{i}"].fill_null(0).to_numpy() for i in range(len(langs))])
        smooth = counts + settings.smoothing
        tables.append(({u: i for i, u in enumerate(units["unit"].to_pylist())}, np.log(smooth / smooth.sum(axis=0))))
    return Model(langs, tables, settings.memo)


def predict(text: Column, model: Model) -> Column:
    """Struct (lang, score) of a text column: `und` and 0 for null and texts without a letter,
    and for every text if nothing was learned."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        found = [model.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang", "score"],
        )

    return predicted(text)
