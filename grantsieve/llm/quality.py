"""Quality of a text: regularised quadratic discriminant over transformed statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import utf8

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>"

STATISTICS = (
    "words", "word_length", "symbols", "upper", "digits", "exclaims", "stops", "commas",
    "lines", "repeated_lines", "repeated_pairs", "distinct", "short_words", "odd_ends", "bars", "other_signs",
)


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one text: shares on a log scale, sizes as logarithms."""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:]))
    letters = max(_count(text, LETTERS), 1)

    def share(count: float, of: float) -> float:
        return float(np.log(count / of + 0.02))

    return [
        float(np.log1p(len(words))),
        float(np.log(letters / n + 1)),
        share(_count(text, SYMBOLS), n),
        share(_count(text, UPPER), letters),
        share(_count(text, DIGITS), size),
        share(text.count(b"!"), n),
        share(text.count(b"."), n),
        share(text.count(b","), n),
        share(len(lines), n),
        share(len(lines) - len(set(lines)), max(len(lines), 1)),
        share(len(pairs) - len(set(pairs)), max(len(pairs), 1)),
        float(np.log((len(set(words)) + 1) / n**0.8 + 0.02)),
        share(sum(len(w) <= 3 for w in words), n),
        share(sum(not w[-1:].isalnum() and w[-1] < 128 for w in words), n),
        share(words.count(b"|"), n),
        share(size - letters - _count(text, DIGITS) - _count(text, b" \n\t.,!" + SYMBOLS), size),
    ]


def text_statistics(text: Column) -> Column:
    """array<double> of a text column; null counts as an empty text."""

    @F.arrow_udf("array<double>")
    def computed(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in utf8(texts)], pa.list_(pa.float64()))

    return computed(text)


@dataclass(frozen=True)
class Shrinkage:
    """Class covariances are drawn towards the pooled one by `pooled`, then towards their
    diagonal by `diagonal`; `ridge` is added to each variance."""

    pooled: float = 0.3
    diagonal: float = 0.1
    ridge: float = 0.02
    temper: float = 0.5


class Discriminant:
    """Class means, Cholesky factors of their covariances, and log priors. classes: (0, 1)."""

    def __init__(self, counts: np.ndarray, means: np.ndarray, covariances: np.ndarray, s: Shrinkage):
        total = counts.sum()
        self.constant = 0.5 if total == 0 else None if counts.min() > 0 else float(counts[1] > 0)
        if self.constant is not None:
            return
        pooled = (covariances * counts[:, None, None]).sum(axis=0) / total
        self.means, self.factors, self.log_det, self.temper = means, [], [], s.temper
        self.log_prior = np.log(counts / total)
        for cov in covariances:
            cov = (1 - s.pooled) * cov + s.pooled * pooled
            cov = (1 - s.diagonal) * cov + s.diagonal * np.diag(np.diag(cov))
            factor = np.linalg.cholesky(cov + s.ridge * np.eye(len(cov)))
            self.log_det.append(2 * np.log(np.diag(factor)).sum())
            self.factors.append(np.linalg.inv(factor))  # whitening, computed once

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 from the difference of Mahalanobis log densities."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [
            -0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d
            for m, f, d in zip(self.means, self.factors, self.log_det)
        ]
        margin = self.temper * (density[1] - density[0]) + self.log_prior[1] - self.log_prior[0]
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit(rows: DataFrame, s: Shrinkage = Shrinkage()) -> Discriminant:
    """Discriminant of rows (x array<double>, y 0 or 1); rows with a null y are left out.

    Sums and cross products are one Spark aggregation over all rows; two rows of fixed width
    reach the driver. With one class only its label is the score, without rows 0.5 is.
    """
    d = len(STATISTICS)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.filter("y in (0, 1)").groupBy("y").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("s"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in upper]).alias("c"),
    ).collect()
    counts, means, covs = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums:
        n, mean = r["n"], np.array(r["s"]) / r["n"]
        cov = np.zeros((d, d))
        for (i, j), v in zip(upper, r["c"]):
            cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
        counts[r["y"]], means[r["y"]], covs[r["y"]] = n, mean, cov
    return Discriminant(counts, means, covs, s)


def score(x: Column, model: Discriminant) -> Column:
    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        if not len(rows):
            return pa.array([], pa.float64())
        values = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        return pa.array(model.scores(values), pa.float64())

    return scored(x)
