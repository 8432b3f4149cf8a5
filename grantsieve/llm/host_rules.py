"""Quality rules by host: failures of a host's documents, shrunk rates, verdicts joined back."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Verdicts:
    """A host is rejected when its shrunk failure rate of some rule is above max_rate.

    max_line_percent: repeated lines for each 100 words; max_symbol_percent: symbols for each 100 words.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    max_line_percent: int = 3
    max_symbol_percent: int = 10
    max_rate: float = 0.5
    salts: int = 64


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more.

    A window of 2n words is a pair of windows of n words: doubling numbers from pairs needs
    no hashing of windows and three sorts for a window of eight.
    """
    n = len(words)
    if n < window + 1:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    width = 1
    while width < window:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    edges[: len(twice)] += twice
    edges[window : window + len(twice)] -= twice
    return int((np.cumsum(edges[:n]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if not (x == b"" or x.isspace())]
    return len(lines) - len(set(lines))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rule_measures(text: Column) -> Column:
    """Struct of five counts of a text column; null counts as an empty text."""

    @F.arrow_udf(f"struct<{','.join(f'{m}:bigint' for m in MEASURES)}>")
    def measures(texts: pa.Array) -> pa.Array:
        rows = []
        sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
        for size, t in zip(sizes, texts.cast(pa.binary()).to_pylist()):
            t = t or b""
            words = t.split()
            rows.append((
                len(words),
                size - sum(t.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")),
                sum(t.count(bytes((c,))) for c in SYMBOLS),
                duplicate_lines(t),
                repeated_words(words),
            ))
        columns = list(zip(*rows)) or [()] * len(MEASURES)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))

    return measures(text)


def base_failed(v: Verdicts = Verdicts()) -> Column:
    return (F.col("n_words") < v.min_words) | (
        100 * F.col("n_repeat_words") > v.max_repeat_percent * F.col("n_words")
    )


def failures(v: Verdicts = Verdicts()) -> dict[str, Column]:
    """What a document fails, by rule. Word length is none: it depends on the script."""
    return {
        "base": base_failed(v),
        "lines": 100 * F.col("n_dup_lines") > v.max_line_percent * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > v.max_symbol_percent * F.col("n_words"),
    }


def beta_priors(hosts: DataFrame, rules: list[str]) -> dict[str, tuple[float, float]]:
    """Beta prior of each rule's failure rates by moments over hosts of at least two documents.

    Only one row of a few sums per rule reaches the driver. Without spread beyond that of the draws
    the prior is as strong as all documents together; without such hosts it is (1, 1).
    """
    rates = {r: F.col(r) / F.col("n") for r in rules}
    s = hosts.filter("n >= 2").agg(
        F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(1 / F.col("n")).alias("inv"),
        *[F.sum(r).alias(f"{r}_failed") for r in rules],
        *[F.sum(x).alias(f"{r}_rate") for r, x in rates.items()],
        *[F.sum(x * x).alias(f"{r}_squares") for r, x in rates.items()],
    ).first()
    return {r: _prior(s, r) if s["hosts"] else (1.0, 1.0) for r in rules}


def _prior(s, rule: str) -> tuple[float, float]:
    # kept inside (0, 1) by half a document
    mean = (s[f"{rule}_failed"] + 0.5) / (s["n"] + 1.0)
    spread = max(s[f"{rule}_squares"] / s["hosts"] - (s[f"{rule}_rate"] / s["hosts"]) ** 2, 0.0)
    inverse = s["inv"] / s["hosts"]
    between = (spread - mean * (1 - mean) * inverse) / max(1 - inverse, 1e-9)
    strength = mean * (1 - mean) / between - 1 if between > 0 else float(s["n"])
    strength = min(max(strength, 1.0), float(s["n"]))
    return mean * strength, (1 - mean) * strength


def host_verdicts(measured: DataFrame, host: str, v: Verdicts = Verdicts()) -> DataFrame:
    """Per host: n, failures and shrunk rate (rate_<rule>) of each rule, and host_kept, false if a rate
    is above max_rate. Rows without a host have no verdict.

    Counting combines before the shuffle, so a host with a third of all rows sends one row
    per partition.
    """
    rules = failures(v)
    hosts = measured.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in rules.items()]
    )
    hosts = written(hosts, "hosts")
    rates = {
        f"rate_{r}": (F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b))
        for r, (a, b) in beta_priors(hosts, list(rules)).items()
    }
    return hosts.withColumns(rates).withColumn("host_kept", F.greatest(*rates) <= v.max_rate)


def apply_host_rules(docs: DataFrame, host: str = "source", v: Verdicts = Verdicts()) -> DataFrame:
    """Per row: doc_id, five counts, base_failed and kept.

    kept is false for a document that fails the base rules, else its host's verdict over all rules,
    else (null host) true. A document that fails by lines or symbols alone stays if its host does. Null and empty texts have no words and so fail. Null ids and repeated
    rows stay rows of their own. Other columns of docs are ignored, whatever their names.
    The join back is salted, so the documents of one host spread over many tasks.
    """
    measured = docs.select(
        F.col("doc_id"), F.col(host).alias("host"), rule_measures(F.col("text")).alias("m")
    ).select("doc_id", "host", "m.*")
    measured = written(measured.withColumn("base_failed", base_failed(v)), "measured")
    verdicts = host_verdicts(measured, "host", v).filter(~F.col("host_kept")).select(
        "host", F.explode(F.sequence(F.lit(0), F.lit(v.salts - 1))).alias("salt"), F.lit(True).alias("bad_host")
    )
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(v.salts)).cast("int"))
    return salted.join(verdicts, ["host", "salt"], "left").select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.col("bad_host").isNull()).alias("kept")
    )
