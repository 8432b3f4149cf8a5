"""Mixing sources to target weights: raked token weights, then calibrated sampling."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import salted_join, written

OTHER = "other"


@dataclass(frozen=True)
class Targets:
    """Shares of tokens by dimension. The share of `other` is divided over all values not
    listed, null being one of them, by their tokens to the power of tempering: 1 leaves them as
    they are, 0 makes them equal. budget: share of all tokens to draw. Shares of values without tokens go to the rest of
    their dimension. tolerance: largest difference of a share at which raking ends."""

    shares: dict[str, dict[str, float]] = field(default_factory=lambda: {
        "source": {"src0": 0.25, OTHER: 0.75},
        "lang": {"en": 0.55, "fr": 0.16, "de": 0.16, "es": 0.11, OTHER: 0.02},
        "topic": {"table": 0.05, "notice": 0.05, "numeric": 0.1, OTHER: 0.8},
    })
    budget: float = 0.8
    tempering: float = 0.5
    seed: int = 20240607
    tolerance: float = 1e-6
    rounds: int = 500


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """A topic by plain signs of the text: table bars, licence words, digits; else `other`."""
    return (
        F.when(text.contains(" | "), F.lit("table"))
        .when(F.lower(text).rlike(r"licen[cs]e|copyright|all rights reserved"), F.lit("notice"))
        .when(text.rlike(r"[0-9]{3}"), F.lit("numeric"))
        .otherwise(F.lit(OTHER))
    )


def rake_cells(
    tokens: np.ndarray, at: list[np.ndarray], margins: list[np.ndarray], budget: float, tolerance: float, rounds: int
) -> np.ndarray:
    """Tokens to draw of each cell: proportional to the cells' tokens times a factor for each
    value of each dimension, with the margins' shares, at most all tokens of a cell. at: for
    each dimension the cells' places in its margin; only cells that occur are listed.

    Iterative proportional fitting; cells that would need more than they have are held at all
    they have, and the others are raked to what the margins have left.
    """
    total = tokens.sum()
    held = np.zeros(tokens.shape, bool)
    draw = tokens * budget
    for _ in range(tokens.size + 1):
        for _ in range(rounds):
            worst = 0.0
            for place, margin in zip(at, margins):
                want = margin * budget * total - np.bincount(place, np.where(held, draw, 0), len(margin))
                have = np.bincount(place, np.where(held, 0, draw), len(margin))
                factor = np.divide(np.maximum(want, 0), have, out=np.ones_like(have), where=have > 0)
                worst = max(worst, float(np.abs(have * factor - have).max()) / max(total * budget, 1e-300))
                draw = np.where(held, draw, draw * factor[place])
            if worst < tolerance:
                break
        over = (draw > tokens * (1 + 1e-9)) & ~held
        if not over.any():
            break
        held |= over
        draw = np.where(over, tokens, draw)
    return np.minimum(draw, tokens)


def rake(tokens: np.ndarray, margins: list[np.ndarray], budget: float, tolerance: float, rounds: int) -> np.ndarray:
    """rake_cells of a full table, one axis for each dimension."""
    at = [a.reshape(-1) for a in np.indices(tokens.shape)]
    return rake_cells(tokens.reshape(-1), at, margins, budget, tolerance, rounds).reshape(tokens.shape)


def _keys(targets: Targets, columns: dict[str, Column]) -> dict[str, Column]:
    return {f"_d{i}": F.coalesce(columns[d].cast("string"), F.lit(OTHER)) for i, d in enumerate(targets.shares)}


def _margin(names: list[str], tokens: np.ndarray, listed: dict[str, float], tempering: float) -> np.ndarray:
    """Target shares of a dimension's values: those listed, and the share of `other` divided
    over all that are not listed."""
    named = np.array([v in listed and v != OTHER for v in names], bool)
    tempered = np.where(named, 0.0, tokens**tempering)  # of values without tokens: 0
    share = np.where(named & (tokens > 0), [listed.get(v, 0.0) for v in names], 0.0)
    if tempered.sum() > 0:
        share += listed.get(OTHER, 0.0) * tempered / tempered.sum()
    if share.sum() > 0:
        return share / share.sum()
    return tempered / tempered.sum()  # nothing that has a target is there


def probabilities(docs: DataFrame, targets: Targets, columns: dict[str, Column], tokens: Column) -> DataFrame | None:
    """(_d0, _d1, .., _p): probability of a document by cell, a combination of values that
    occurs; None without tokens. Counting the cells is one aggregation with partial sums."""
    keys = _keys(targets, columns)
    counted = docs.select(*[c.alias(k) for k, c in keys.items()], tokens.alias("_n")).groupBy(*keys).agg(
        F.sum("_n").cast("double").alias("_n")
    )
    cells = counted.filter("_n > 0").toArrow().sort_by([(k, "ascending") for k in keys])
    if not cells.num_rows:
        return None
    n, at, margins = cells["_n"].to_numpy(), [], []
    for k, listed in zip(keys, targets.shares.values()):
        coded = cells[k].combine_chunks().dictionary_encode()
        place = coded.indices.to_numpy()
        at.append(place)
        names = coded.dictionary.to_pylist()
        margins.append(_margin(names, np.bincount(place, n, len(names)), listed, targets.tempering))
    draw = rake_cells(n, at, margins, targets.budget, targets.tolerance, targets.rounds)
    found = pa.table({**{k: cells[k] for k in keys}, "_p": pa.array(draw / n)})
    return written(docs.sparkSession.createDataFrame(found), "cells")


def mix(
    docs: DataFrame, targets: Targets = Targets(), columns: dict[str, Column] | None = None,
    tokens: Column | None = None, key: Column | None = None,
) -> DataFrame:
    """Rows of docs, with all their columns, drawn by their cell's calibrated probability.

    A draw depends on seed and doc_id alone, so runs agree and repeated rows stay or go
    together; rows without a doc_id draw by their text (key: another identity to draw by). Documents without tokens (null and empty
    texts) weigh nothing: they are drawn at the rate of the budget unless their cell has
    tokens. Null counts as the value `other` of a dimension.
    """
    return calibrated(docs, targets, columns, tokens, key).filter("drawn < p").select("doc.*")


def calibrated(
    docs: DataFrame, targets: Targets = Targets(), columns: dict[str, Column] | None = None,
    tokens: Column | None = None, key: Column | None = None,
) -> DataFrame:
    """(doc, p, drawn): each row as a struct, its probability, and its draw in [0, 1). The
    probabilities are joined, the rows of a cell salted by their draw."""
    columns = columns or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}
    tokens = n_words(F.col("text")) if tokens is None else tokens
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text")) if key is None else key
    by_cell = probabilities(docs, targets, columns, tokens)
    keys = _keys(targets, columns)
    unit = F.pmod(F.xxhash64(F.lit(targets.seed), key), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rows = docs.select(F.struct("*").alias("doc"), unit.alias("drawn"), *[c.alias(k) for k, c in keys.items()])
    p = F.lit(targets.budget)
    if by_cell is not None:
        rows = salted_join(rows, by_cell, list(keys), "drawn", how="left")
        p = F.coalesce("_p", p)
    return rows.select("doc", p.alias("p"), "drawn")
