"""Rule tagging with the rules in a table, for rules by the thousand.

``topic_tags`` states every rule as a literal of the plan, which suits tens of rules. Here rules
are rows of an inverted index by the first signs of their literal start. Texts are cut at word
starts, the cuts meet the rules by join, and only rules whose whole literal start stands there
run their pattern, on the cut. The plan is the same for every number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import ANY_CASE, WORD_END, WORD_START, portable
from ..functions.tagging import Rules, literal_start
from ..functions.text import fold_case

BROADCAST_SIGNS = 16_000_000  # an index of up to so many signs goes to all executors
KEY_LENGTHS = (8, 4, 2, 1)  # a rule's key is as long a start of it as one of these allows
INDEX = "category string, label string, place bigint, head string, body string"


@dataclass(frozen=True)
class RuleIndex:
    """Rules as rows ``category, label, place, head, body``, the most signs one can match, and
    how many signs the rows hold.

    ``head`` is the lower-case literal start, ``body`` the pattern from there on, ``place`` the
    order in which a category's labels are listed.
    """

    rows: DataFrame
    reach: int
    signs: int


def rule_index(spark: SparkSession, rules: Rules) -> RuleIndex:
    """Index of rules given as ``topic_tags`` takes them.

    Every pattern needs a literal start behind ``\\b`` and parts of bounded length; others
    have to stay with ``topic_tags`` and are refused.
    """
    rows, reach = [], 1
    for category, labels in rules.items():
        for place, (label, patterns) in enumerate(labels.items()):
            for p in patterns:
                head = literal_start(p)
                if not head:
                    raise ValueError(f"the rule {p!r} of {label!r} has no literal start behind \\b")
                rows.append((category, label, place, head, portable(p.removeprefix(r"\b"))))
                reach = max(reach, len(p) + 1)
    signs = sum(len(c) + len(x) + len(h) + len(b) for c, x, _, h, b in rows)
    return RuleIndex(spark.createDataFrame(rows, INDEX), reach, signs)


def phrase_index(phrases: DataFrame) -> RuleIndex:
    """Index of whole-word phrases in a table ``category, label, place, phrase``.

    A phrase counts where it stands between word bounds, in any case; it has to start with a
    letter a-z or a digit, others are left out. One narrow job looks up the longest phrase and the
    size of the table.
    """
    usable = phrases.filter(F.col("phrase").rlike("^[A-Za-z0-9]"))
    quoted = F.concat(F.lit(r"\Q"), F.replace("phrase", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    ends_in_word = F.col("phrase").rlike(r"[\p{L}\p{N}]$")
    rows = usable.select(
        "category", "label", F.col("place").cast("bigint").alias("place"), fold_case(F.col("phrase")).alias("head"),
        F.concat(quoted, F.when(ends_in_word, F.lit(WORD_END)).otherwise(F.lit(""))).alias("body"),
    )
    signs = F.sum(F.char_length(F.concat_ws("", "category", "label", "head", "body")))
    longest, total = rows.agg(F.max(F.char_length("head")), signs).first()
    return RuleIndex(rows, (longest or 0) + 1, total or 0)


def _key(head: Column) -> Column:
    longest = F.lit(KEY_LENGTHS[-1])
    for n in reversed(KEY_LENGTHS[:-1]):
        longest = F.when(F.char_length(head) >= n, F.lit(n)).otherwise(longest)
    return F.substring(head, F.lit(1), longest)


def rule_hits(
    texts: DataFrame, index: RuleIndex, key: Sequence[str], text: str = "text", salts: int = 8
) -> DataFrame:
    """Satisfied rules as distinct rows ``key, category, label, place``.

    ``key`` names the columns that identify a text; rows of one key count as one text. Null
    texts have no hits. An index of at most ``BROADCAST_SIGNS`` signs is broadcast and nothing
    of a text is moved before the last step; beyond it, cuts meet rules by hash of key and salt,
    so the cuts of a frequent word are spread over ``salts`` tasks.
    """
    small = index.signs <= BROADCAST_SIGNS
    parts = 1 if small else salts
    start = f"(?s){WORD_START}(?=[a-z0-9])(?=(.{{1,{index.reach}}}))"
    cuts = texts.select(
        *[F.col(c) for c in key],
        F.explode(F.array_distinct(F.regexp_extract_all(fold_case(F.col(text)), F.lit(start), F.lit(1)))).alias("_cut"),
    )
    keyed = cuts.select(
        "*",
        F.explode(F.array_distinct(F.array(*[F.substring("_cut", 1, n) for n in KEY_LENGTHS]))).alias("_key"),
        F.pmod(F.xxhash64("_cut"), F.lit(parts)).alias("_salt"),
    )
    rules = index.rows.select(
        "category", "label", "place", "head", F.concat(F.lit(f"{ANY_CASE}^(?:"), "body", F.lit(")")).alias("_body"),
        _key(F.col("head")).alias("_key"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("_salt"),
    )
    met = keyed.join(F.broadcast(rules) if small else rules.hint("merge"), ["_key", "_salt"]).filter(F.startswith("_cut", "head"))
    return met.filter(F.expr("_cut RLIKE _body")).select(*key, "category", "label", "place").distinct()


def labels_by_category(hits: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key, category, labels``: the labels of a text, in declared order, one row per category hit.

    A list holds at most the labels of one category, whatever the number of texts.
    """
    labels = F.sort_array(F.collect_set(F.struct("place", "label")))
    return hits.groupBy(*key, "category").agg(F.transform(labels, lambda x: x["label"]).alias("labels"))
