"""Personal data: patterns propose, checksums confirm, context words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS

SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The loops are possessive and start at the first digit of a run, so long runs cost linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}(?:[\x20.-]?[0-9]{2,4}){1,2}(?![0-9A-Za-z-]|\.[0-9])"
)

# Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28,
    "PT": 25, "SE": 24,
}


@dataclass(frozen=True)
class Weights:
    """Score of a proposal, what a passed checksum and a context word add, and the threshold
    of the added kinds. Base kinds stay whatever their score."""

    proposed: float = 0.3
    confirmed: float = 0.4
    context: float = 0.3
    threshold: float = 0.6
    window: int = 40


def _context(*words: str) -> re.Pattern:
    return re.compile(r"(?<!\w)(?:" + "|".join(words) + r")(?!\w)", re.IGNORECASE)


CONTEXT = {
    "email": _context("e-?mail", "mail", "contact", "write to", "courriel", "correo"),
    "ip": _context("ip", "address", "host", "server", "adresse", "dirección"),
    "card": _context("card", "credit", "visa", "mastercard", "amex", "carte", "karte", "tarjeta"),
    "phone": _context("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": _context("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national_id": _context("ssn", "social security", "national id", "tax id"),
    "local_phone": _context("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35, remainder one."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @ in turn, so that a long run without @ isn't searched again and again."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        size, end = IBAN_LENGTHS.get(m[0][:2]), m.end()
        if size:
            ends = [i for i, c in enumerate(m[0], 1) if c != " "]
            if len(ends) < size:
                continue
            end = m.start() + ends[size - 1]
        if mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield m.span()


#: Proposals of each kind; those of kinds with a checksum have passed it.
PROPOSALS = {
    "email": emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
    "national_id": lambda text: (m.span() for m in _NATIONAL.finditer(text)),
    "local_phone": _local_phones,
}
CHECKED = frozenset(("ip", "card", "iban"))


def find_spans(text: str | None, weights: Weights = Weights()) -> list[dict]:
    """Spans by start, then kind as listed; starts and ends in code points, end exclusive.

    Base kinds follow their patterns and checks alone. Added kinds need the threshold and
    yield to any base span they overlap. Null and empty texts have no spans.
    """
    if not text or not (re.search("[0-9]", text) or "@" in text):
        return []
    found: list[tuple[int, int, int, float]] = []
    for k, kind in enumerate(KINDS):
        base = [f for f in found if f[1] < len(BASE_KINDS)] if kind in ADDED_KINDS else ()
        for start, end in PROPOSALS[kind](text):
            score = weights.proposed + weights.confirmed * (kind in CHECKED)
            near = text[max(0, start - weights.window):start], text[end:end + weights.window]
            if any(CONTEXT[kind].search(x) for x in near):
                score += weights.context
            if kind in BASE_KINDS or (
                score >= weights.threshold and not any(s < end and start < e for s, _, e, _ in base)
            ):
                found.append((start, k, end, min(score, 1.0)))
    return [
        {"kind": KINDS[k], "start": s, "end": e, "score": c} for s, k, e, c in sorted(found)
    ]


def pii_spans(text: Column, weights: Weights = Weights()) -> Column:
    """Column array<struct<kind, start, end, score>> of a text column; null gives an empty one.

    Each row is handled on its own: ties, repeated rows, empty tables and other columns of
    the table, of whatever name, make no difference.
    """

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([find_spans(t, weights) for t in texts.to_pylist()], pa.list_(SPAN))

    return spans(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        piece = F.concat(
            acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
            F.lit("["), s["kind"], F.lit("]"),
        )
        return F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(piece.alias("out"), s["end"].alias("at"))
        )

    return F.aggregate(
        spans, state, step,
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, hash of the base spans, all spans as one string."""
    found = docs.select("doc_id", pii_spans(F.col("text")).alias("s"))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(*kinds: str) -> Column:
        return F.filter("s", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE_KINDS)
    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans")
    )
