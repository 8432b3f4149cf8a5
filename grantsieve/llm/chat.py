"""Chat formatting: a role machine over turns and a declarative template with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    """What stands before and after a role's texts, and whether they carry loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """roles: marks by role. order: roles that may follow a role ("" is the start of a
    conversation). Other roles are written between the marks of `other`, with their name."""

    roles: dict[str, Marks] = field(default_factory=lambda: {
        "system": Marks("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Marks("<s>[INST] ", " [/INST]"),
        "assistant": Marks(" ", "</s>", loss=True),
    })
    other: Marks = Marks("[ROLE]", "[/ROLE]")
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    controls: tuple[str, ...] = (
        "<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[TEXT]",
    )
    name_end: str = "[TEXT]"
    escape: str = "\\"

    def pattern(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, (self.escape, *self.controls))))


class Writer:
    """Formats one turn after another; nothing but the state of the machine is kept."""

    def __init__(self, template: Template):
        self.t, self.special = template, template.pattern()
        self.state = ""

    def escaped(self, text: str) -> str:
        """An escape sign is doubled; one is put behind the first sign of a control string,
        so no control string is left in the text."""
        e = self.t.escape
        return self.special.sub(lambda m: e + e if m[0] == e else m[0][0] + e + m[0][1:], text)

    def turn(self, role: str, text: str) -> tuple[bool, list[tuple[str, bool]]]:
        """Whether the role may stand here, and the turn's segments (text, loss)."""
        valid = role in self.t.order.get(self.state, ())
        self.state = role
        marks, before = self.t.roles.get(role), ""
        if marks is None:
            marks, before = self.t.other, self.escaped(role) + self.t.name_end
        return valid, [
            (marks.before + before, False), (self.escaped(text), marks.loss), (marks.after, False)
        ]


class Reader:
    """Reads turns back from formatted text, whole turns at a time."""

    def __init__(self, template: Template):
        self.t = template
        e = re.escape(template.escape)
        self.sign = re.compile(f"{e}(.)|" + "|".join(map(re.escape, template.controls)), re.DOTALL)
        self.unescape = re.compile(f"{e}(.)", re.DOTALL)

    def _until(self, formatted: str, at: int, mark: str) -> tuple[str, int]:
        """The unescaped text before the next unescaped control string, and where it stands."""
        for m in self.sign.finditer(formatted, at):
            if m[1] is None:
                if m[0] != mark:
                    raise ValueError(f"{m[0]!r} instead of {mark!r} at {m.start()}")
                return formatted[at:m.start()], m.start()
        raise ValueError(f"no {mark!r} after {at}")

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        at, strip = 0, self.unescape.sub
        while at < len(formatted):
            if formatted.startswith(self.t.other.before, at):
                name, end = self._until(formatted, at + len(self.t.other.before), self.t.name_end)
                role, marks, at = strip(r"\1", name), self.t.other, end + len(self.t.name_end)
            else:
                role, marks = next(
                    (r, m) for r, m in self.t.roles.items() if formatted.startswith(m.before, at)
                )
                at += len(marks.before)
            mark = marks.after.strip()
            raw, end = self._until(formatted, at, mark)
            lead = marks.after[: marks.after.index(mark)]
            text = strip(r"\1", raw[: len(raw) - len(lead)])
            at = end - len(lead) + len(marks.after)
            yield role, text


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order: turn, then role, then text.

    Only the sort holds rows, and it spills; a task streams through its conversations, so one
    with a third of all rows needs no more memory than others.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


SEGMENTS = "conv_id bigint, turn bigint, position bigint, valid boolean, segments array<struct<text:string,loss:boolean>>"


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: conv_id, turn, position in its conversation, valid, segments.

    turns has conv_id, turn, role and text; other columns are ignored. The formatted
    conversation is all segment texts by position, its loss mask their flags. A turn is valid
    where its role may follow the one before; invalid turns are written all the same. Null
    roles and texts count as empty; rows with a null conv_id are one conversation; null turns
    come first; repeated rows are turns of their own, in order of role and text.
    """
    segment = pa.struct([("text", pa.string()), ("loss", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, writer, position = object(), None, 0
        for b in batches:
            out: list[tuple] = []
            for conv, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if conv != current or writer is None:
                    current, writer, position = conv, Writer(template), 0
                valid, parts = writer.turn(role, text)
                out.append((conv, turn, position, valid, [{"text": t, "loss": f} for t, f in parts]))
                position += 1
            c = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                 pa.array(c[3], pa.bool_()), pa.array(c[4], pa.list_(segment))],
                names=["conv_id", "turn", "position", "valid", "segments"],
            )

    rows = turns.withColumns({c: F.col(c).cast("bigint") for c in ("conv_id", "turn")})
    return _ordered(rows).mapInArrow(run, SEGMENTS)


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_invalid bigint"
)


def digest(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation: what reading its formatted text back gives.

    Runs on the rows of format_turns as they come, without another shuffle: hashes take
    turn after turn, so no conversation is gathered. Rows in any other order, as after a write
    and read of that table, are refused. Turns are parsed from the formatted text, the loss text
    is that of the segments whose flag is set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, state = Reader(template), None

        def done() -> tuple:
            return (state["id"], state["n"], state["all"].hexdigest(), state["loss_n"], state["loss"].hexdigest(), state["chars"], state["bad"])

        for b in batches:
            out = []
            for conv, position, valid, segments in zip(*(b.column(n).to_pylist() for n in ("conv_id", "position", "valid", "segments"))):
                if position == 0:
                    if state is not None:
                        out.append(done())
                    state = {"id": conv, "rows": 0, "n": 0, "all": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0, "bad": 0}
                if state is None or state["id"] != conv or state["rows"] != position:
                    raise ValueError(f"turn {position} of conversation {conv} is out of order")
                state["rows"] += 1
                formatted = "".join(s["text"] for s in segments)
                state["chars"] += len(formatted)
                state["bad"] += not valid
                for role, text in reader.turns(formatted):
                    state["n"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        text = reader.unescape.sub(r"\1", s["text"])
                        state["loss_n"] += len(text)
                        state["loss"].update(text.encode())
            yield _digest_batch(out)
        if state is not None:
            yield _digest_batch([done()])

    return formatted.mapInArrow(run, DIGEST)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in DIGEST.split(", ")]
    types = [pa.string() if "sha256" in n else pa.int64() for n in names]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
