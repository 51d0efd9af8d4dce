"""Chat formatting: a state machine over roles, and a declarative template for the text of a turn.

A template lists the states of a dialogue and which roles may come next in each, and the segments
that a turn is made of, each with a flag that says whether a model learns from it. Formatting reads
turns in order, moves through the states, and emits the segments; reading back needs the text of the
segments alone and gives the turns again. Strings that control the format are escaped inside
roles and texts, so no turn can begin or end another one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLE, TEXT = "{role}", "{text}"


@dataclass(frozen=True)
class Template:
    """How turns look, which roles may follow which, and what counts for the loss.

    ``before`` and ``after`` enclose the text of a turn; ``before`` names the role. ``learned`` are the
    roles whose texts count for the loss. ``next_roles`` gives for each state the roles that may come:
    ``START`` is the state before any turn, and a turn leads to the state of its role. A role that may
    not come makes its turn invalid and still leads to its state, so that later turns are judged anew;
    a role that is no state leads to ``OTHER``, after which any role may come.

    Control strings begin with ``opener`` + ``closer`` (here ``<`` and ``|``). Inside a text those two are
    kept apart by one backslash more than the text has between them, so the escape can be taken back.
    """

    before: str = f"<|im_start|>{ROLE}\n"
    after: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    next_roles: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)})
    final: tuple[str, ...] = ("assistant",)
    opener: str = "<"
    closer: str = "|"

    def __post_init__(self):
        start, _, end = self.before.partition(ROLE)
        for mark in (start, self.after):
            if not mark.startswith(self.opener + self.closer):
                raise ValueError(f"{mark!r} does not begin with {self.opener + self.closer!r}")
        if self.opener == self.closer or len(self.opener + self.closer) != 2:
            raise ValueError("opener and closer are two different characters")
        if not end.startswith("\n") or self.after.startswith(start) or start.startswith(self.after):
            raise ValueError("the role ends in a line break, and a turn's beginning and end differ")

    def escape(self, text: str) -> str:
        return re.sub(rf"{re.escape(self.opener)}(\\*){re.escape(self.closer)}", lambda m: f"{self.opener}{m[1]}\\{self.closer}", text)

    def unescape(self, text: str) -> str:
        return re.sub(rf"{re.escape(self.opener)}(\\*)\\{re.escape(self.closer)}", lambda m: f"{self.opener}{m[1]}{self.closer}", text)

    def escape_role(self, role: str) -> str:
        """A role is one line, so its line breaks and backslashes are written as escapes too."""
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def unescape_role(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The texts that a turn is made of, each with its loss flag; the text of the turn is one of them."""
        return [(self.before.replace(ROLE, self.escape_role(role)), False), (self.escape(text), role in self.learned), (self.after, False)]


START, OTHER = "<start>", "<other>"
CHAT = Template()

SEGMENTS = "array<struct<text: string, loss: boolean>>"
TURNS = f"conv_id long, position long, role string, valid boolean, state string, segments {SEGMENTS}"


class Machine:
    """The state of one dialogue."""

    def __init__(self, template: Template):
        self.template, self.state = template, START

    def step(self, role: str) -> bool:
        """Move on by a role; whether it may come here."""
        allowed = self.template.next_roles
        valid = self.state == OTHER or role in allowed[self.state]
        self.state = role if role in allowed and role != START else OTHER
        return valid


def format_turns(turns: DataFrame, template: Template = CHAT, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, in order within a partition: ``conv_id, position, role, valid, state, segments``.

    The conversation's text is its segments in order of ``position`` (from 0). ``valid`` says whether the
    role may come in the state before, ``state`` is the state after. No turn is dropped. Turns are ordered
    by ``turn``, nulls first, and where that is equal by role and text; repeated rows are turns of their own.
    Null texts and roles are empty; a null id is an id of its own. Other columns are ignored, an empty
    table gives no rows.

    Turns stream through a task in order, one batch at a time, so a conversation of any length needs the
    memory of a batch; the order of its turns is what its machine is about, so one task reads it.
    """
    named = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, machine, position = object(), Machine(template), 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3)]):
                if conv != current:
                    current, machine, position = conv, Machine(template), 0
                valid = machine.step(role)
                parts = [{"text": t, "loss": loss} for t, loss in template.segments(role, text)]
                rows.append((conv, position, role, valid, machine.state, parts))
                position += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], names=_NAMES)

    ordered = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(emit, TURNS)


_NAMES = ["conv_id", "position", "role", "valid", "state", "segments"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))]


class Reader:
    """Turns out of formatted text that comes in pieces; it holds the turn that is not ended yet."""

    def __init__(self, template: Template):
        self.template, self.rest = template, ""
        self.start, _, self.end = template.before.partition(ROLE)

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.rest += text
        # A turn can only end where the mark of an end has come in.
        while (at := self.rest.find(self.template.after)) >= 0:
            turn, self.rest = self.rest[:at], self.rest[at + len(self.template.after):]
            role, mark, said = turn.removeprefix(self.start).partition(self.end)
            if not turn.startswith(self.start) or not mark:
                raise ValueError(f"no turn: {turn[:80]!r}")
            yield self.template.unescape_role(role), self.template.unescape(said)

    def close(self) -> None:
        if self.rest:
            raise ValueError(f"a turn without an end: {self.rest[:80]!r}")


class _Digest:
    """What a conversation says, read back from its segments."""

    def __init__(self, template: Template):
        self.reader, self.template = Reader(template), template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.invalid = 0
        self.state = START

    def add(self, valid: bool, state: str, segments: list[dict]) -> None:
        for part in segments:
            self.chars += len(part["text"])
            if part["loss"]:
                said = self.template.unescape(part["text"])
                self.loss.update(said.encode())
                self.loss_chars += len(said)
            for role, text in self.reader.feed(part["text"]):
                self.turns.update(f"{role}\n{text}\n".encode())
                self.n_turns += 1
        self.invalid += not valid
        self.state = state

    def row(self, conv_id: int | None) -> tuple:
        self.reader.close()
        complete = self.state in self.template.final
        return (conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.invalid, complete)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_invalid long, complete boolean")


def read_back(formatted: DataFrame, template: Template = CHAT, ordered: bool = False) -> DataFrame:
    """One row per conversation, from the segments alone: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_invalid, complete``.

    The turns are found in the joined texts of the segments by the template's marks; ``turns_sha256`` is over
    role, line break, text, line break of each. ``loss_chars`` and ``loss_sha256`` are over what the segments
    with a loss flag say, escapes taken back. ``n_invalid`` counts turns whose role may not come where it
    came, ``complete`` says whether the last state is a final one. Text that is no turn is an error.

    ``formatted`` are rows of ``format_turns``; ``ordered`` says that they come as that gave them, in
    order and each conversation in one partition, so that they need no further shuffle. Digests are
    sequential, so turns stream through: one batch and the turn not ended yet are held.
    """
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    names = [part.split()[0] for part in DIGESTS.split(", ")]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        current, found = None, None
        for batch in batches:
            rows = []
            for conv, valid, state, segments in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if found is None or conv != current:
                    if found is not None:
                        rows.append(found.row(current))
                    current, found = conv, _Digest(template)
                found.add(valid, state, segments)
            yield batch_of(rows)
        if found is not None:
            yield batch_of([found.row(current)])

    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return formatted.select("conv_id", "valid", "state", "segments").mapInArrow(digest, DIGESTS)
