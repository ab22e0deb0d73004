"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a declarative template.

The rows of a conversation, in turn order, pass through the machine one by one; a task holds one turn at a time, however long the
conversation. Each turn gives three segments: the role's opening marker, the text, the closing marker. Control strings inside texts
are escaped: each backslash is doubled and a control string gets a backslash after its first character, so no text holds a control
string and the escape is undone by reading left to right. A turn that the machine doesn't allow makes its conversation invalid from
there on; it is formatted like any other, so that callers can drop or keep such conversations whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Template:
    """Markers and loss by role; other roles are named inside ``other``. Allowed: state to role to state, from "start"."""

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("<role>", "<turn>", "</turn>")
    loss: frozenset[str] = frozenset({"assistant"})
    allowed: dict[str, dict[str, str]] = field(default_factory=lambda: {"start": {"system": "begun", "user": "asked"}, "begun": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})

    @property
    def controls(self) -> list[str]:
        return sorted({m for pair in self.roles.values() for m in pair} | set(self.other), key=len, reverse=True)

    def control_pattern(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls)))


SEGMENT = "turn_no long, part int, text string, loss boolean, valid boolean"
DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def _typed(conv_id: T.DataType, rest: str) -> tuple[T.StructType, pa.Schema]:
    """conv_id, of its own type, and the rest."""
    kind = T.StructType([T.StructField("conv_id", conv_id), *T._parse_datatype_string(rest)])
    return kind, to_arrow_schema(kind)


def escape(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


_ESCAPED = re.compile(r"\\(\\?)")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segments(rows: Iterator[tuple], template: Template) -> Iterator[tuple]:
    """(conv_id, role, text) rows, a conversation's together and in order, to (conv_id, turn_no, part, text, loss, valid) segments."""
    controls = template.control_pattern()
    last, state, turn = object(), "start", 0
    for conv, role, text in rows:
        role = role or ""
        if conv != last:
            last, state, turn = conv, "start", 0
        state = template.allowed.get(state, {}).get(role, "invalid")
        own = template.roles.get(role)
        begin, end = own or (template.other[0] + escape(role, controls) + template.other[1], template.other[2])
        valid = state != "invalid"
        yield conv, turn, 0, begin, False, valid
        yield conv, turn, 1, escape(text or "", controls), role in template.loss, valid
        yield conv, turn, 2, end, False, valid
        turn += 1


def parse(formatted: str, template: Template) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    opens = {pair[0]: (role, pair[1]) for role, pair in template.roles.items()}
    at, out = 0, []
    while at < len(formatted):
        for begin, (role, end) in opens.items():
            if formatted.startswith(begin, at):
                at += len(begin)
                break
        else:
            if not formatted.startswith(template.other[0], at):
                raise ValueError(f"no marker at {at}")
            at += len(template.other[0])
            stop = formatted.index(template.other[1], at)
            role, end = unescape(formatted[at:stop]), template.other[2]
            at = stop + len(template.other[1])
        stop = formatted.index(end, at)
        out.append((role, unescape(formatted[at:stop])))
        at = stop + len(end)
    return out


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or chars >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template | None = None) -> DataFrame:
    """The segments of all conversations, each conversation's together and in order within a partition.

    conv_id is of any type that has an order. Rows of a conversation are ordered by turn, then role and text, so equal rows are
    interchangeable; a null turn comes first. A null text or role is empty; rows with a null conversation id are one conversation.
    Other columns, whatever their names, play no part; an empty table gives no segments. The turns of one conversation are sorted
    in one task, which spills; after that a task holds one turn at a time.
    """
    template = template or Template()
    rows = turns.select(F.col(f"`{conv_id}`").alias("c"), F.col(turn).alias("n"), F.col(role).alias("r"), F.col(text).alias("t")).repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t")
    kind, schema = _typed(rows.schema["c"].dataType, SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches(segments(each, template), schema)

    return rows.mapInArrow(run, kind)


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """One row a conversation, read back from the segments of format_chats: turns, what is under the loss mask, and sizes.

    A conversation is read as the segments come, by the same markers that ``parse`` reads.
    """
    template = template or Template()
    opens = {pair[0]: role for role, pair in template.roles.items()}
    kind, schema = _typed(formatted.schema["conv_id"].dataType, DIGEST)

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list = []  # conv, turns, hash, loss chars, loss hash, chars, valid
        for conv, turn, part, text, loss, valid in rows:
            if part == 0 and turn == 0:
                if held:
                    yield held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5], held[6]
                held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
            held[5] += len(text)
            held[6] = valid
            if part == 0:
                role = opens[text] if text in opens else unescape(text[len(template.other[0]) : -len(template.other[1])])
                held[1] += 1
                held[2].update(f"{role}\n".encode())
            elif part == 1:
                own = unescape(text)
                held[2].update(f"{own}\n".encode())
            if loss:
                own = unescape(text)
                held[3] += len(own)
                held[4].update(own.encode())
        if held:
            yield held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5], held[6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches(read(each), schema)

    return formatted.mapInArrow(run, kind)
