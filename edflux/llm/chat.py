"""Chat formatting: a declarative template, a turn-order automaton and loss flags per segment.

A turn is written as ``### Role: text</turn>`` and a line feed. Inside roles and texts every
backslash, ``#`` and ``<`` (in roles also ``:``) gets a backslash before it, so no marker can
occur in them and the output reads back to exactly the same turns. Only the text of the
template's trained roles is under the loss mask.

Turns are ordered by a sort within hash partitions of conversations and streamed, so a
conversation of any length needs the memory of one turn, not of all its turns.

Cases: a null text is an empty one, a null role the role ""; unknown roles are formatted and
make the conversation invalid, as does a broken order; turns with equal numbers are ordered
by role and text; null turn numbers come first; a conversation without an id is one
conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Markers, the roles whose text is trained on, and the allowed order of roles.

    ``order`` maps a state (the role before, "" at the start) to the roles that may follow.
    """

    head: str = "### "
    colon: str = ": "
    close: str = "</turn>\n"
    trained: frozenset[str] = frozenset({"assistant"})
    order: tuple[tuple[str, frozenset[str]], ...] = (
        ("", frozenset({"system", "user"})),
        ("system", frozenset({"user"})),
        ("user", frozenset({"assistant"})),
        ("assistant", frozenset({"user"})),
    )
    ends: frozenset[str] = frozenset({"assistant"})


DEFAULT = Template()
_ROLE = re.compile(r"[\\#<:]")
_TEXT = re.compile(r"[\\#<]")
_BACK = re.compile(r"\\(.)", re.S)


def segments(role: str, text: str, template: Template = DEFAULT) -> list[tuple[str, bool]]:
    """Text segments of one turn with their loss flags."""
    return [
        (template.head + _ROLE.sub(r"\\\g<0>", role) + template.colon, False),
        (_TEXT.sub(r"\\\g<0>", text), role in template.trained),
        (template.close, False),
    ]


def parse(text: str, template: Template = DEFAULT) -> Iterator[tuple[str, str]]:
    """The (role, text) turns that the formatted ``text`` holds."""
    one = re.escape(template.head) + r"((?:\\.|[^\\#<:])*)" + re.escape(template.colon) + r"((?:\\.|[^\\#<])*)" + re.escape(template.close)
    at = 0
    for m in re.finditer(one, text, re.S):
        if m.start() != at:
            break
        at = m.end()
        yield _BACK.sub(r"\1", m[1]), _BACK.sub(r"\1", m[2])
    if at != len(text):
        raise ValueError(f"not a formatted turn at character {at}")


def format_chat(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Segments in order: conv_id, seq (from 0 in a conversation), segment, loss, state.

    ``state`` is the automaton's after the turn, null once the order was broken. Rows of a
    conversation are consecutive and sorted within one partition.
    """
    allowed = dict(template.order)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, seq long, segment string, loss boolean, state string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, state = object(), 0, None
        for batch in batches:
            out: list[tuple] = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if c != conv:
                    conv, seq, state = c, 0, ""
                state = role if state is not None and role in allowed.get(state, ()) else None
                for segment, loss in segments(role, text, template):
                    out.append((c, seq, segment, loss, state))
                    seq += 1
            if out:
                types = (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.bool_(), pa.string())
                cols = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["conv_id", "seq", "segment", "loss", "state"])

    return (
        conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(emit, schema)
    )


class _Digest:
    """What one conversation's formatted output says, read back turn by turn."""

    def __init__(self, conv, template: Template) -> None:
        self.conv, self.template, self.pending, self.loss_now = conv, template, [], []
        self.turns, self.chars, self.loss_chars, self.state = 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss: bool, state: str | None) -> None:
        self.chars += len(segment)
        self.pending.append(segment)
        if loss:
            self.loss_now.append(segment)
        if segment == self.template.close:
            for role, text in parse("".join(self.pending), self.template):
                self.turns += 1
                self.all.update(f"{role}\n{text}\n".encode())
            masked = _BACK.sub(r"\1", "".join(self.loss_now))
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
            self.pending, self.loss_now, self.state = [], [], state

    def row(self) -> tuple:
        ok = self.state is not None and self.state in self.template.ends
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, ok


def digest(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Read the segments of :func:`format_chat` back: counts and hashes, a row per conversation."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid_order"]
    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid_order boolean"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, id_type = None, [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if done:
                types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
                cols = [pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names)
                done.clear()

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for c, seq, segment, loss, state in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if seq == 0:
                    if now:
                        done.append(now.row())
                    now = _Digest(c, template)
                now.add(segment, loss, state)
            yield from flush()
        if now:
            done.append(now.row())
        yield from flush()

    return formatted.mapInArrow(read, schema)
