"""Chat formatting with a grammar round trip.

A template is a small grammar over control strings:

    conversation := turn*
    turn         := OPEN role MIDDLE text CLOSE

Every rendered turn is parsed again by a deterministic parser.  While the recovered turn is not the source, one more kind of
control string that its content holds is escaped: a backslash goes behind the first character of each occurrence
(``<|im_end|>`` becomes ``<\\|im_end|>``, and ``<\\|im_end|>`` becomes ``<\\\\|im_end|>``), and the parser takes one away.  As no control
string overlaps another, there are at most as many rounds as kinds, each linear in the text.

Turns are closed sentences of the grammar, so the formatted conversation is the segments of its turns one after the other,
and is kept as one row per turn: no conversation has to fit into memory.  ``loss_start`` and ``loss_end`` are the
code points of a segment that a model learns from.

Null texts and roles are empty.  Rows of a null ``conv_id`` form one conversation.  Turns go by ``turn`` (null first); equal ones by
their rendered text, so repeated rows are repeated turns.  Very long texts are rendered, parsed and hashed in linear time, a text at
a time.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Conflict(ValueError):
    """Rendered text that the grammar refuses."""


@dataclass(frozen=True)
class Turn:
    role: str
    text: str
    #: Where the text lies in the rendered form, still escaped.
    start: int
    end: int


@dataclass(frozen=True)
class Template:
    """Marks of turns, and other control strings of the tokenizer that no content may hold."""

    opening: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    closing: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learned_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        controls = self.controls
        if len(set(controls)) < len(controls) or any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings must differ, have two characters or more and no backslash")
        for one in controls:
            for other in controls:
                joined = any(one.endswith(other[:k]) for k in range(1, min(len(one), len(other)) + (one != other)))
                if joined or (one != other and one in other):
                    raise ValueError(f"{one} and {other} may overlap")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.opening, self.middle, self.closing, *self.reserved)

    @cached_property
    def _control(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c) for c in self.controls))

    @cached_property
    def _families(self) -> dict[str, re.Pattern]:
        """A control string with any number of backslashes behind its first character."""
        return {c: re.compile(re.escape(c[0]) + r"\\*" + re.escape(c[1:])) for c in self.controls}

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in self.controls))

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:], text) if "\\" in text else text

    def parse(self, rendered: str) -> list[Turn]:
        """The turns of a rendered text; one control string decides each step."""
        turns, wanted, at, role = [], self.opening, 0, ""
        for found in self._control.finditer(rendered):
            if found[0] != wanted or (wanted == self.opening and found.start() != at):
                raise Conflict(f"{found[0]} at {found.start()} where {wanted} is due")
            if wanted == self.opening:
                wanted = self.middle
            elif wanted == self.middle:
                role, wanted = self.unescape(rendered[at : found.start()]), self.closing
            else:
                turns.append(Turn(role, self.unescape(rendered[at : found.start()]), at, found.start()))
                wanted = self.opening
            at = found.end()
        if wanted != self.opening or at != len(rendered):
            raise Conflict(f"the text ends where {wanted} is due")
        return turns

    def render(self, role: str, text: str) -> tuple[str, Turn]:
        """The segment of a turn, with the turn as parsed back from it."""
        escaped: list[str] = []
        while True:
            contents = []
            for content in (role, text):
                for control in escaped:
                    content = self._families[control].sub(lambda m: m[0][0] + "\\" + m[0][1:], content)
                contents.append(content)
            segment = f"{self.opening}{contents[0]}{self.middle}{contents[1]}{self.closing}"
            try:
                turns = self.parse(segment)
            except Conflict:
                turns = []
            if len(turns) == 1 and (turns[0].role, turns[0].text) == (role, text):
                return segment, turns[0]
            left = (c for c in self.controls if c not in escaped and any(self._families[c].search(x) for x in (role, text)))
            control = next(left, None)
            if control is None:
                raise Conflict("no escape brings the turn back")
            escaped.append(control)


CHAT = Template()


def _strings(column: pa.Array) -> Iterator[str]:
    """Texts of a column; null is empty, and bytes that are no UTF-8 survive."""
    for value in column.cast(pa.binary()):
        raw = value.as_py()
        yield raw.decode("utf-8", "surrogateescape") if raw else ""


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per turn: ``conv_id, turn, segment, loss_start, loss_end`` (the last two null where nothing is learned)."""
    schema = "conv_id long, turn long, segment string, loss_start long, loss_end long"

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, starts, ends = [], [], []
            for role, text in zip(_strings(batch.column(2)), _strings(batch.column(3))):
                segment, turn = template.render(role, text)
                learned = role in template.learned_roles
                segments.append(_bytes(segment))
                starts.append(turn.start if learned else None)
                ends.append(turn.end if learned else None)
            columns = [pa.array(segments, pa.binary()).view(pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=schema_names)

    schema_names = [part.split()[0] for part in schema.split(", ")]
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")]
    return conversations.select(*columns).mapInArrow(render, schema)


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation, from the formatted text alone: its turns as parsed, and all text under the loss mask.

    A conversation streams through one task in order, since a SHA-256 of its turns is one chain; a task holds one segment
    and two digests however long it is.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tally = None, None
        done: list[tuple] = []

        def close():
            n, turns, chars, loss, formatted_chars = tally
            done.append((last, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars))

        def flush():
            columns = [pa.array(list(c)) for c in zip(*done)] if done else [pa.array([])] * 6
            out = pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names=names)
            done.clear()
            return out

        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), _strings(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for conv_id, segment, start, end in rows:
                if tally is None or conv_id != last:
                    if tally is not None:
                        close()
                    last, tally = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for turn in template.parse(segment):
                    tally[0] += 1
                    tally[1].update(_bytes(f"{turn.role}\n{turn.text}\n"))
                if start is not None:
                    learned = template.unescape(segment[start:end])
                    tally[2] += len(learned)
                    tally[3].update(_bytes(learned))
                tally[4] += len(segment)
            yield flush()
        if tally is not None:
            close()
        yield flush()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(read, schema)
