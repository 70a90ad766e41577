"""Chat formatting by incremental black-box rendering.

The template is a black box: a function from a list of (role, text) to a string. Turns are rendered prefix by prefix;
what a prefix adds to the output before it is that turn's span. If a longer prefix does not start with the shorter
one's output, the template rewrites history and the conversation is marked. Where the text stands inside its span is
found by rendering the same prefix once more with a sentinel as the last text: a character that neither the role nor
the output so far holds.

Whole prefixes are rendered, however long: that takes time with the square of the turns, as it must for a template that
nothing is known of. A template may state that it is local by an attribute ``reach``: what it adds for a turn depends on
that turn and at most ``reach`` turns before it, and it never rewrites. Then a prefix is rendered as its last ``reach``
turns and the new one, which gives the same spans. ``whole`` (set in the query op9_format_chat) takes no such statement.

Rows are dealt by conversation and sorted inside the partitions, then read as a stream: the output is one row per turn,
in order, whose segments concatenate to the formatted conversation. Of a conversation a task holds the prefix that is
rendered: a few turns for a local template.

Edge cases: null text and null role are empty; null conv_id is a conversation of its own; rows that repeat a turn keep
the order of (turn, role, text), nulls first; empty tables give empty results; columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import no_clash

#: The control strings of the default template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE=", "[/ROLE]")
_CONTROL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ROLE = re.compile(r"\[ROLE=((?:[^\]\\]|\\.)*)\] ", re.S)
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("", "</s>")}

Template = Callable[[list[tuple[str, str]]], str]


def escape(text: str) -> str:
    """A backslash is doubled; in a control string a backslash follows the first character."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def inst_template(turns: list[tuple[str, str]]) -> str:
    out = ["<s>"]
    for role, text in turns:
        before, after = MARKS.get(role) or (f"[ROLE={escape(role).replace(']', chr(92) + ']')}] ", " [/ROLE]")
        out += (before, escape(text), after)
    return "".join(out)


#: What a turn adds is its own text and marks.
inst_template.reach = 0


def sentinel(*texts: str) -> str:
    """A private-use character that none of the texts holds."""
    return next(c for c in map(chr, range(0xE000, 0x110000)) if not any(c in t for t in texts))


def read_turns(formatted: str, at: int = 0) -> Iterator[tuple[str, str]]:
    """The turns of a string that inst_template has made."""
    if formatted.startswith("<s>", at):
        at += 3
    while at < len(formatted):
        role = next((r for r in ("user", "system") if formatted.startswith(MARKS[r][0], at)), None)
        if role:
            start, after = at + len(MARKS[role][0]), MARKS[role][1]
        elif m := _ROLE.match(formatted, at):
            role, start, after = unescape(m[1]), m.end(), " [/ROLE]"
        else:
            role, start, after = "assistant", at, "</s>"
        end = formatted.index(after, start)
        yield role, unescape(formatted[start:end])
        at = end + len(after)


class Incremental:
    """Feeds turns one by one and gives each turn's segment and the span of its text in it."""

    def __init__(self, template: Template, whole: bool = False):
        self.template, self.reach, self.turns, self.last = template, None if whole else getattr(template, "reach", None), [], ""

    def add(self, role: str, text: str) -> tuple[str, int, int, bool]:
        if self.reach is not None and len(self.turns) > self.reach:
            self.turns = self.turns[len(self.turns) - self.reach :]
            self.last = self.template(self.turns)
        mark = sentinel(role, self.last)
        probe = self.template([*self.turns, (role, mark)])
        self.turns.append((role, text))
        now = self.template(self.turns)
        rewrites = not now.startswith(self.last)
        segment = now[len(self.last) :]
        front, found, back = probe[len(self.last) :].partition(mark)
        start, end = (len(front), len(segment) - len(back)) if found and not rewrites else (0, 0)
        self.last = now
        return segment, start, end, rewrites


def _segments(template: Template, whole: bool = False):
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("role", pa.string()), ("segment", pa.string()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("rewrites_history", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, number = object(), None, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != current:
                    current, state, number = conv, Incremental(template, whole), 0
                segment, start, end, rewrites = state.add(role or "", text or "")
                rows.append((conv, number, role or "", segment, start, end, rewrites))
                number += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def format_conversations(conversations: DataFrame, template: Template = inst_template, whole: bool = False) -> DataFrame:
    """whole renders whole prefixes whatever reach the template states, so a wrong statement does no harm. One row per turn, in order within its partition: conv_id, turn_no, role, segment, text_start, text_end (code
    points in the segment: the loss mask of assistant turns), rewrites_history. A conversation's formatted text is the
    concatenation of its segments by turn_no."""
    rows = no_clash(conversations, "conv_id", "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id bigint, turn_no bigint, role string, segment string, text_start bigint, text_end bigint, rewrites_history boolean"
    return ordered.mapInArrow(_segments(template, whole), schema)


class _ReadBack:
    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.n, self.loss_chars, self.chars = conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, segment: str, masked: tuple[int, int]):
        for role, text in read_turns(segment):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
            if role == "assistant":
                loss = unescape(segment[slice(*masked)])
                self.loss.update(loss.encode())
                self.loss_chars += len(loss)
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    state: _ReadBack | None = None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        done = []
        for conv, number, segment, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn_no", "segment", "text_start", "text_end"))):
            if number == 0:
                if state:
                    done.append(state.row())
                state = _ReadBack(conv)
            state.add(segment, (start, end))
        if done:
            yield batch_of(done)
    if state:
        yield batch_of([state.row()])


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say, parsed from the output itself."""
    return segments.mapInArrow(_read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
