"""Chat formatting by a grammar round trip.

A conversation is the concatenation of its turns in order:

    user       [INST] text [/INST]
    system     <<SYS>>↵text↵<</SYS>>
    assistant  <s>text</s>
    any other  [ROLE name] text [/ROLE]       (name percent-encoded)

The parser is deterministic: at the start of a turn it takes the opening mark, and
inside a turn the first control string must be the closing mark that belongs to it.
Every turn is rendered, parsed again and compared with its source; where they
differ, the control strings of the text (and what already looks like an escaped
one) get a backslash behind their first character, until the turn comes back
identical. Since a turn ends where its closing mark ends, turns that come back one
by one also come back from the whole text, whatever their number, and formatting
needs no shuffle and no row larger than a turn.

The loss mask covers the texts of assistant turns, without their marks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Role, opening and closing mark; fixed values of the template.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>"), "assistant": ("<s>", "</s>")}
#: Control strings, and what looks like one that was escaped. No text may hold the first kind unescaped.
CONTROL = re.compile(r"[\[<](\\*)(?:/?INST\]|/?ROLE|</?SYS>>|/?s>)")
_ESCAPED = re.compile(r"([\[<])\\(?=\\*(?:/?INST\]|/?ROLE|</?SYS>>|/?s>))")
_OPENING = re.compile(r"(?P<user>\[INST\] )|(?P<system><<SYS>>\n)|(?P<assistant><s>)|\[ROLE (?P<name>[^\] ]*)\] ")


class Conflict(ValueError):
    """The text does not follow the grammar."""


def marks_of(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"[ROLE {quote(role, safe='')}] ", " [/ROLE]")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """``role, text, body start, body end, end`` of the turn that begins at ``at``."""
    m = _OPENING.match(text, at)
    if m is None:
        raise Conflict(f"no turn begins at {at}")
    role = m.lastgroup if m["name"] is None else unquote(m["name"])
    closing = marks_of(role)[1]
    first = at = m.end()
    while True:
        found = CONTROL.search(text, at)
        if found is None:
            raise Conflict("a turn does not end")
        if not found[1]:
            break
        at = found.end()
    stop = found.start() - (len(closing) - len(closing.lstrip()))
    if stop < first or not text.startswith(closing, stop):
        raise Conflict(f"{found[0]!r} inside a turn of {role!r}")
    return role, unescape(text[first:stop]), first, stop, stop + len(closing)


def parse(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(text):
        role, body, _, _, at = parse_turn(text, at)
        out.append((role, body))
    return out


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses back to role and text, and where its body begins and ends."""
    opening, closing = marks_of(role)
    for body in (text, escape(text)):  # the second always comes back: it holds no control string
        out = f"{opening}{body}{closing}"
        try:
            role_back, text_back, first, stop, end = parse_turn(out)
        except Conflict:
            continue
        if (role_back, text_back, end) == (role, text, len(out)):
            return out, first, stop
    raise Conflict(f"a turn of {role!r} does not come back")


class Reader:
    """Reads a formatted conversation part by part; holds no more than the turn it is in."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, part: str, mask: tuple[int, int] | None) -> None:
        """A part in the order of the text, and the span of it under the loss mask."""
        if mask is not None:
            masked = unescape(part[mask[0]:mask[1]])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        self.chars += len(part)
        self.rest, at = self.rest + part, 0
        while at < len(self.rest):
            try:
                role, text, _, _, at = parse_turn(self.rest, at)
            except Conflict:
                break  # more parts may complete it
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        self.rest = self.rest[at:]

    def result(self) -> tuple[int, str, int, str, int]:
        if self.rest:
            raise Conflict("a formatted conversation does not follow the grammar")
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        out = [render(r or "", t or "") for r, t in zip(roles, texts)]
        loss = [r == "assistant" for r in roles]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([r or "" for r in roles], pa.string()), pa.array([o[0] for o in out], pa.string()),
            pa.array([o[1] if l else None for o, l in zip(out, loss)], pa.int32()),
            pa.array([o[2] if l else None for o, l in zip(out, loss)], pa.int32())],
            ["conv_id", "turn", "role", "formatted", "loss_from", "loss_to"])


def format_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The formatted turns: ``conv_id, turn, role, formatted``, and in ``formatted`` the span ``loss_from .. loss_to`` of the loss mask.

    A formatted conversation is the concatenation of its rows by turn, then role and
    text (so that ties have one order); null turns come first. A null text or role is
    empty; rows without an id are one conversation of their own. Repeated rows are
    turns of their own. Turns that are not the assistant's have no span. Other
    columns are left out; an empty table gives an empty one.
    """
    rows = turns.select(F.col(conversation), F.col(turn), F.col(role), F.col(text))
    kinds = [f.dataType.simpleString() for f in rows.schema[:2]]
    return rows.mapInArrow(
        _format_batches, f"conv_id {kinds[0]}, turn {kinds[1]}, role string, formatted string, loss_from int, loss_to int")


def join_turns(formatted: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, the whole ``formatted`` text and the spans of its ``loss_mask``.

    For conversations that fit in a row; ``read_back`` does not need it.
    """
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "formatted", "loss_from", "loss_to")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def on(state, p):
        here = F.array(F.struct((state["at"] + p["loss_from"]).alias("start"), (state["at"] + p["loss_to"]).alias("stop")))
        spans = F.when(p["loss_from"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], here))
        return F.struct((state["at"] + F.char_length(p["formatted"])).alias("at"), spans.alias("spans"))

    return formatted.groupBy("conv_id").agg(parts.alias("p")).select(
        "conv_id", F.array_join(F.transform("p", lambda p: p["formatted"]), "").alias("formatted"),
        F.aggregate("p", start, on)["spans"].alias("loss_mask"))


def _read_batches(batches: Iterator[pa.RecordBatch], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    done: list[tuple] = []
    key, reader = None, None

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    for batch in batches:
        for row_key, part, first, stop in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if reader is None or row_key != key:
                if reader is not None:
                    done.append((key, *reader.result()))
                key, reader = row_key, Reader()
            reader.feed(part, None if first is None else (first, stop))
        if len(done) >= 5000:
            yield table()
            done = []
    if reader is not None:
        done.append((key, *reader.result()))
    if done:
        yield table()


def read_back(formatted: DataFrame) -> DataFrame:
    """What the grammar finds in formatted conversations, one row each.

    ``conv_id, n_turns``, ``turns_sha256`` of role, line break, text and line break of
    each turn, ``loss_chars`` and ``loss_sha256`` of the unescaped text under the loss
    mask, ``formatted_chars``. A conversation is read part by part in one pass, so the
    longest one needs no more memory than its longest turn. What does not follow the
    grammar raises an error.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = formatted.schema["conv_id"].dataType
    key_type = to_arrow_type(kind)
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return rows.select("conv_id", "formatted", "loss_from", "loss_to").mapInArrow(
        lambda b: _read_batches(b, key_type),
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
