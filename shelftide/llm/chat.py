"""Chat formatting that is proven turn by turn by reading the formatted text back.

The grammar: a conversation is a row of turns; a turn of a user is ``[INST]text[/INST]``, of the system ``[SYS]text[/SYS]``,
of an assistant ``text</s>``, of any other role ``[TURN]role[:]text[/TURN]``. No mark can begin inside another, so the parser
reads from left to right without going back. Where text holds a mark, or a mark with escapes in it, the text read back differs
from the source; then a backslash goes in after the first character of each such mark, and reading takes one out.
Turns that come back identical as they are stay as they are. A turn that is not identical after escaping raises an error.

Turns are formatted row by row; a conversation's text is its turns in order, and ``start`` says where a turn begins in it.
Digests of a conversation stream over its sorted turns, so a conversation of any length needs the memory of one batch.

Null text is empty, and so is a null role; null conversation ids are a conversation of their own; null turns come first. Turns
with equal numbers are ordered by role and text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Role: opening and closing mark. Fixed values.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("", "</s>")}
_OTHER, _NAME, _END = "[TURN]", "[:]", "[/TURN]"

_INNER = r"(?:INST\]|/INST\]|SYS\]|/SYS\]|TURN\]|/TURN\]|:\]|/s>)"
_MARK = re.compile(rf"([\[<])(\\*)(?={_INNER})")
_ESCAPED = re.compile(rf"([\[<])\\(\\*)(?={_INNER})")


def escape(text: str) -> str:
    return _MARK.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str) -> str:
    if role in MARKS:
        return MARKS[role][0] + text + MARKS[role][1]
    return f"{_OTHER}{role}{_NAME}{text}{_END}"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        role = next((r for r, (begin, _) in MARKS.items() if begin and formatted.startswith(begin, at)), None)
        if role is None and formatted.startswith(_OTHER, at):
            name = formatted.index(_NAME, at)
            end = formatted.index(_END, name)
            turns.append((unescape(formatted[at + len(_OTHER):name]), unescape(formatted[name + len(_NAME):end])))
            at = end + len(_END)
            continue
        begin, close = MARKS[role or "assistant"]
        end = formatted.index(close, at + len(begin))
        turns.append((role or "assistant", unescape(formatted[at + len(begin):end])))
        at = end + len(close)
    return turns


def _reads_back(formatted: str, role: str, text: str) -> bool:
    try:
        return parse(formatted) == [(role, text)]
    except ValueError:
        return False


def format_turn(role: str | None, text: str | None) -> str:
    role, text = role or "", text or ""
    for name, inner in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        if _reads_back(formatted := render(name, inner), role, text):
            return formatted
    raise ValueError(f"a turn of role {role!r} can't be formatted so that it reads back")


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with ``formatted``: each row's part of the conversation's text."""
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [format_turn(r, t) for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, "formatted"])

    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, formatted string")


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str) -> int:
        start = self.chars
        self.chars += len(formatted)
        for role, text in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        return start

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _in_order(formatted: DataFrame) -> DataFrame:
    order = ["conv_id", "turn", "role", "text"]
    return formatted.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])


def conversation_starts(formatted: DataFrame) -> DataFrame:
    """Rows of :func:`format_turns` with ``start``: where the turn's part begins in its conversation's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = object(), 0
        for b in batches:
            starts = []
            for conv, text in zip(b.column(0).to_pylist(), b.column(4).to_pylist(), strict=True):
                if conv != now:
                    now, at = conv, 0
                starts.append(at)
                at += len(text)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(starts, pa.int64())], [*b.schema.names, "start"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in formatted.schema)
    return _in_order(formatted).mapInArrow(run, f"{fields}, start long")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what the formatted text says when it is read back."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def made(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, conv_type = None, None, pa.int64()
        for b in itertools.chain(batches, (None,)):
            done = []
            if b is None:
                if digest:
                    yield made([(now, *digest.row())], conv_type)
                return
            conv_type = b.column(0).type
            for conv, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if digest is None or conv != now:
                    if digest:
                        done.append((now, *digest.row()))
                    now, digest = conv, _Digest()
                digest.add(text)
            if done:
                yield made(done, conv_type)

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _in_order(formatted).select("conv_id", "formatted").mapInArrow(run, schema)
