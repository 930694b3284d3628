"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation::

    conversation = turn*
    turn         = header text "</turn>\\n"
    header       = "### User: " | "### Assistant: " | "### System: " | "### Role " role "</role>: "
    text, role   = characters, where "\\\\" before "\\\\", "###", "</turn>" or "</role>" makes it literal

Every turn is rendered, parsed again and compared with its source. While the two differ, its
text is escaped one level further: first not at all, then the control strings, then the
backslashes as well. The last level always comes back unchanged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADERS = {"user": "### User: ", "assistant": "### Assistant: ", "system": "### System: "}
END = "</turn>"
PART_CHARS = 1 << 20
BATCH_ROWS = 512

_ROLES = {header: role for role, header in HEADERS.items()}
_HEADER = re.compile("|".join(map(re.escape, _ROLES)))
_OTHER, _OTHER_END = "### Role ", "</role>: "
_TOKEN = re.compile(r"\\(?:\\|###|</turn>|</role>)|###|</turn>|</role>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|</role>)")
_CONTROL = re.compile(r"(###|</turn>|</role>)")
_ANY = re.compile(r"(\\|###|</turn>|</role>)")

LEVELS = (
    lambda text: text,
    lambda text: _CONTROL.sub(r"\\\1", text),
    lambda text: _ANY.sub(r"\\\1", text),
)


class Turn(NamedTuple):
    role: str
    text: str
    start: int  # of the escaped text inside what was parsed
    end: int


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _until(formatted: str, at: int, close: str) -> int:
    """Position of the first control string that isn't escaped; it must be ``close``."""
    for token in _TOKEN.finditer(formatted, at):
        if token[0][0] != "\\":
            if token[0] != close:
                raise ValueError(f"{token[0]!r} at {token.start()}, expected {close!r}")
            return token.start()
    raise ValueError(f"no {close!r} after {at}")


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted text; raises ValueError where it breaks the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        if known := _HEADER.match(formatted, at):
            role, start = _ROLES[known[0]], known.end()
        elif formatted.startswith(_OTHER, at):
            close = _until(formatted, at + len(_OTHER), "</role>")
            if not formatted.startswith(_OTHER_END, close):
                raise ValueError(f"no header at {at}")
            role, start = unescape(formatted[at + len(_OTHER) : close]), close + len(_OTHER_END)
        else:
            raise ValueError(f"no header at {at}")
        end = _until(formatted, start, END)
        at = end + len(END)
        if not formatted.startswith("\n", at):
            raise ValueError(f"no line end at {at}")
        at += 1
        turns.append(Turn(role, unescape(formatted[start:end]), start, end))
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of its text), escaped just as far as needed to come back."""
    header = HEADERS.get(role) or _OTHER + LEVELS[-1](role) + _OTHER_END
    for escape in LEVELS:
        block = f"{header}{escape(text)}{END}\n"
        try:
            back = parse(block)
        except ValueError:
            continue
        if len(back) == 1 and back[0][:2] == (role, text):
            return block, back[0].start, back[0].end
    raise AssertionError("full escaping must come back unchanged")


_MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _format(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    started, conv, part, pieces, mask, turns, chars = False, None, 0, [], [], 0, 0

    def close():
        rows.append((conv, part, turns, "".join(pieces), mask))

    def out():
        columns = list(zip(*rows)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if started and (key != conv or chars >= PART_CHARS):
                close()
                part = part + 1 if key == conv else 0
                pieces, mask, turns, chars = [], [], 0, 0
                if len(rows) >= BATCH_ROWS or part:
                    yield out()
                    rows.clear()
            started, conv = True, key
            block, start, end = render_turn(role, text)
            if role == "assistant":
                mask.append({"start": chars + start, "end": chars + end})
            pieces.append(block)
            turns, chars = turns + 1, chars + len(block)
    if started:
        close()
    yield out()


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, part, n_turns, formatted, loss_mask) of a table (conv_id, turn, role, text).

    A conversation is one row, or several consecutive parts of whole turns once it passes
    PART_CHARS; ``loss_mask`` holds the spans of the assistant's escaped texts inside ``formatted``,
    in code points. Turns stand in the order of turn (nulls first), role, text; repeated rows stay.
    A null text or role is empty, null ids form one conversation, other columns are ignored.
    The turns of a conversation are sorted and streamed in one task with a bounded buffer.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    turns = conversations.select(
        "conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn"
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    schema = pa.schema(
        [
            ("conv_id", pa.int64() if kind == "bigint" else pa.string()),
            ("part", pa.int64()),
            ("n_turns", pa.int64()),
            ("formatted", pa.string()),
            ("loss_mask", _MASK),
        ]
    )
    if kind != "bigint":
        ordered = ordered.withColumn("conv_id", F.col("conv_id").cast("string"))
    return ordered.mapInArrow(
        lambda batches: _format(batches, schema),
        f"conv_id {'bigint' if kind == 'bigint' else 'string'}, part bigint, n_turns bigint, formatted string,"
        " loss_mask array<struct<start: bigint, end: bigint>>",
    )


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    state = None
    done: list[tuple] = []

    def out():
        columns = list(zip(*done)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def close():
        conv, n, turns, loss_chars, loss, chars = state
        done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    for batch in batches:
        for conv, formatted, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if state is not None and state[0] != conv:
                close()
                state = None
            if state is None:
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for turn in parse(formatted):
                state[1] += 1
                state[2].update(f"{turn.role}\n{turn.text}\n".encode())
            for span in mask:
                text = unescape(formatted[span["start"] : span["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        if len(done) >= BATCH_ROWS:
            yield out()
            done.clear()
    if state is not None:
        close()
    yield out()


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """One row for each conversation, read from its formatted parts and loss masks alone.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of each turn), loss_chars,
    loss_sha256 (all text under the mask, unescaped), formatted_chars. ``in_order``: the parts
    come straight from ``format_conversations``, so each task already holds them in order.
    A text that breaks the grammar raises.
    """
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    kind = dict(formatted.dtypes)["conv_id"]
    schema = pa.schema(
        [
            ("conv_id", pa.int64() if kind == "bigint" else pa.string()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return formatted.select("conv_id", "formatted", "loss_mask").mapInArrow(
        lambda batches: _digests(batches, schema),
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
