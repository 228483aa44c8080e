"""Chat formatting with a grammar round trip.

A turn is rendered between marks: ``[INST] text [/INST]`` for a user, ``<s> text </s>`` for an assistant and
``<<role>> text <</>>`` for any other role.  A deterministic parser reads every rendered turn back; if the result
isn't the turn itself, the content that conflicts (the closing mark, and backslashes, which escape) is escaped, and the
turn is rendered again and must then come back identical.  As each turn ends with its closing mark, a conversation's
text is its turns' texts one after the other, and parsing it gives the turns' parses one after the other.

Turns are rendered where they are read.  Only rendered turns are shuffled, by conversation, and stream sorted through
the reader, which holds one turn and two running digests, so a conversation of any length needs little memory.

Defined cases: null text counts as empty, null role as the role of no characters; rows of a conversation are ordered
by turn (null first), then role, then rendered text; repeated rows are turns of their own; rows with a null conv_id
are one conversation of id null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sliced

#: Opening and closing marks by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER = ("<<", ">> ", " <</>>")
_ESCAPED = re.compile(r"\\([\\\[<>])")
_ROLE = re.compile(r"<<((?:[^\\>]|\\.)*)>> ", re.S)


def _closing(role: str) -> str:
    return MARKS[role][1] if role in MARKS else OTHER[2]


def _opening(role: str) -> str:
    return MARKS[role][0] if role in MARKS else OTHER[0] + re.sub(r"([\\<>\[])", r"\\\1", role) + OTHER[1]


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escaped(text: str, closing: str) -> str:
    """The text with conflicting content escaped: backslashes doubled, closing marks broken by one."""
    return text.replace("\\", "\\\\").replace(closing, f" \\{closing[1:]}")


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start and end of the text in ``formatted``) of all turns; None if it isn't of the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        role = next((r for r, (mark, _) in MARKS.items() if formatted.startswith(mark, at)), None)
        if role is not None:
            begin = at + len(MARKS[role][0])
        elif found := _ROLE.match(formatted, at):
            role, begin = unescaped(found[1]), found.end()
        else:
            return None
        closing = _closing(role)
        end = formatted.find(closing, begin)
        if end < 0 or _opening(role) != formatted[at:begin]:
            return None
        turns.append((role, unescaped(formatted[begin:end]), begin, end))
        at = end + len(closing)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and where its text begins and ends, escaped until it reads back identical."""
    closing = _closing(role)
    for content in (text, escaped(text, closing)):
        formatted = _opening(role) + content + closing
        turns = parse(formatted)
        if turns is not None and [t[:2] for t in turns] == [(role, text)]:
            return formatted, turns[0][2], turns[0][3]
    raise ValueError("a turn does not survive the round trip")


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, formatted, and loss_from and loss_to: the assistant's text in ``formatted`` (else null)."""

    def make():
        def work(batch: pa.RecordBatch) -> list:
            roles, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("role", "text"))
            out = [(*render(r or "", t or ""), r == "assistant") for r, t in zip(roles, texts, strict=True)]
            return [pa.array([x[0] for x in out], pa.string()), *(pa.array([x[k] if x[3] else None for x in out], pa.int32()) for k in (1, 2))]

        return work

    return map_texts(turns.select("conv_id", "turn", "role", "text"), make, ["conv_id", "turn", "role"], "formatted string, loss_from int, loss_to int")


def read_back(formatted: DataFrame) -> DataFrame:
    """For each conversation, read from its formatted text: turns, their digest, and what stands under the loss mask."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    rows = formatted.select(F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), "formatted", "loss_from", "loss_to")
    rows = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "formatted")

    def run(batches) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [c.split()[0] for c in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        def close() -> None:
            conv, n, turns, loss_chars, loss, chars = state
            done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in sliced(batches):
            for conv, text, begin, end in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5)), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content, _, _ in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{content}\n".encode())
                if begin is not None:
                    masked = unescaped(text[begin:end])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(text)
            if done:
                yield batch_of(done)
                done = []
        if state is not None:
            close()
            yield batch_of(done)

    return rows.mapInArrow(run, schema)
