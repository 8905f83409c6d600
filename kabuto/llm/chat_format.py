"""Chat formatting (operator 7): grammar round trip with reversible escapes.

Grammar of the output, one conversation after another::

    turn := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

Nothing else may hold "<|", so the parser is deterministic: it reads control strings and the
stretches between them. Content that conflicts is escaped by one more backslash in every
"<", backslashes, "|" (read back by taking one away); a line feed in a role is written as the
control string "<|nl|>". A turn is rendered as it is, parsed, compared with its source, and
escaped until the parser gives the source back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
_CONTROL = re.compile(r"(<\|im_start\|>|<\|im_end\|>\n)")
_RAW, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


class Malformed(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; raises ``Malformed`` for anything outside the grammar."""
    parts = _CONTROL.split(formatted)
    turns = []
    if len(parts) % 4 != 1 or parts[-1]:
        raise Malformed("a turn is cut off")
    for k in range(0, len(parts) - 1, 4):
        between, start, body, end = parts[k : k + 4]
        role, line, text = body.partition("\n")
        role = role.replace(LINE, "\n")
        if between or start != START or end != END or not line or "<|" in role or "<|" in text:
            raise Malformed("control strings out of order")
        turns.append((unescape(role), unescape(text)))
    return turns


def render_turn(role: str | None, text: str | None, max_rounds: int = 8) -> tuple[str, int]:
    """The formatted turn and how many rounds of escaping it took (null: empty)."""
    role, text = role or "", text or ""
    shown_role, shown_text = role, text
    for rounds in range(max_rounds):
        formatted = f"{START}{shown_role}\n{shown_text}{END}"
        try:
            if parse(formatted) == [(role, text)]:
                return formatted, rounds
        except Malformed:
            pass
        shown_role = escape(role).replace("\n", LINE)
        shown_text = escape(text)
    raise Malformed("the turn can't be escaped")


def format_turns(turns: DataFrame, role: str = "role", text: str = "text", out: str = "formatted") -> DataFrame:
    """``turns`` with the formatted text of each turn in the column ``out`` (replaced if there).

    One row per row, no shuffle. A conversation's text is its turns' texts joined in order. Null
    roles and texts count as empty; repeated rows are repeated turns."""
    prepare(turns.sparkSession)

    def render(roles: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([render_turn(r.as_py(), t.as_py())[0] for r, t in zip(roles, texts, strict=True)], pa.string())

    return turns.withColumn(out, F.arrow_udf(render, "string")(F.col(role), F.col(text)))


SUMMARY = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Summary:
    """What is read back from one conversation, turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str) -> None:
        for role, text in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn", out: str = "formatted", ties: tuple[str, ...] = ("role", "text")) -> DataFrame:
    """One row per conversation, read back from its formatted turns: ``conv`` and SUMMARY (the
    loss covers the assistant's texts, unescaped, in order).

    Turns are dealt out by conversation, sorted (by ``turn``, nulls first, then ``ties``) by Spark's
    external sort and streamed through incremental digests, so a conversation of any length takes
    constant memory. Null conversation ids form one conversation.
    """
    prepare(formatted.sparkSession)
    schema = f"`{conv}` {formatted.schema[conv].dataType.simpleString()}, {SUMMARY}"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary, done, kind = None, None, [], None
        for batch in batches:
            kind = batch.schema.field(0).type
            for c, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if summary is None or c != current:
                    if summary is not None:
                        done.append((current, *summary.row()))
                    current, summary = c, _Summary()
                summary.add(text.as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind if k == 0 else None) for k, x in enumerate(zip(*done, strict=True))], names=names)
                done = []
        if summary is not None:
            done.append((current, *summary.row()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind if k == 0 else None) for k, x in enumerate(zip(*done, strict=True))], names=names)

    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    dealt = formatted.repartition(F.col(conv)).sortWithinPartitions(conv, turn, *ties)
    return dealt.select(conv, out).mapInArrow(stream, schema)


def chat_format(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Format all turns and read the conversations back (see ``read_back``)."""
    kept = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return read_back(format_turns(kept))
