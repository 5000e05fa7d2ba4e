"""Chat formatting of typed content parts.

A visitor walks the parts of a turn in order and flattens them into one
string: text is escaped, an image, audio or document part becomes a
placeholder. For each attachment it records the reference and the number of
tokens that the placeholder expands to. Formatting needs one row at a time, so
it runs before any shuffle; only formatted turns are dealt by conversation, to
be read back in order as a stream. No task ever holds a whole conversation.

Template (fixed): a turn of role ``assistant`` is ``<s>role\\ncontent</s>\\n``
and its content is under the loss mask; any other turn is
``[INST]role\\ncontent[/INST]\\n``. Escaping: every backslash is doubled, then a
backslash is put after the first character of every control string, so that no
control string is left; one pass over the backslashes undoes it.

Defined results: a null text (or part list) counts as empty, a null role as the
empty role; an unknown part type raises; turns are ordered by ``turn`` (null
first), ties by their formatted text; repeated rows are repeated turns; a null
conversation id is a conversation; an empty table gives an empty table; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# The control strings of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|image|>", "<|audio|>", "<|document|>")
LEARNED_ROLE = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"(?:\[INST\]|<s>)((?:[^\\\n]|\\.)*)\n(.*?)(?:\[/INST\]|</s>)\n", re.S)

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
ATTACHMENTS = "array<struct<kind:string,ref:string,tokens:bigint>>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Costs:
    """Tokens that a placeholder expands to."""
    patch: int = 14             # pixels of an image patch's side, a token each
    audio_per_second: float = 25.0
    document_page: int = 512


@dataclass
class PartVisitor:
    """Flattens the parts of one turn, in order."""
    costs: Costs = field(default_factory=Costs)
    content: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown part type {kind!r}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.content.append(escape(text))
        self.tokens += len(text.split())

    def visit_image(self, part: dict) -> None:
        side = self.costs.patch
        self._attach("image", part, math.ceil((part.get("width") or 0) / side)
                     * math.ceil((part.get("height") or 0) / side))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part,
                     math.ceil((part.get("seconds") or 0.0) * self.costs.audio_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.costs.document_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.content.append(f"<|{kind}|>")
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self.tokens += tokens


def format_turn(role: str | None, content: str) -> str:
    named = escape(role or "").replace("\n", "\\\n")
    if role == LEARNED_ROLE:
        return f"<s>{named}\n{content}</s>\n"
    return f"[INST]{named}\n{content}[/INST]\n"


def format_turns(conversations: DataFrame, costs: Costs = Costs(), conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 parts_col: str | None = None) -> DataFrame:
    """One row per turn: ``conv``, ``turn``, ``formatted``, the span under the
    loss mask (``loss_start``, ``loss_chars``; null if none), ``attachments``
    in the order of their placeholders and ``expanded_tokens``. A plain text
    is one text part; ``parts_col`` names a column of type ``PARTS``."""
    ship(conversations.sparkSession)
    types = {c: conversations.schema[c].dataType.simpleString() for c in (conv_col, turn_col)}
    schema = (f"conv {types[conv_col]}, turn {types[turn_col]}, formatted string, loss_start int, "
              f"loss_chars int, attachments {ATTACHMENTS}, expanded_tokens bigint")
    attached = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()),
                                   ("tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for role, body in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                visitor = PartVisitor(costs)
                for part in (body or []) if parts_col else [{"type": "text", "text": body}]:
                    visitor.visit(part)
                content = "".join(visitor.content)
                turn = format_turn(role, content)
                learned = role == LEARNED_ROLE
                values = (turn, len(turn) - len(content) - len("</s>\n") if learned else None,
                          len(content) if learned else None, visitor.attachments, visitor.tokens)
                for column, value in zip(rows, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows[0], pa.string()),
                 pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int32()),
                 pa.array(rows[3], attached), pa.array(rows[4], pa.int64())],
                names=["conv", "turn", "formatted", "loss_start", "loss_chars", "attachments",
                       "expanded_tokens"])

    chosen = conversations.select(conv_col, turn_col, role_col, parts_col or text_col)
    return chosen.mapInArrow(run, schema)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of every turn of a formatted string, unescaped."""
    return [(unescape(r), unescape(c)) for r, c in _TURN.findall(formatted)]


class _Digest:
    def __init__(self, conv):
        self.conv = conv
        self.turns, self.chars, self.loss = 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, length: int | None) -> None:
        self.chars += len(formatted)
        for role, content in parse_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            text = unescape(formatted[start:start + length])
            self.loss += len(text)
            self.learned.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss,
                self.learned.hexdigest(), self.chars)


def read_back(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Parse formatted turns again, in order, into one row per conversation.
    The turns of a conversation pass as a stream; only digests are held."""
    conv_type = turns.schema["conv"].dataType.simpleString()
    schema = (f"`{conv_col}` {conv_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Digest | None = None
        for batch in batches:
            done: list[tuple] = []
            for conv, text, start, length in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if open_ is None or conv != open_.conv:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = _Digest(conv)
                open_.add(text, start, length)
            yield _rows(done)
        if open_ is not None:
            yield _rows([open_.row()])

    names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    arrow_type = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}
    kinds = [arrow_type[f.split(" ")[1]] for f in schema.split(", ")]

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return (turns.repartition("conv").sortWithinPartitions("conv", "turn", "formatted")
            .select("conv", "formatted", "loss_start", "loss_chars").mapInArrow(run, schema))
