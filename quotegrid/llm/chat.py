"""Chat formatting with typed content parts, and reading the output back.

A turn is formatted by a visitor with one method for each kind of part: text, image, audio, document.
Parts become text and placeholders in their order; each placeholder's attachment is recorded with
the place it stands at and the tokens it will expand to. Marks of the template, and other control
strings, are broken up inside texts by a backslash and backslashes are doubled, so that no text can
open or close a turn and every text can be read back.

The output is one row per turn, in the order of its conversation, and a conversation's text is its
turns one after the other: no conversation is built in memory, however many turns it has. Reading
back goes through a conversation's turns in order, a batch at a time. As SHA-256 has to see a
conversation from its start to its end, one task reads each conversation, but holds one batch of it.

Defined results: a null role or text is empty; turns of one number are ordered by role, then formatted text; a
null turn comes first; a null conversation id is a conversation; unknown kinds of parts raise.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import width

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Strings that mean something to this template or to common chat models.
CONTROL = [
    OPEN,
    "<|im_end|>",
    *PLACEHOLDERS.values(),
    "<|endoftext|>",
    "<s>",
    "</s>",
    "<unk>",
    "<pad>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
]
_BREAK = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")
_HEAD = re.compile(re.escape(OPEN) + r"((?:[^\\\n]|\\[\s\S])*)\n")


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first character of each control string."""
    return _BREAK.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


@dataclass(frozen=True)
class TokenRule:
    """Tokens that a placeholder expands to."""

    image_patch: int = 28  # pixels along a side of the square one token stands for
    audio_per_second: float = 12.5
    document_per_page: int = 1024


@dataclass
class PartVisitor:
    """Flattens the parts of one turn."""

    rule: TokenRule = TokenRule()
    out: list[str] = field(default_factory=list)
    at: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict[str, Any]) -> None:
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        method(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        ref = part.get("uri") or ""
        self.attachments.append({"kind": kind, "ref": ref, "at": self.at, "tokens": max(1, tokens)})
        self._put(PLACEHOLDERS[kind])

    def visit_text(self, part: dict) -> None:
        self._put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        side = self.rule.image_patch
        wide, high = (math.ceil((part.get(k) or side) / side) for k in ("width", "height"))
        self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0) * self.rule.audio_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 1) * self.rule.document_per_page)


PARTS = "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = (
    "conv_id long, turn long, role string, formatted string, loss_start int, loss_end int,"
    " attachments array<struct<kind:string,ref:string,at:int,tokens:int>>, expanded_tokens long"
)
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("formatted", pa.string()),
        ("loss_start", pa.int32()),
        ("loss_end", pa.int32()),
        (
            "attachments",
            pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int32())])),
        ),
        ("expanded_tokens", pa.int64()),
    ]
)


def format_turn(role: str, parts: list[dict], rule: TokenRule = TokenRule()) -> tuple[str, int, int, list[dict]]:
    """The turn's text, the span under the loss mask in it (empty unless the role is assistant), attachments."""
    v = PartVisitor(rule)
    v._put(OPEN + escape_role(role) + "\n")
    start = v.at
    for part in parts:
        v.visit(part)
    end = v.at if role == "assistant" else start
    v._put(CLOSE)
    return "".join(v.out), start, end, v.attachments


def format_turns(turns: DataFrame, rule: TokenRule = TokenRule()) -> DataFrame:
    """One formatted row per turn, where the turns lie: nothing is shuffled.

    Takes conv_id, turn, role and ``text``, or ``parts`` (see ``PARTS``) instead of it.
    """
    parts = "parts" in turns.columns
    content = F.col("parts").cast(PARTS) if parts else F.col("text")
    rows = turns.select("conv_id", "turn", "role", content.alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                role, c = r["role"] or "", r["content"]
                text, start, end, refs = format_turn(role, (c or []) if parts else [{"text": c}], rule)
                spent = sum(a["tokens"] for a in refs)
                out.append((r["conv_id"], r["turn"], role, text, start, end, refs, spent))
            cols = list(zip(*out, strict=True)) if out else [[]] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types, strict=True)], schema=_ARROW)

    return rows.mapInArrow(run, FORMATTED)


def in_order(formatted: DataFrame) -> DataFrame:
    """Each conversation in one partition, its turns in order: the partitions are the output files."""
    dealt = formatted.repartition(width(formatted.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "formatted")


def parse_turn(formatted: str) -> tuple[str, str, int]:
    """Role, escaped body, and where the body starts."""
    head = _HEAD.match(formatted)
    if not head or not formatted.endswith(CLOSE):
        raise ValueError("this is no formatted turn")
    return unescape(head[1]), formatted[head.end() : -len(CLOSE)], head.end()


class _Reader:
    """What is read back of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, formatted: str, loss_start: int, loss_end: int) -> None:
        role, body, _ = parse_turn(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.said.update(f"{role}\n{unescape(body)}\n".encode())
        masked = unescape(formatted[loss_start:loss_end])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses the formatted turns again and returns a row per conversation, see ``READ``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Reader | None = None
        for batch in batches:
            rows = []
            for conv_id, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now:
                        rows.append(now.row())
                    now = _Reader(conv_id)
                now.take(*turn)
            yield _read_batch(rows)
        yield _read_batch([now.row()] if now else [])

    return in_order(formatted).select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, READ)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    names = [c.split()[0] for c in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def parts_of_json(column: str):
    """Typed parts from a JSON string, as chat logs keep them."""
    return F.from_json(F.col(column), PARTS)

