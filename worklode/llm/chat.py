"""Conversations as training text: typed content parts, turn marks, reversible escapes and a loss mask.

A turn is written ``### role: content</turn>`` and a line break.  A visitor goes over the parts of its content in order:
text is escaped, images, audio and documents become numbered placeholders ``<|image:1|>``, whose references and expanded
token counts are recorded.  In texts and roles, each backslash, each sign of ``###`` and the first sign of ``</turn>`` and
``<|`` get a backslash in front, so that no text can look like a mark, and taking one backslash off restores it.

Turns are sorted within partitions by conversation and streamed, so a conversation of any length is formatted with the
memory of one turn.
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

from worklode.llm.common import arrow_schema, blocks, map_batches, record_batch

HEAD, AFTER_ROLE, END = "### ", ": ", "</turn>"
PATCH = 28  # pixels of an image side that one token stands for
PER_SECOND = 25  # tokens of a second of audio
PER_PAGE = 256  # tokens of a document page
AROUND = 2  # begin and end tokens of an attachment

#: The type of the optional column with typed parts; a part has a kind and what that kind needs.
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_ATTACHMENT = "struct<number:int,kind:string,ref:string,start:bigint,tokens:bigint>"
SCHEMA = (
    "conv_id {id}, turn {turn}, formatted string, start bigint, loss array<struct<start:bigint,stop:bigint>>, "
    f"attachments array<{_ATTACHMENT}>, attachment_tokens bigint"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\#\\#\\#").replace(END, "\\" + END).replace("<|", "\\<|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


@dataclass
class Flatten:
    """Visitor of the content parts of a conversation: collects the pieces of the current turn."""

    number: int = 0  # attachments so far in the conversation
    at: int = 0  # code points so far in the conversation
    pieces: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)  # of texts
    attachments: list[dict] = field(default_factory=list)

    def put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        start = self.at
        self.put(escape(part.get("text") or ""))
        self.spans.append((start, self.at))

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, math.ceil((part.get(side) or 1) / PATCH)) for side in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part.get("seconds") or 0) * PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part.get("pages") or 1) * PER_PAGE)

    def visit_unknown(self, part: dict) -> None:
        """A kind that is not known keeps its place and reference, and no tokens but those around."""
        self.attach(re.sub(r"\W", "_", part["kind"]), part, 0)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.number += 1
        self.attachments.append({"number": self.number, "kind": kind, "ref": part.get("ref"), "start": self.at, "tokens": tokens + AROUND})
        self.put(f"<|{kind}:{self.number}|>")

    def turn(self, role: str | None, parts: list[dict]) -> tuple[str, int, list[tuple[int, int]], list[dict]]:
        """Formatted turn, its start, the loss mask (texts of the assistant) and its attachments."""
        self.pieces, self.spans, self.attachments = [], [], []
        start = self.at
        self.put(HEAD + escape(role or "").replace(":", "\\:") + AFTER_ROLE)
        for part in parts:
            self.visit(part)
        self.put(END + "\n")
        return "".join(self.pieces), start, self.spans if role == "assistant" else [], self.attachments


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None
) -> DataFrame:
    """One row per turn, in order within partitions; all turns of a conversation lie in one partition.

    Columns: ``conv_id``, ``turn``, ``formatted``, ``start`` (code points of the conversation before it), ``loss`` (spans of
    the conversation, in code points, that are trained on: escaped texts of the assistant), ``attachments`` (number, kind,
    reference, place, expanded tokens) and ``attachment_tokens``.  ``parts`` names a column of type ``PARTS``; where it is
    null or not given, the text is the only part.  Null texts and roles are empty.  Equal or null turns (these first) are
    ordered by role and text; rows without a conversation id form one conversation; an empty table gives an empty result.
    """
    content = F.col(parts).cast(PARTS) if parts else F.lit(None).cast(PARTS)
    rows = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"), content.alias("parts")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = SCHEMA.format(id=types["conv_id"], turn=types["turn"])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, flatten = (None, False), Flatten()
        for batch in batches:
            for columns in blocks(batch):
                out = []
                for conv_id, number, who, said, content in zip(*columns):
                    if (conv_id, True) != current:
                        current, flatten = (conv_id, True), Flatten()
                    made, start, loss, attachments = flatten.turn(who, content if content is not None else [{"text": said}])
                    spans = [{"start": a, "stop": b} for a, b in loss]
                    out.append((conv_id, number, made, start, spans, attachments, sum(a["tokens"] for a in attachments)))
                yield _batch(out, arrow)

    return map_batches(rows, run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return record_batch([list(c) for c in zip(*rows)] if rows else [[] for _ in schema], schema)


def find_mark(text: str, mark: str, at: int) -> int:
    """Where ``mark`` stands from ``at`` on without an escape, or -1."""
    while (at := text.find(mark, at)) >= 0:
        k = at
        while k and text[k - 1] == "\\":
            k -= 1
        if (at - k) % 2 == 0:
            return at
        at += 1
    return -1


class Reader:
    """Reads a formatted conversation back, piece by piece, from its marks alone, and its loss mask beside it."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, start: int, loss: list[dict]) -> None:
        for span in loss:
            text = unescape(piece[span["start"] - start : span["stop"] - start])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(piece)
        text, at = self.rest + piece, 0
        while True:
            end = find_mark(text, END + "\n", at)
            if end < 0:
                break
            colon = find_mark(text, ":", at)
            role, said = text[at + len(HEAD) : colon], text[colon + len(AFTER_ROLE) : end]
            self.all.update(f"{unescape(role)}\n{unescape(said)}\n".encode())
            self.turns += 1
            at = end + len(END) + 1
        self.rest = text[at:]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation of :func:`format_conversations`, read from the formatted text and the loss mask.

    Columns: ``conv_id``, ``n_turns``, ``turns_sha256`` (role, line break, text, line break per turn), ``loss_chars``,
    ``loss_sha256`` (unescaped text under the mask), ``formatted_chars``, ``attachment_tokens``.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, attachment_tokens long"
    )
    arrow = arrow_schema(schema)
    rows = formatted.select("conv_id", "formatted", "start", "loss", "attachment_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader, tokens = None, None, 0

        def result() -> tuple:
            if reader.rest:
                raise ValueError("a conversation ends within a turn")
            return (current, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars, tokens)

        for batch in batches:
            out = []
            for columns in blocks(batch):
                for conv_id, piece, start, loss, more in zip(*columns):
                    if reader is None or conv_id != current:
                        if reader is not None:
                            out.append(result())
                        current, reader, tokens = conv_id, Reader(), 0
                    reader.feed(piece, start, loss)
                    tokens += more
            yield _batch(out, arrow)
        if reader is not None:
            yield _batch([result()], arrow)

    return map_batches(rows, run, schema)
