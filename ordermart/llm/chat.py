"""Chat formatting of typed content parts, with a loss mask and its way back.

A turn is a list of parts (``text``, ``image``, ``audio``, ``document``).  A
visitor flattens them in order: text is escaped, any other part becomes a
placeholder and an attachment record (reference, place, expanded tokens).  The
template of a turn is ``### role: content</turn>`` and a line feed.

Escaping puts a backslash before every backslash, ``<``, ``#`` and (in roles)
``:``, so that neither a turn mark nor a placeholder can arise from a text, and
dropping those backslashes gives the text back exactly.

The formatted conversation is the pieces of its turns, one row each, joined in
order; the loss mask of a piece is a span of its code points (the content of
assistant turns).  Turns of a conversation are sorted, never gathered: memory
is one batch, also if one conversation holds most rows.

Defined results: a null or empty text is an empty content, a null role an empty
role; turns of equal number are ordered by role and text, null turns come
first; repeated rows are repeated turns; a null conversation id is a
conversation of its own; an empty table gives no rows.  An unknown or null part
type raises a ValueError.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"
#: tokens that a part expands to where it doesn't say so itself
EXPANDS = {"image": 256, "audio": 128, "document": 512}
_TEXT, _ROLE, _BACK = re.compile(r"[\\<#]"), re.compile(r"[\\<#:]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.S)
PIECES = ("conv_id long, position long, turn long, role string, formatted string, loss_start long, loss_end long, "
          "tokens long, attachments array<struct<type:string,ref:string,place:long,tokens:long>>")
PIECE_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("tokens", pa.int64()),
    ("attachments", pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()),
                                        ("place", pa.int64()), ("tokens", pa.int64())])))])
BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_attachments long, tokens long")


def escape(text: str) -> str:
    return _TEXT.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of a turn; ``visit_<type>`` takes one part."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []
        self.length = self.tokens = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type']}", self.visit_unknown)(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit_text(self, part: dict) -> None:
        text = escape(part.get("text") or "")
        self._put(text)
        self.tokens += len(text.split())

    def _attach(self, part: dict) -> None:
        n = part.get("tokens")
        n = EXPANDS.get(part["type"], 0) if n is None else n
        self.attachments.append({"type": part["type"], "ref": part.get("ref"), "place": self.length, "tokens": n})
        self._put(f"<{part['type']}|{len(self.attachments) - 1}|{n}>")
        self.tokens += n

    visit_image = visit_audio = visit_document = _attach

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"unknown part type {part['type']!r}")


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", parts: str | None = None) -> DataFrame:
    """Formatted pieces of each conversation, in order within a partition.

    ``parts`` names a column array<struct<type,text,ref,tokens>>; without one,
    a turn is its ``text`` as a single part."""
    cols = [F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text") if text else F.lit("").alias("text")]
    if parts:
        cols.append(F.col(parts).alias("parts"))
    rows = turns.select(*cols).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, position = object(), 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv_id"] != conv_id:
                    conv_id, position = r["conv_id"], 0
                visitor = PartVisitor()
                for part in r["parts"] or [] if "parts" in r else [{"type": "text", "text": r["text"]}]:
                    visitor.visit(part)
                head = HEAD + _ROLE.sub(r"\\\g<0>", r["role"]) + MIDDLE
                masked = r["role"] == LOSS_ROLE
                out.append({
                    "conv_id": conv_id, "position": position, "turn": r["turn"], "role": r["role"],
                    "formatted": head + "".join(visitor.out) + TAIL,
                    "loss_start": len(head) if masked else None,
                    "loss_end": len(head) + visitor.length if masked else None, "tokens": visitor.tokens,
                    "attachments": [a | {"place": a["place"] + len(head)} for a in visitor.attachments]})
                position += 1
            yield pa.RecordBatch.from_pylist(out, schema=PIECE_SCHEMA)

    return rows.mapInArrow(work, PIECES)


class _Conversation:
    """Reads a conversation's formatted text as it comes, piece by piece."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.buffer = conv_id, ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_attachments = self.tokens = 0

    def feed(self, piece: dict) -> None:
        text = piece["formatted"]
        if piece["loss_start"] is not None:
            said = unescape(text[piece["loss_start"]:piece["loss_end"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)
        self.n_attachments += len(piece["attachments"] or [])
        self.tokens += piece["tokens"]
        self.buffer += text
        at = 0
        while m := _TURN.match(self.buffer, at):
            self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            self.n_turns, at = self.n_turns + 1, m.end()
        self.buffer = self.buffer[at:]

    def result(self) -> dict:
        if self.buffer:
            raise ValueError(f"conversation {self.conv_id}: text after the last turn")
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
                "n_attachments": self.n_attachments, "tokens": self.tokens}


def read_back(pieces: DataFrame) -> DataFrame:
    """One row a conversation, read from its formatted text and loss mask alone.

    Takes ``format_turns`` as it is, or its stored pieces dealt by conversation
    and sorted by position."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if k == "string" else pa.int64())
                            for n, k in (f.split() for f in BACK.split(", "))])
        now = None
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                if now is None or piece["conv_id"] != now.conv_id or piece["position"] == 0:
                    if now:
                        out.append(now.result())
                    now = _Conversation(piece["conv_id"])
                now.feed(piece)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now:
            yield pa.RecordBatch.from_pylist([now.result()], schema=schema)

    return pieces.mapInArrow(work, BACK)
