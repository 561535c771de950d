"""Chat formatting of typed content parts.

A turn's content is an ordered list of parts (text, image, audio, document).
A visitor flattens them into the template's text: text is escaped, every other
part becomes a placeholder of its kind repeated once per expanded token, and
its reference is recorded with the place of its placeholder.  The template is

    <|im_start|>ROLE \\n CONTENT <|im_end|> \\n

Inside texts and roles every ``<`` + backslashes + ``|`` gets one backslash
more, so no text holds a control string and unescaping takes exactly that
backslash away; in roles backslashes and line ends are escaped besides.

Rendering is per turn and needs no shuffle.  A conversation is the
concatenation of its turns' segments in order, so one of any length never has
to fit into a row or a task: offsets and the read-back are computed by
streaming over the sorted segments.

Defined cases: null text is empty, a null role is the empty role; turns that
tie are ordered by role and text, null turns come first; a part of unknown
type is text; a null or negative token count is 0; rows with a null conv_id
are one conversation of their own; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts

# --- fixed values: the template ---------------------------------------------
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image_pad|>", "audio": "<|audio_pad|>", "document": "<|document_pad|>"}
LOSS_ROLE = "assistant"
# ------------------------------------------------------------------------------

PART = "struct<type:string,text:string,ref:string,tokens:int>"
SEGMENT = ("rendered string, loss_from long, loss_to long, "
           "attachments array<struct<kind:string,ref:string,at:long,tokens:int>>, placeholder_tokens long")

_RAW = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visitor over the parts of one turn."""

    def __init__(self):
        self.out, self.size, self.attachments, self.placeholder_tokens = [], 0, [], 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)
        self.visit_text(part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = max(0, part.get("tokens") or 0)
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "at": self.size, "tokens": tokens})
        self.placeholder_tokens += tokens
        self._add(PLACEHOLDERS[kind] * tokens)

    def _add(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)


def render(role: str | None, parts: list[dict] | None) -> dict:
    """One turn's segment; offsets are code points from its start."""
    flat = Flattener()
    for part in parts or ():
        if part is not None:
            flat.visit(part)
    head = f"{START}{escape_role(role or '')}\n"
    for a in flat.attachments:
        a["at"] += len(head)
    loss = role == LOSS_ROLE
    return {"rendered": f"{head}{''.join(flat.out)}{END}\n", "loss_from": len(head) if loss else None,
            "loss_to": len(head) + flat.size if loss else None, "attachments": flat.attachments,
            "placeholder_tokens": flat.placeholder_tokens}


def text_part(text: Column) -> Column:
    """A plain text as the only part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")).cast(PART))


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of ``turns`` (conv_id, turn, role, parts): the keys, then
    rendered, loss_from, loss_to, attachments and placeholder_tokens."""
    segment = pa.struct([("rendered", pa.string()), ("loss_from", pa.int64()), ("loss_to", pa.int64()),
                         ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int32())]))),
                         ("placeholder_tokens", pa.int64())])

    def run(batches):
        for batch in batches:
            made = [render(r, p) for r, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            cols = pa.array(made, segment).flatten()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *cols],
                                             names=["conv_id", "turn", "role", *(f.name for f in segment)])

    return (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                         F.col("parts").cast(f"array<{PART}>"))
            .mapInArrow(run, f"conv_id long, turn long, role string, {SEGMENT}"))


def _in_order(segments: DataFrame) -> DataFrame:
    return (segments.repartition(shuffle_parts(segments.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "rendered"))


class _Reader:
    """Reads one conversation back from its formatted text, piece by piece."""

    def __init__(self):
        self.rest, self.turns, self.loss_chars, self.chars = "", 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss_from, loss_to) -> None:
        self.chars += len(text)
        self.rest += text
        at = 0
        for m in _TURN.finditer(self.rest):
            if m.start() != at:
                raise ValueError("formatted text does not follow the template")
            self.turn_hash.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
            self.turns, at = self.turns + 1, m.end()
        self.rest = self.rest[at:]
        if loss_from is not None:
            own = unescape(text[loss_from:loss_to])
            self.loss_chars += len(own)
            self.loss_hash.update(own.encode())

    def row(self, conv_id):
        if self.rest:
            raise ValueError("formatted text ends inside a turn")
        return conv_id, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of every conversation, from its formatted text and mask."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)

    def run(batches):
        reader, current = None, None
        for batch in batches:
            done = []
            for conv, text, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if reader is None or conv != current:
                    if reader is not None:
                        done.append(reader.row(current))
                    reader, current = _Reader(), conv
                reader.feed(text, a, b)
            yield rows_batch(done)
        if reader is not None:
            yield rows_batch([reader.row(current)])

    return (_in_order(segments).select("conv_id", "rendered", "loss_from", "loss_to")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def with_offsets(segments: DataFrame) -> DataFrame:
    """Segments with ``start``, the code points of the conversation before."""
    fields = [f.name for f in segments.schema]

    def run(batches):
        current, at, fresh = None, 0, True
        for batch in batches:
            starts = []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column("rendered").to_pylist()):
                if fresh or conv != current:
                    current, at, fresh = conv, 0, False
                starts.append(at)
                at += len(text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.int64())], names=[*fields, "start"])

    return _in_order(segments).mapInArrow(run, f"conv_id long, turn long, role string, {SEGMENT}, start long")
