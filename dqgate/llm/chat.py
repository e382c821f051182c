"""Chat formatting: typed content parts flattened into one marked text per conversation.

A turn is a role and a list of typed parts.  A visitor has one method per kind of part: text
is written with its control strings escaped, an image, audio or document part becomes a
placeholder in its place, and its reference and the tokens it expands to are recorded in the
order of the placeholders.  The text of assistant turns is under the loss mask, as spans of
code points; markers and placeholders are not.

Escaping puts a backslash after the first character of every control string, one more
where there are some already; taking one away restores the text, whatever it was.

Turns are dealt by conversation and stream through a task in order, and leave it in pieces
of about ``PIECE_CHARS`` (a single longer turn is one piece), so that memory does not grow
with a conversation.  One conversation is read by one task, as its digest needs all of it.

Defined results: turns come by number, then role, then parts, NULL numbers last; repeated
rows are repeated turns; a NULL role, text or list of parts is empty; a NULL conversation id
is a conversation of its own; parts of unknown kinds become files of one token; sizes that are
not known, or not above zero, expand to one token; no rows give no conversations; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Code points of a piece, at least, unless the conversation ends.
PIECE_CHARS = 1 << 20

#: A content part: ``kind`` is text, image, audio or document; the other fields as they apply.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
LOSS = "array<struct<start:bigint,end:bigint>>"
ATTACHMENTS = "array<struct<turn:bigint,kind:string,ref:string,tokens:bigint>>"


@dataclass(frozen=True)
class Template:
    """Markers, and how many tokens attachments expand to.

    Every ``<|name|>`` is a control string, and so are ``controls``, each of which has one of
    the characters ``<`` and ``[``, as its first.
    """

    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    patch_pixels: int = 28
    audio_tokens: int = 25
    page_tokens: int = 512

    def __post_init__(self) -> None:
        for control in self.controls:
            if len(control) < 2 or control[0] not in "<[" or re.search(r"[<\[]", control[1:]):
                raise ValueError(f"not a control string that can be escaped: {control!r}")

    @property
    def _tails(self) -> str:
        tails = {"<": [r"\|[A-Za-z0-9_]+\|>"], "[": []}
        for control in self.controls:
            tails[control[0]].append(re.escape(control[1:]))
        return "|".join(rf"(?<={re.escape(c)})%s(?=\\*(?:{'|'.join(t)}))" for c, t in tails.items() if t)

    def escaping(self) -> tuple[Callable[[str], str], Callable[[str], str]]:
        """Functions that escape and unescape a text."""
        into = re.compile(self._tails.replace("%s", ""))
        out_of = re.compile(self._tails.replace("%s", r"\\"))
        return (lambda text: into.sub("\\\\", text)), (lambda text: out_of.sub("", text))


START, SAYS, PART_END, END = "<|start|>", "<|says|>", "<|part|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "file": "<|file|>"}
_MARKS = re.compile("|".join(re.escape(m) for m in (START, SAYS, PART_END, END, *PLACEHOLDERS.values())))


@dataclass
class Flat:
    """A turn as text, with spans under the loss mask and attachments."""

    pieces: list[str] = field(default_factory=list)
    length: int = 0
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[str, str | None, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


class Flattener:
    """Visits the parts of a turn in order."""

    def __init__(self, template: Template) -> None:
        self.template = template
        self.escape, _ = template.escaping()

    def turn(self, role: str | None, parts: list[dict] | None) -> Flat:
        flat = Flat()
        role = role or ""
        flat.write(START + self.escape(role) + SAYS)
        for i, part in enumerate(p for p in parts or () if p is not None):
            if i:
                flat.write(PART_END)
            visit = getattr(self, f"visit_{part['kind']}", None) if part["kind"] in _KINDS else self.visit_file
            visit(flat, part, role in self.template.loss_roles)
        flat.write(END)
        return flat

    def visit_text(self, flat: Flat, part: dict, under_loss: bool) -> None:
        text = self.escape(part["text"] or "")
        if under_loss and text:
            flat.loss.append((flat.length, flat.length + len(text)))
        flat.write(text)

    def visit_image(self, flat: Flat, part: dict, under_loss: bool) -> None:
        across, down = (math.ceil(max(part[n] or 0, 0) / self.template.patch_pixels) for n in ("width", "height"))
        self._attach(flat, part, "image", across * down)

    def visit_audio(self, flat: Flat, part: dict, under_loss: bool) -> None:
        seconds = part["seconds"] or 0.0
        known = math.isfinite(seconds) and seconds > 0
        self._attach(flat, part, "audio", math.ceil(seconds * self.template.audio_tokens) if known else 1)

    def visit_document(self, flat: Flat, part: dict, under_loss: bool) -> None:
        self._attach(flat, part, "document", (part["pages"] or 0) * self.template.page_tokens)

    def visit_file(self, flat: Flat, part: dict, under_loss: bool) -> None:
        self._attach(flat, part, "file", 1)

    def _attach(self, flat: Flat, part: dict, kind: str, tokens: int) -> None:
        flat.attachments.append((kind, part["ref"], max(1, tokens)))
        flat.write(PLACEHOLDERS[kind])


_KINDS = frozenset({"text", "image", "audio", "document"})


def text_messages(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parts`` of a table with one ``text`` a turn."""
    nothing = {name: F.lit(None).cast(kind) for name, kind in (f.split(":") for f in PART[7:-1].split(","))}
    nothing |= {"kind": F.lit("text"), "text": F.coalesce("text", F.lit(""))}
    part = F.struct(*[value.alias(name) for name, value in nothing.items()])
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def in_order(messages: DataFrame) -> DataFrame:
    """Turns dealt by conversation, and in order within it."""
    rows = messages.select("conv_id", "turn", "role", F.col("parts").cast(f"array<{PART}>").alias("parts"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "parts")


def format_conversations(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, piece, n_turns, formatted, loss, attachments, expanded_tokens`` in pieces.

    The pieces of a conversation, in order, are its formatted text.  Spans count from the
    start of their piece; ``n_turns`` and ``expanded_tokens`` are those of the piece, and an attachment
    names its turn by position in the conversation.
    """
    kind = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flattener, out = Flattener(template), _Pieces()
        for batch in batches:
            for conv, role, parts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "parts"))):
                if out.add(conv, flattener.turn(role, parts)):
                    yield out.batch(schema)
        out.close()
        yield out.batch(schema)

    ddl = (
        f"conv_id {kind}, piece int, n_turns bigint, formatted string, loss {LOSS}, attachments {ATTACHMENTS},"
        " expanded_tokens bigint"
    )
    schema = _arrow(messages, ddl)
    return in_order(messages).mapInArrow(run, ddl)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class _Pieces:
    """Turns gathered into pieces, and pieces into batches of output."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.waiting = 0
        self.row: dict | None = None
        self.conv: object = None
        self.turns = 0

    def add(self, conv: object, flat: Flat) -> bool:
        """Whether enough is waiting to be sent."""
        if self.row is None or conv != self.conv:
            self.close()
            self.conv, self.turns = conv, 0
            self._open(0)
        elif self.row["length"] >= PIECE_CHARS:
            number = self.row["piece"] + 1
            self.close()
            self._open(number)
        row, at = self.row, self.row["length"]
        row["parts"] += flat.pieces
        row["length"] += flat.length
        row["n_turns"] += 1
        row["loss"] += [{"start": at + s, "end": at + e} for s, e in flat.loss]
        row["attachments"] += [{"turn": self.turns, "kind": k, "ref": r, "tokens": n} for k, r, n in flat.attachments]
        row["expanded_tokens"] += sum(n for _, _, n in flat.attachments)
        self.turns += 1
        return self.waiting >= PIECE_CHARS

    def _open(self, number: int) -> None:
        self.row = {"conv_id": self.conv, "piece": number, "n_turns": 0, "parts": [], "length": 0, "loss": [],
                    "attachments": [], "expanded_tokens": 0}

    def close(self) -> None:
        if self.row is not None:
            self.waiting += self.row.pop("length")
            self.row["formatted"] = "".join(self.row.pop("parts"))
            self.rows.append(self.row)
            self.row = None

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.rows, self.waiting = self.rows, [], 0
        return pa.RecordBatch.from_pylist(rows, schema=schema)


def parsed_turns(formatted: str, template: Template = Template()) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of each turn of a piece; a part is (kind, text).

    A turn without parts reads back as one empty text.
    """
    _, unescape = template.escaping()
    kinds = {mark: kind for kind, mark in PLACEHOLDERS.items()}
    role, parts, at, open_text = "", [], 0, True
    for mark in _MARKS.finditer(formatted):
        before, name, at = formatted[at : mark.start()], mark.group(), mark.end()
        if name == START:
            role, parts, open_text = "", [], True
        elif name == SAYS:
            role = unescape(before)
        elif name in kinds:
            parts.append((kinds[name], ""))
            open_text = False
        else:
            if open_text:
                parts.append(("text", unescape(before)))
            open_text = True
            if name == END:
                yield role, parts


def read_back(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from its formatted pieces alone: counts and digests.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, expanded_tokens``.
    ``turns_sha256`` is over role, newline, text, newline of each turn; ``loss_sha256`` over the unescaped
    text of the spans.  ``pieces`` are as :func:`format_conversations` returns them, in order within a partition;
    of a stored table use :func:`stored_in_order` first.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    ddl = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint, n_attachments bigint, expanded_tokens bigint"
    )
    schema = _arrow(pieces, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unescape = template.escaping()
        found, done = None, []
        for batch in batches:
            names = ("conv_id", "piece", "formatted", "loss", "attachments", "expanded_tokens")
            for conv, piece, text, loss, attached, tokens in zip(*(batch.column(c).to_pylist() for c in names)):
                if piece == 0:
                    done += [] if found is None else [_digest(found)]
                    found = {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0,
                             "loss": hashlib.sha256(), "formatted_chars": 0, "n_attachments": 0, "expanded_tokens": 0}
                for role, parts in parsed_turns(text, template):
                    said = "".join(t for k, t in parts if k == "text")
                    found["turns"].update(f"{role}\n{said}\n".encode())
                    found["n_turns"] += 1
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    found["loss"].update(said.encode())
                    found["loss_chars"] += len(said)
                found["formatted_chars"] += len(text)
                found["n_attachments"] += len(attached)
                found["expanded_tokens"] += tokens
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        done += [] if found is None else [_digest(found)]
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    return pieces.mapInArrow(run, ddl)


def _digest(found: dict) -> dict:
    return {**found, "turns_sha256": found.pop("turns").hexdigest(), "loss_sha256": found.pop("loss").hexdigest()}


def stored_in_order(pieces: DataFrame) -> DataFrame:
    """Stored pieces dealt by conversation again, and in order."""
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
