"""Chat formatting with typed content parts.

A visitor walks over the parts of each message and flattens them in order: text is escaped, an image, audio or document part
becomes a numbered placeholder, and its reference, kind, place and expanded token count are recorded beside the text. Control
strings and the escape character inside texts, roles and references are escaped, so the formatted text can be read back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Strings that may not stand in a text as they are: the template's own marks and those of other common templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(END), re.DOTALL)
_PLACE = re.compile(r"<\|(image|audio|document):(\d+):(\d+)\|>")
#: Tokens that one attachment stands for where the part states no size.
TOKENS = {"image": 256, "audio": 128, "document": 512}
PART = "struct<type:string,text:string,ref:string,tokens:int>"
FORMATTED = (
    "conv_id long, formatted string, loss_spans array<struct<start:long,stop:long>>, "
    "attachments array<struct<kind:string,ref:string,at:long,tokens:long>>, n_turns long"
)


def escape(text: str) -> str:
    """Backslashes doubled, then one put after the first character of each control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Visitor:
    """Flattens the messages of one conversation."""

    def __init__(self):
        self.out: list[str] = []
        self.length = self.turns = 0
        self.spans: list[dict] = []
        self.attachments: list[dict] = []

    def put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def message(self, role: str | None, parts: list[dict] | None) -> None:
        self.turns += 1
        self.put(f"{TURN}{escape(role or '')}{BODY}")
        for part in parts or ():
            if part is not None:
                getattr(self, f"visit_{part['type']}", self.visit_text)(part, role == "assistant")
        self.put(END)

    def visit_text(self, part: dict, learnt: bool) -> None:
        start = self.length
        self.put(escape(part["text"] or ""))
        if learnt and self.length > start:
            self.spans.append({"start": start, "stop": self.length})

    def _attached(self, kind: str, part: dict) -> None:
        tokens = TOKENS[kind] if part["tokens"] is None else max(0, part["tokens"])
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.length, "tokens": tokens})
        self.put(f"<|{kind}:{len(self.attachments) - 1}:{tokens}|>")

    def visit_image(self, part: dict, learnt: bool) -> None:
        self._attached("image", part)

    def visit_audio(self, part: dict, learnt: bool) -> None:
        self._attached("audio", part)

    def visit_document(self, part: dict, learnt: bool) -> None:
        self._attached("document", part)


def turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn, read back from a formatted conversation; placeholders are left in the text as they are."""
    return [(unescape(m[1]), _unescaped_body(m[2])) for m in _TURN.finditer(formatted)]


def _unescaped_body(body: str) -> str:
    out, at = [], 0
    for m in _PLACE.finditer(body):
        out += [unescape(body[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, unescape(body[at:])])


def format_chats(messages: DataFrame) -> DataFrame:
    """Conversations from rows of conv_id, turn, role and parts (an array of typed parts): see FORMATTED for the columns.

    Rows are dealt out by conversation and sorted in their partition, so a conversation streams through its task turn by
    turn. Equal turn numbers are ordered by role and content; a null turn comes first, a null conv_id is a conversation of
    its own, null parts are no content, an unknown part type is read as text. An empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, visitor, done = None, None, []

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(done, schema=schema)
            done.clear()
            return made

        held = 0
        for batch in batches:
            for row in batch.to_pylist():
                if visitor is None or row["conv_id"] != now:
                    if visitor is not None:
                        done.append(_row(now, visitor))
                        held += visitor.length
                    now, visitor = row["conv_id"], Visitor()
                visitor.message(row["role"], row["parts"])
            if held > T.CHUNK_BYTES:
                yield flushed()
                held = 0
        if visitor is not None:
            done.append(_row(now, visitor))
        if done:
            yield flushed()

    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    attached = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", span), ("attachments", attached), ("n_turns", pa.int64())])
    return (
        messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.col("parts").cast(f"array<{PART}>").alias("parts"))
        .repartition(T.partitions(messages.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "parts")
        .mapInArrow(run, FORMATTED)
    )


def _row(conv_id, visitor: Visitor) -> dict:
    return {"conv_id": conv_id, "formatted": "".join(visitor.out), "loss_spans": visitor.spans, "attachments": visitor.attachments, "n_turns": visitor.turns}


def text_messages(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role and text as messages of one text part (null text: empty)."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"))
    return rows.select("conv_id", "turn", "role", F.array(part).alias("parts"))
