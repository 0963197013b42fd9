"""Chat formatting from an event log.

A log holds what happened to a conversation: a message starts, deltas stream in, a
message is edited, a message is generated anew. The log is dealt by conversation,
sorted by sequence and folded into the final messages, which are rendered with a
template whose control strings can't occur in a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
DELTA_CHARS = 256

#: What an event does to its message: ``start`` opens it with a role, ``delta`` appends,
#: ``edit`` puts a text in place of all before, ``regenerate`` empties it and takes all later messages away.
KINDS = ("start", "delta", "edit", "regenerate")

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    """The text without a control string: one backslash more between each ``<`` and ``|``."""
    return _CONTROL.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(messages: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code point ranges of the texts to train on."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts out of a formatted conversation."""
    return [(_unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


class Fold:
    """The state of one conversation while its events come in."""

    def __init__(self) -> None:
        self.messages: dict[int, tuple[str, list[str]]] = {}

    def apply(self, message: int, kind: str, role: str | None, text: str | None) -> None:
        own_role, parts = self.messages.get(message, ("", []))
        if kind == "start":
            parts = [text] if text else []
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts = [text or ""]
        elif kind == "regenerate":
            parts = [text] if text else []
            for later in [m for m in self.messages if m > message]:
                del self.messages[later]
        else:
            raise ValueError(f"unknown kind of event: {kind!r}")
        self.messages[message] = (own_role if role is None else role, parts)

    def final(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for _, (role, parts) in sorted(self.messages.items())]


def events_of(turns: DataFrame) -> DataFrame:
    """The log of conversations given as rows ``(conv_id, turn, role, text)``: a start and streamed deltas per row.

    Rows of equal turn follow each other by role and text, null turns first; repeated rows
    are messages of their own. A null role is an empty one.
    """
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = turns.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), "text", F.row_number().over(ordered).cast("bigint").alias("message"))
    pieces = F.expr(f"transform(sequence(0, cast((length(text) - 1) div {DELTA_CHARS} as int)), i -> substring(text, i * {DELTA_CHARS} + 1, {DELTA_CHARS}))")
    texts = F.when(F.length("text") > 0, pieces).otherwise(F.array().cast("array<string>"))
    opened = F.concat(F.array(F.lit(None).cast("string")), texts)
    rows = numbered.select("conv_id", "message", "role", F.posexplode(opened).alias("i", "text"))
    return rows.select(
        "conv_id",
        F.shiftleft("message", 32).bitwiseOR(F.col("i")).alias("seq"),
        "message",
        F.when(F.col("i") == 0, "start").otherwise("delta").alias("kind"),
        F.when(F.col("i") == 0, F.col("role")).alias("role"),
        "text",
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss`` (ranges of code points) per conversation of a log.

    The log's rows are ``(conv_id, seq, message, kind, role, text)``; messages are ordered by
    ``message``. Events of equal ``seq`` apply by message, kind, role and text, nulls first. A
    delta to a message that never started opens it with an empty role; a null text is an
    empty one. Rows without a conversation are one conversation, whose id is null. An empty
    log gives no rows. A task streams through its conversations and holds one at a time,
    which is also the size of one result.
    """
    kind = events.schema["conv_id"].dataType
    log = events.select("conv_id", F.col("seq").cast("bigint").alias("seq"), F.col("message").cast("bigint").alias("message"), "kind", "role", "text")
    dealt = log.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "message", "kind", "role", "text")
    schema = T.StructType([T.StructField("conv_id", kind)]).add("formatted", T.StringType()).add("loss", T.ArrayType(T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Fold | None = None
        current, done = None, []

        def out(conv_type: pa.DataType) -> pa.RecordBatch:
            made = [render(messages) for _, messages in done]
            ids = pa.array([c for c, _ in done], conv_type)
            done.clear()
            return pa.RecordBatch.from_arrays([ids, pa.array([t for t, _ in made], pa.string()), pa.array([[list(s) for s in spans] for _, spans in made], pa.list_(pa.list_(pa.int64())))], names=["conv_id", "formatted", "loss"])

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            columns = (batch[c].to_pylist() for c in ("conv_id", "message", "kind", "role", "text"))
            for conv, message, what, role, text in zip(*columns, strict=True):
                if state is None or conv != current:
                    if state is not None:
                        done.append((current, state.final()))
                    state, current = Fold(), conv
                state.apply(message, what, role, text)
            if done:
                yield out(conv_type)
        if state is not None:
            done.append((current, state.final()))
            yield out(conv_type)

    return dealt.mapInArrow(run, schema)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from them: turns and the texts under the loss mask."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["formatted"].to_pylist(), batch["loss"].to_pylist(), strict=True):
                turns = read_back(text)
                whole, loss = sha256(), [unescape(text[a:b]) for a, b in spans]
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                trained = sha256("".join(loss).encode())
                rows.append((len(turns), whole.hexdigest(), sum(map(len, loss)), trained.hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch["conv_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
