"""Chat logs folded into final messages, and rendered with a reversible template and a loss mask.

Events of a conversation, in the order of ``seq``, each of one message:

    start       the message begins; its place in the conversation is that of its first event
    delta       text is appended
    edit        the text is replaced
    regenerate  the text so far is thrown away, later deltas build it anew

The role is the last one given.  A message's events meet, sorted by sequence, wherever its own log
fits: conversations of any length are never gathered, and the log of one message is as long as what was
streamed for it.  Rendering is one row per message; a conversation's text is its messages' rows in order.

    <|im_start|>role
    text<|im_end|>

Inside roles and texts, ``<|`` gets a backslash in the middle, and one that has some already gets one
more, so no text can hold a control string and every text can be had back; a role's own line ends and
backslashes are written ``\\n`` and ``\\\\``.  The loss mask covers each assistant text, without its marks.

Null texts, roles and kinds of event other than these count as '' or deltas.  Null conversation ids
are one conversation, null places come first.  Events that tie in ``seq`` go by kind, then text; repeated
events are events of their own.  Other columns aren't looked at, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of each message, from (conv_id, message, seq, kind, role, text).

    ``message`` names a message in its conversation; ``seq`` can be of any sortable type.
    """
    reset = F.col("kind").isin("edit", "regenerate")
    log = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("place"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("last_role"),
        F.max(F.when(reset, F.struct("seq", "kind"))).alias("reset"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")))).alias("log"),
    )
    valid = F.filter(
        "log",
        lambda e: (F.col("reset").isNull() | (F.struct(e["seq"], e["kind"]) >= F.col("reset")))
        & ~e["kind"].eqNullSafe("regenerate"),
    )
    return log.select(
        "conv_id",
        "place",
        F.coalesce("last_role.role", F.lit("")).alias("role"),
        F.array_join(F.transform(valid, lambda e: e["text"]), "").alias("text"),
    )


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _role_unescaped(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, place, segment, loss_start, loss_end): the mask in code points of the segment, or nulls."""
    role = _escaped(F.replace(F.replace("role", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = _escaped(F.coalesce("text", F.lit("")))
    learned = F.col("role") == LEARNED
    return messages.select(
        "conv_id",
        "place",
        F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(learned, F.length(head)).cast("long").alias("loss_start"),
        F.when(learned, F.length(head) + F.length(body)).cast("long").alias("loss_end"),
    )


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END), re.DOTALL)


def turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of rendered text."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"text between turns at {at}")
        found.append((_role_unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return found


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        for role, text in turns(segment):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            text = unescaped(segment[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.chars += len(segment)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(rendered: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, parsed from its rendered text.

    A digest runs over a conversation in order, so its segments stream through one task, one at a
    time: memory doesn't grow with the conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Digest | None = None
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            names = [c.split()[0] for c in _DIGEST.split(", ")]
            kinds = [pa.int64() if c.endswith("long") else pa.string() for c in _DIGEST.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
            done.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for conv_id, segment, start, end in zip(*(part.column(k).to_pylist() for k in range(4))):
                    if current is None or conv_id != current.conv_id:
                        if current:
                            done.append(current.row())
                        current = _Digest(conv_id)
                    current.add(segment, start, end)
            if len(done) >= 1000:
                yield flush()
        if current:
            done.append(current.row())
        if done:
            yield flush()

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "place", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(run, _DIGEST)
