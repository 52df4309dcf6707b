"""Chat formatting from an event log.

Event-sourced reconstruction: a log holds, for each conversation and message, events in
sequence: start (opens the message with a role), delta (appends text), edit (replaces the
text), regenerate (discards the text so far; deltas follow). The log is partitioned by
conversation and message, sorted by sequence and folded into final messages; these are
rendered with a template that marks turns. Control strings inside roles and texts are escaped
reversibly: backslash doubled, then "<|" written as "<" backslash "|".

A conversation's output is the concatenation of its pieces, one a message, in the order of
(turn, role, text); it is read back as a stream in that order, so no conversation, however
long, is held in memory. The digests of a conversation are hashes over its whole output,
which only one reader can compute; what is shuffled to it are the pieces.

Null texts and roles count as empty; null turns come first; null conversation ids are one
conversation. Repeated rows are messages of their own. Texts of any length are kept whole, in deltas of
bounded number. Empty tables give empty tables. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import prepare

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def _escaped(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def conversation_events(rows: DataFrame, chunk: int = 512, most: int = 64) -> DataFrame:
    """A log of rows (conv_id, turn, role, text): a start, then at most `most` deltas of at least chunk characters (but the last).

    conv_id, turn, message (a number for each row), seq, kind, role, text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = rows.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("message")
    )
    starts = F.array(F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.col("role").alias("role"), F.lit("").alias("text")))
    size = F.greatest(F.lit(chunk), F.ceil(F.length("text") / most).cast("int"))
    deltas = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("text") / size).cast("int") - 1)),
        lambda k: F.struct((k + 1).alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), F.substring(F.col("text"), k * size + 1, size).alias("text")),
    )
    return base.select("conv_id", "turn", "message", F.explode(F.concat(starts, deltas)).alias("e")).select("conv_id", "turn", "message", "e.*")


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the final messages.

    Events of one message with equal sequence numbers are taken by kind, then text. A message
    without a start has role ''; its turn is the least of its events.
    """
    log = events.groupBy("conv_id", "message").agg(F.min("turn").alias("turn"), F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"))
    folded = F.expr("""
        aggregate(log, named_struct('role', '', 'parts', cast(array() as array<string>)), (s, e) -> named_struct(
            'role', if(e.kind = 'start', coalesce(e.role, ''), s.role),
            'parts', case e.kind when 'delta' then concat(s.parts, array(coalesce(e.text, '')))
                                 when 'edit' then array(coalesce(e.text, ''))
                                 when 'regenerate' then cast(array() as array<string>)
                                 when 'start' then cast(array() as array<string>)
                                 else s.parts end))""")
    return log.withColumn("f", folded).select("conv_id", "turn", "message", F.col("f.role").alias("role"), F.array_join("f.parts", "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """The pieces of the formatted conversations, to be joined in the order of (turn, role, text).

    conv_id, turn, role, text, piece, loss_start, loss_end (characters of the piece under the
    loss mask: the escaped text of an assistant; start = end elsewhere).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), F.replace(_escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = _escaped(text)
    loss = role == "assistant"
    return messages.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.concat(head, body, F.lit(END + "\n")).alias("piece"),
        F.when(loss, F.length(head)).otherwise(0).cast("int").alias("loss_start"),
        F.when(loss, F.length(head) + F.length(body)).otherwise(0).cast("int").alias("loss_end"),
    )


class _Reader:
    """Reads the pieces of one conversation back."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, piece: str, loss_start: int, loss_end: int) -> None:
        role, line, body = piece[len(START) : -len(END) - 1].partition("\n")
        if not (line and piece.startswith(START) and piece.endswith(END + "\n")) or "<|" in role or "<|" in body:
            raise ValueError("a piece does not hold one marked turn")
        self.turns += 1
        self.chars += len(piece)
        self.all.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        loss = unescape(piece[loss_start:loss_end])
        self.loss_chars += len(loss)
        self.loss.update(loss.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(pieces: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    prepare(pieces.sparkSession)

    def run(batches):
        reader = None
        for batch in batches:
            done = []
            for conv, piece, a, b in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if reader is None or reader.conv != conv:
                    if reader:
                        done.append(reader.row())
                    reader = _Reader(conv)
                reader.read(piece, a, b)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in done], _SCHEMA)
        if reader:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, reader.row(), strict=True))], _SCHEMA)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
