"""Operator 3: chat examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
the context, and only its reply is under the loss mask.  Turns after the last
assistant turn (or all turns, where there is none) come in one further example
without a target, so that the output holds the whole conversation.

The template writes a turn as ``[INST] role`` newline, text, ``</s>`` newline.
Control strings inside texts and roles are escaped reversibly: every ``\\`` is
doubled and a backslash is put behind the first character of each control
string, so an escaped text holds none of them.

A conversation's examples repeat its prefix, so they are made and read back as
a stream in batches of bounded size, one example at a time.

Defined results: null texts and roles are empty; turns are ordered by (turn,
role, text), nulls first; a null ``conv_id`` is a conversation of its own;
repeated rows are turns of their own; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "[INST]", "</s>"
CONTROL = ("[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>")
_FIND = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROL))
_UNDO = re.compile(r"\\\\|(?<=[\[<])\\")
_TURN = re.compile(r"\[INST\] (.*?)\n(.*?)</s>\n", re.DOTALL)

EXAMPLE = "conv_id long, example long, text string, loss_start long, loss_end long"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def escape(text: str) -> str:
    return _FIND.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNDO.sub(lambda m: "\\" if m[0] == "\\\\" else "", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    head = f"{OPEN} {escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each formatted turn."""
    out = []
    for role, text in _TURN.findall(formatted):
        out.append((re.sub(r"\\\\|\\n|(?<=[\[<])\\", lambda m: {"\\\\": "\\", "\\n": "\n"}.get(m[0], ""), role), unescape(text)))
    return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_EXAMPLE = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_DIGEST = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DIGEST.split(", ")])


def _expand(batches: Iterator[pa.RecordBatch], limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    unset = object()
    conv, prefix, trailing, number = unset, "", False, 0
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_id != conv or conv is unset:
                if trailing:
                    rows.append((conv, number, prefix, None, None))
                conv, prefix, trailing, number = conv_id, "", False, 0
            turn, start, end = render(role or "", text or "")
            if role == "assistant":
                rows.append((conv, number, prefix + turn, len(prefix) + start, len(prefix) + end))
                size += len(prefix) + len(turn)
                number += 1
            prefix, trailing = prefix + turn, role != "assistant"
            if size >= limit or len(rows) >= 5000:
                yield _batch(rows, _EXAMPLE)
                rows, size = [], 0
    if trailing:
        rows.append((conv, number, prefix, None, None))
    yield _batch(rows, _EXAMPLE)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation, from its consecutive examples alone."""
    import hashlib

    unset = object()
    conv, last, loss, loss_chars, chars, count = unset, "", None, 0, 0, 0
    rows: list[tuple] = []

    def close() -> None:
        if conv is not unset:
            turns = parse(last)
            digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            rows.append((conv, len(turns), digest, loss_chars, loss.hexdigest(), chars, count))

    for batch in batches:
        for conv_id, _, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_id != conv or conv is unset:
                close()
                conv, loss, loss_chars, chars, count = conv_id, hashlib.sha256(), 0, 0, 0
            last, chars, count = text, chars + len(text), count + 1
            if start is not None:
                reply = unescape(text[start:end])
                loss.update(reply.encode())
                loss_chars += len(reply)
        yield _batch(rows, _DIGEST)
        rows.clear()
    close()
    yield _batch(rows, _DIGEST)


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (ordinal), formatted text and the span under the loss mask (null: none).

    A conversation's examples are consecutive rows of one partition.
    """
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    dealt = turns.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")])
    return dealt.select("conv_id", "role", "text").mapInArrow(_expand, EXAMPLE)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``examples``, one row per conversation."""
    return formatted.mapInArrow(_read_back, DIGEST)
