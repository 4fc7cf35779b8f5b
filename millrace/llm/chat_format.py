"""Chat formatting whose output a deterministic parser reads back to the same turns.

Grammar of a formatted conversation::

    conversation = { turn }
    turn         = "### " role ": " text "</turn>" newline

``###`` and ``</turn>`` are control strings; in a role ``:`` is one too.  A
control string counts as text if an odd number of backslashes stands before
it.  Of ``2 n`` or ``2 n + 1`` backslashes before a control string ``n`` belong
to the text; other backslashes are themselves.

A turn is rendered plainly first and parsed.  Only if role and text do not come
back are the conflicting places escaped, and the result is parsed again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE, LINE = "### ", ": ", "</turn>", "\n"
_TEXT_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ROLE_CONTROL = re.compile(r"(\\*)(###|</turn>|:)")
_TAIL = re.compile(r"(\\*)\Z")


def escape(part: str, control: re.Pattern) -> str:
    """Make every control string, and backslashes at the end, mean text."""
    part = control.sub(lambda m: m[1] * 2 + "\\" + m[2], part)
    return _TAIL.sub(lambda m: m[1] * 2, part, count=1)


def _take(text: str, at: int, control: re.Pattern) -> tuple[str, str, int]:
    """(text up to the next real control string, that string, position behind it)."""
    out = []
    for m in control.finditer(text, at):
        out.append(text[at : m.start()] + m[1][: len(m[1]) // 2])
        at = m.end()
        if len(m[1]) % 2 == 0:
            return "".join(out), m[2], at
        out.append(m[2])
    raise ValueError("no control string where one must stand")


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end bound the raw text inside ``text``."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        role, control, at = _take(text, at + len(OPEN), _ROLE_CONTROL)
        if control != ":" or text[at : at + 1] != " ":
            raise ValueError(f"no role before {at}")
        start = at + 1
        said, control, at = _take(text, start, _TEXT_CONTROL)
        if control != CLOSE or text[at : at + 1] != LINE:
            raise ValueError(f"a turn does not end at {at}")
        turns.append((role, said, start, at - len(CLOSE)))
        at += len(LINE)
    return turns


def _reads_back(segment: str, role: str, text: str) -> bool:
    try:
        return [t[:2] for t in parse(segment)] == [(role, text)]
    except ValueError:
        return False


def render(role: str, text: str) -> str:
    """One turn that parses to exactly ``role`` and ``text``."""
    parts = [role, text]
    for i, control in ((None, None), (1, _TEXT_CONTROL), (0, _ROLE_CONTROL)):
        if i is not None:
            parts[i] = escape((role, text)[i], control)
        segment = OPEN + parts[0] + MIDDLE + parts[1] + CLOSE + LINE
        if _reads_back(segment, role, text):
            return segment
    raise AssertionError(f"{segment!r} does not read back")


def format_turns(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversation, turn, and per row the rendered ``segment`` with its ``loss_start`` and ``loss_end``.

    The formatted conversation is its segments in the order of turn, role and
    text, nulls first; nothing stands between them, and they read back turn by
    turn.  ``loss_start`` and ``loss_end`` bound an assistant's text inside the
    segment, in code points, and are null for others.  Null roles and texts are
    empty strings.  Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            made = [render(r, t) for r, t in zip(roles, texts)]
            spans = [parse(s)[0][2:] if r == "assistant" else (None, None) for r, s in zip(roles, made)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string()), pa.array([a for a, _ in spans], pa.int64()), pa.array([b for _, b in spans], pa.int64())],
                [*batch.schema.names, "segment", "loss_start", "loss_end"],
            )

    picked = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", segment string, loss_start bigint, loss_end bigint"
    return picked.mapInArrow(run, schema)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from the output of :func:`format_turns` alone.

    ``conv``, ``n_turns``, ``turns_sha256`` over role, newline, text, newline of
    every turn, ``loss_chars`` and ``loss_sha256`` of the assistants' texts under the
    loss mask, ``formatted_chars``.  The rows of a conversation come sorted to one
    task, which holds one batch of them and the running hashes, however long the
    conversation is.
    """

    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rest = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, state = None, None  # conversation, turns, their hash, loss characters, their hash, characters

        def out(states: list) -> pa.RecordBatch:
            rows = [(c, n, turns.hexdigest(), k, loss.hexdigest(), chars) for c, n, turns, k, loss, chars in states]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), [kind, *rest])], names)

        for batch in batches:
            kind, done = batch.schema.field("conv").type, []
            for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    done += [state] if state is not None else []
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for said_by, said, _, _ in parse(segment):
                    state[1] += 1
                    state[2].update(f"{said_by}\n{said}\n".encode())
                if start is not None:
                    masked = parse(OPEN + MIDDLE + segment[start:end] + CLOSE + LINE)[0][1]
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(segment)
            if done:
                yield out(done)
        if state is not None:
            yield out([state])

    ordered = segments.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    kind = segments.schema["conv"].dataType.simpleString()
    return ordered.select("conv", "segment", "loss_start", "loss_end").mapInArrow(
        run, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def format_chats(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation with what :func:`read_back` gives.

    A null conversation is one conversation; a table without rows gives none.
    """
    return read_back(format_turns(rows, conversation, turn, role, text)).withColumnRenamed("conv", conversation)
