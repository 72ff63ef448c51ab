"""Chat formatting with a grammar that reads its own output back.

A conversation is its turns in order, each rendered as

    ### Role:          a role of small letters, the first one raised; any other role as a JSON string
    text</turn>

``</turn>`` and ``### `` are control strings. The parser is deterministic: a header, then
text up to the first ``</turn>`` and a line end; a control string anywhere else is an
error. A turn whose plain rendering the parser doesn't recover exactly is rendered in
escaped mode, which the header announces with a backslash before the colon: backslashes
are doubled and each control string gets one after its first character. The recovered
turns of the whole conversation are compared with the source before it is returned.

The loss mask covers the text of assistant turns, as spans of code points.

A conversation is one string, so its turns meet in one task; nothing else is collected.
Turns are ordered by turn, role and text, so ties and repeated rows have one order.
Defined cases: null text and null role are empty; a null turn comes first; rows with a
null conv_id are one conversation; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END, MARK = "</turn>", "### "
CONTROL = (END, MARK)
LOSS_ROLE = "assistant"

_PLAIN_ROLE = re.compile(r"[a-z]+\Z")
_HEADER = re.compile(r'### (?:([A-Z][a-z]*)|("(?:[^"\\]|\\.)*"))(\\?):\n')
_ESCAPED = re.compile("|".join([r"\\\\", *(re.escape(c[0]) + r"\\" + re.escape(c[1:]) for c in CONTROL)]))


class GrammarError(ValueError):
    """The text isn't a conversation."""


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[0] == "\\\\" else m[0].replace("\\", ""), text)


def render_turn(role: str, text: str, escaped: bool) -> tuple[str, int]:
    """The rendering and how many characters stand before the text."""
    name = role.capitalize() if _PLAIN_ROLE.match(role) else json.dumps(role)
    header = f"{MARK}{name}{'\\' if escaped else ''}:\n"
    return f"{header}{escape(text) if escaped else text}{END}\n", len(header)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    turns, at = [], 0
    while at < len(text):
        head = _HEADER.match(text, at)
        if not head:
            raise GrammarError(f"no header at {at}")
        end = text.find(END, head.end())
        if end < 0 or text[end + len(END) : end + len(END) + 1] != "\n":
            raise GrammarError(f"the turn at {at} doesn't end")
        body = text[head.end() : end]
        if MARK in body:
            raise GrammarError(f"a header inside the turn at {at}")
        role = head[1].lower() if head[1] else json.loads(head[2])
        turns.append((role, unescape(body) if head[3] else body))
        at = end + len(END) + 1
    return turns


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]], int]:
    """The conversation, its loss spans (start, end, escaped), and the number of escaped turns."""
    pieces, spans, at, n_escaped = [], [], 0, 0
    for role, text in turns:
        for escaped in (False, True):
            piece, before = render_turn(role, text, escaped)
            try:
                same = parse(piece) == [(role, text)]
            except GrammarError:
                same = False
            if same:
                break
        else:
            raise GrammarError("a turn can't be read back")
        if role == LOSS_ROLE:
            spans.append((at + before, at + len(piece) - len(END) - 1, escaped))
        pieces.append(piece)
        at += len(piece)
        n_escaped += escaped
    whole = "".join(pieces)
    if parse(whole) != turns:
        raise GrammarError("the conversation can't be read back")
    return whole, spans, n_escaped


FORMATTED = (
    "conv_id long, formatted string, loss array<struct<start:long,end:long,escaped:boolean>>, n_escaped long"
)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, masks, escaped = [], [], []
        for turns in batch.column("turns").to_pylist():
            whole, spans, n = render([(t["role"], t["text"]) for t in turns])
            texts.append(whole)
            masks.append([{"start": a, "end": b, "escaped": e} for a, b, e in spans])
            escaped.append(n)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("escaped", pa.bool_())])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(texts, pa.string()),
                pa.array(masks, pa.list_(span)),
                pa.array(escaped, pa.int64()),
            ],
            names=["conv_id", "formatted", "loss", "n_escaped"],
        )


def format_conversations(rows: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, formatted, loss and n_escaped."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    return grouped.mapInArrow(_format, FORMATTED)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns, loss_texts = [], []
        for whole, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
            turns.append([{"role": r, "text": t} for r, t in parse(whole)])
            masked = [(whole[s["start"] : s["end"]], s["escaped"]) for s in loss]
            loss_texts.append("".join(unescape(t) if e else t for t, e in masked))
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(turns, pa.list_(turn)),
                pa.array(loss_texts, pa.string()),
                batch.column("formatted"),
            ],
            names=["conv_id", "turns", "loss_text", "formatted"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns, loss_text and formatted, read from formatted text and mask alone."""
    return formatted.mapInArrow(
        _read, "conv_id long, turns array<struct<role:string,text:string>>, loss_text string, formatted string"
    )
