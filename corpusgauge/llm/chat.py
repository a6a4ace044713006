"""Chat formatting by a template that is only called, never looked into.

The prefixes of a conversation are rendered one after another. What a turn adds to the output before it is the
turn's span; if the earlier output is not kept, the template rewrites history, and the first turn at which
it does so and the first character it changed are reported. Where the text lies inside a span is found by rendering the
prefix with two probe texts in place of the turn: what both have in common before and after the probes is the frame.

Conversations are streamed in the order of their turns and cut into blocks of ``BLOCK`` turns, so a prefix
has at most that many turns before it and the work is in proportion to the text. A template whose output for a turn depends on
earlier ones says on how many (``lookback``); so many are rendered before each block. One that depends on all of
them (``lookback=None``) gets whole conversations. The few conversations that hold a large share of
all rows are numbered and dealt out by block; their number has a fixed bound.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators.ordering import row_numbers

BLOCK = 64
SHARES = 1024
"""Conversations of more than one such share of all rows (and of ``LONG`` turns) are dealt out: at most as many as shares."""
LONG = 4096
PROBES = ("a", "b")
_OUT = (
    "conv_id long, block long, n_turns long, formatted string, spans array<struct<role:string,start:long,end:long,text_start:long,text_end:long>>,"
    " rewritten_at long, rewritten_from long"
)

Turn = tuple[str, str]


@dataclass(frozen=True)
class Template:
    """``render`` turns (role, text) to one string; ``unescape`` undoes what it does to a text."""

    render: Callable[[Sequence[Turn]], str]
    unescape: Callable[[str], str] = str
    lookback: int | None = 0


# --- the package's own template --------------------------------------------------------------------

_SIGNS = [("\\", "\\\\"), ("</turn>", "\\e"), ("###", "\\h")]
"""Control strings and what stands for them inside a text. The backslash comes first and is doubled, so it can be undone."""
_ROLE_SIGNS = [*_SIGNS, (":", "\\c"), ("\n", "\\n")]
_BACK = {"\\\\": "\\", "\\e": "</turn>", "\\h": "###", "\\c": ":", "\\n": "\n"}


def _escape(text: str, signs) -> str:
    for sign, stand_in in signs:
        text = text.replace(sign, stand_in)
    return text


def _unescape(text: str) -> str:
    return re.sub(r"\\[\\ehcn]", lambda m: _BACK[m.group()], text)


def _render_plain(turns: Sequence[Turn]) -> str:
    return "".join(f"### {_escape(role, _ROLE_SIGNS)}: {_escape(text, _SIGNS)}</turn>\n" for role, text in turns)


PLAIN = Template(_render_plain, _unescape)
"""``### role: text</turn>`` and a line end for each turn. Inside texts ``###``, ``</turn>`` and backslashes are written as
``\\h``, ``\\e`` and two backslashes, so no control string is left in them and each reads back as it was."""


def read_plain(formatted: str) -> list[Turn]:
    """The turns of an output of ``PLAIN``."""
    turns = []
    for piece in formatted.split("</turn>\n")[:-1]:
        role, text = piece.removeprefix("### ").split(": ", 1)
        turns.append((_unescape(role), _unescape(text)))
    return turns


# --- spans -----------------------------------------------------------------------------------------


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if a == b[: len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def locate(render: Callable, context: Sequence[Turn], turns: Sequence[Turn]):
    """(output of the turns behind ``context``, spans, index of the first turn that rewrites, place of it).

    Spans are (role, start, end, text_start, text_end) in code points of that output. After a
    turn that rewrites history places mean nothing any more, so the spans end before it."""
    seen = list(context)
    before = render(seen) if seen else ""
    base, spans = len(before), []
    for i, (role, text) in enumerate(turns):
        now = render([*seen, (role, text)])
        kept = _common(before, now)
        if kept < len(before):
            return render([*context, *turns])[base:], spans, i, max(0, kept - base)
        a, b = (render([*seen, (role, probe)]) for probe in PROBES)
        head, tail = _common(a, b), _common(a[::-1], b[::-1])
        start = len(before) - base
        spans.append((role, start, len(now) - base, min(head, len(now)) - base, max(head, len(now) - tail) - base))
        seen.append((role, text))
        before = now
    return before[base:], spans, None, None


def _batch(rows: list) -> pa.RecordBatch:
    conv, block, count, text, spans, at, place = zip(*rows, strict=True)
    span = pa.struct([("role", pa.string()), *((c, pa.int64()) for c in ("start", "end", "text_start", "text_end"))])
    as_dicts = [[dict(zip(("role", "start", "end", "text_start", "text_end"), s, strict=True)) for s in one] for one in spans]
    return pa.record_batch({
        "conv_id": pa.array(conv, pa.int64()), "block": pa.array(block, pa.int64()), "n_turns": pa.array(count, pa.int64()),
        "formatted": pa.array(text, pa.string()), "spans": pa.array(as_dicts, pa.list_(span)),
        "rewritten_at": pa.array(at, pa.int64()), "rewritten_from": pa.array(place, pa.int64()),
    })


def _stream(template: Template, block: int):
    """Task: sorted turns to the blocks of their conversations. ``block`` is NULL where it is still to be counted, and
    ``context`` marks rows that only come before a block."""
    whole = template.lookback is None

    def task(batches: Iterator[pa.RecordBatch]):
        out, size = [], 0
        key, number, before, turns = None, 0, [], []

        def close():
            if turns:
                text, spans, at, place = locate(template.render, before, turns)
                first = number * block
                out.append((key[0], number, len(turns), text, spans, None if at is None else first + at, place))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "block", "context", "role", "text"))
            for conv, given, context, role, text in zip(*columns, strict=True):
                if (conv, given) != key:
                    close()
                    key, number, before, turns = (conv, given), given or 0, [], []
                elif given is None and not whole and len(turns) == block:
                    close()
                    before = [*before, *turns][len(before) + len(turns) - template.lookback :] if template.lookback else []
                    number, turns = number + 1, []
                (before if context else turns).append((role, text))
                size += len(text)
                if size > 1 << 20 and out:
                    yield _batch(out)
                    out, size = [], 0
        close()
        if out:
            yield _batch(out)

    return task


def parts(turns: DataFrame, template: Template = PLAIN, block: int = BLOCK, long: int = LONG, shares: int = SHARES) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``formatted``: those of most conversations, whose blocks follow one another in one task, and those of the
    conversations that are dealt out by block (None if there are none)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = [F.asc_nulls_first("turn"), "role", "text"]
    counts = rows.groupBy("conv_id").count()
    n = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    # fewer ids than shares, whatever the table's size
    hot = [] if template.lookback is None else [r[0] for r in counts.where(F.col("count") > max(long, n // shares)).select("conv_id").collect()]
    task = _stream(template, block)
    none = F.lit(None).cast("long").alias("block")
    usual = rows.where(~F.col("conv_id").isin(hot)) if hot else rows
    usual = usual.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    usual = usual.select("conv_id", none, F.lit(False).alias("context"), "role", "text").mapInArrow(task, _OUT)
    if not hot:
        return usual, None
    dealt = row_numbers(rows.where(F.col("conv_id").isin(hot)), order, "pos", ["conv_id"])
    dealt = dealt.withColumn("block", F.floor(F.col("pos") / block)).withColumn("context", F.lit(False))
    if template.lookback:
        back = F.floor((F.col("pos") + F.lit(template.lookback)) / block)
        later = F.explode(F.sequence(F.col("block") + 1, back))
        led = dealt.where(back > F.col("block")).select("conv_id", "turn", "role", "text", "pos", later.alias("block"), F.lit(True).alias("context"))
        dealt = dealt.unionByName(led)
    dealt = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    return usual, dealt.select("conv_id", "block", "context", "role", "text").mapInArrow(task, _OUT)


def formatted(turns: DataFrame, template: Template = PLAIN, **settings) -> DataFrame:
    """One row per block of ``BLOCK`` turns of a conversation: ``conv_id``, ``block`` from 0, ``n_turns``, ``formatted``, ``spans``
    (of each turn, and of the text in it: what a loss mask takes for assistants), ``rewritten_at`` (the first turn of the
    conversation that changes earlier output, NULL if the template keeps history) and ``rewritten_from`` (the first changed
    character in the block). The outputs of all blocks in order are the output of the conversation.

    Turns go by ``turn``, NULL first, then by role and text, so repeated turns stay. NULL role or text count as empty.
    Rows with a NULL ``conv_id`` belong to no conversation and are left out. Only ``conv_id``, ``turn``, ``role`` and ``text`` are
    read, so other columns cannot clash. Empty table: no rows.
    """
    usual, dealt = parts(turns, template, **settings)
    return usual if dealt is None else usual.union(dealt)
