"""Token counts of sections or fields, from one encoding of the whole document.

A document is encoded once, as a whole. The bytes of its tokens follow one another, so running sums give each
token's span in bytes and, over the text's character starts, in characters. The spans are joined to the
sections' intervals by binary search. A token inside one section counts there. A token across a
boundary is allocated by a rule: ``start`` (section of its first character), ``end`` (of its last), ``most``
(most of its characters, the earlier section if equal) or ``share`` (to each by characters).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import groups_of
from corpusgauge.llm.tokens import RANKS, encoder, read_ranks

RULES = ("start", "end", "most", "share")


def allocate(ends: np.ndarray, chars: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section. ``ends``: end of each token in bytes. ``chars``: character of each byte.
    ``bounds``: first character of each section, and the end of the last."""
    n = len(bounds) - 1
    if not len(ends):
        return np.zeros(n)
    begins = np.concatenate(([0], ends[:-1]))
    first, last = chars[begins], chars[ends - 1]
    a = np.searchsorted(bounds[1:], first, "right")
    b = np.searchsorted(bounds[1:], last, "right")
    if rule == "start":
        return np.bincount(a, minlength=n).astype(float)
    if rule == "end":
        return np.bincount(b, minlength=n).astype(float)
    out = np.bincount(a[a == b], minlength=n).astype(float)
    for i in np.flatnonzero(a != b).tolist():
        sections = np.arange(a[i], b[i] + 1)
        inside = np.minimum(bounds[sections + 1], last[i] + 1) - np.maximum(bounds[sections], first[i])
        if rule == "most":
            out[sections[np.argmax(inside)]] += 1
        else:
            out[sections] += inside / inside.sum()
    return out


def _lines(data: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Bounds of the lines of a text."""
    total = int(chars[-1]) + 1 if len(chars) else 0
    after = chars[np.flatnonzero(data == 0x0A)] + 1
    inner = after[after < total]
    return np.concatenate(([0], inner, [total]))


def _task(ranks: bytes, rule: str):
    def task(batches):
        encoding = encoder(ranks)
        width = np.array([len(b) for b in encoding.token_byte_values()], np.int64)
        order = np.array([encoding.encode_single_token(b) for b in encoding.token_byte_values()])
        lengths = np.zeros(order.max() + 1, np.int64)
        lengths[order] = width
        for part, texts in groups_of(batches, "text"):
            docs, sections = part.column("doc_id"), part.column("lengths").to_pylist()
            which, number, start, end, tokens = [], [], [], [], []
            for i, (raw, given) in enumerate(zip(texts, sections, strict=True)):
                text = raw.decode("utf-8", "replace")
                data = np.frombuffer(text.encode(), np.uint8)
                chars = np.cumsum((data & 0xC0) != 0x80) - 1
                ids = np.array(encoding.encode_ordinary(text), np.int64)
                bounds = _lines(data, chars) if given is None else np.cumsum([0, *given])
                counted = allocate(np.cumsum(lengths[ids]), chars, bounds, rule)
                which.append(np.full(len(counted), i))
                number.append(np.arange(len(counted)))
                start.append(bounds[:-1])
                end.append(bounds[1:])
                tokens.append(counted)
            which = np.concatenate(which)
            yield pa.record_batch({
                "doc_id": docs.take(pa.array(which)), "section": np.concatenate(number).astype(np.int32),
                "start": np.concatenate(start), "end": np.concatenate(end), "tokens": np.concatenate(tokens),
            })

    return task


def _count(docs: DataFrame, text: Column, lengths: Column, rule: str, ranks_path: str) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select("doc_id", text.cast("binary").alias("text"), lengths.cast("array<bigint>").alias("lengths"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_task(read_ranks(ranks_path), rule), f"doc_id {kind}, section int, start long, end long, tokens double")


def by_line(docs: DataFrame, rule: str = "most", ranks_path: str = RANKS) -> DataFrame:
    r"""One row per line of each row of ``docs``: ``doc_id``, ``section`` (from 0), ``start`` and ``end`` in
    characters, ``tokens``. A line ends after its ``\n``, and the last one at the end of the text; lines
    partition the text, so a document's ``tokens`` sum to its number of tokens.

    Only ``doc_id`` and ``text`` are read, so other columns cannot clash. NULL or empty text: one section of
    no characters and no tokens. NULL ids and repeated rows: each row is counted alone. Empty table: no
    rows. There is no shuffle; a text of any length is encoded whole.
    """
    return _count(docs, F.col("text").cast("string"), F.lit(None), rule, ranks_path)


def by_field(docs: DataFrame, fields: list[str], joiner: str = "\n", rule: str = "most", ranks_path: str = RANKS) -> DataFrame:
    """As ``by_line`` for columns: the fields of a row are joined by ``joiner`` into one text, each field but
    the last with its joiner. ``section`` counts the fields. A NULL field is empty."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    parts = [F.concat(p, F.lit(joiner)) for p in parts[:-1]] + parts[-1:]
    return _count(docs, F.concat(*parts), F.array(*map(F.char_length, parts)), rule, ranks_path)
