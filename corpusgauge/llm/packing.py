"""Documents as rows of token ids of one length, packed best fit decreasing.

Documents are encoded once and cut into pieces of at most ``length`` ids, without loss. Pieces are dealt to
shards by a hash of document and piece, so neither a long document nor a hot source fills one; the
number of shards grows with the input. In a shard, pieces go from the longest to the shortest into
the fullest row that still has room. A segment tree over the free capacities finds that row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import groups_of, mix, partitions_for, row_id
from corpusgauge.llm.tokens import RANKS, encoder, read_ranks

SHARD_BYTES = 12 << 20
"""Text for a shard."""


class Capacities:
    """Open rows by free capacity. The tree holds in each node whether any row lies below it."""

    def __init__(self, most: int):
        self.size = 1 << max(1, most.bit_length())
        self.some = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def _count(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.some[at] += by
            at >>= 1

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._count(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, capacity) of a row with the least capacity that is not below ``need``."""
        at = need + self.size
        if not self.some[at]:
            while at > 1 and (at & 1 or not self.some[at + 1]):  # up, until there is something on the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        capacity = at - self.size
        row = self.rows[capacity].pop()
        self._count(capacity, -1)
        return row, capacity


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of indices of ``sizes``, which fall and are at most ``length``."""
    open_, rows = Capacities(length), []
    for i, n in enumerate(sizes):
        found = open_.take(n)
        if found is None:
            found = len(rows), length
            rows.append([])
        row, capacity = found
        rows[row].append(i)
        if capacity > n:
            open_.add(capacity - n, row)
    return rows


def _pieces(ranks: bytes, length: int, shards: int, end: int | None, kind: str):
    """Task: documents to pieces."""

    def task(batches):
        encode = encoder(ranks).encode_ordinary
        for part, texts in groups_of(batches, "text"):
            ids, tags = part.column("_id").to_pylist(), part.column("_tag").to_pylist()
            out: dict[str, list] = {k: [] for k in ("_id", "_tag", "start", "n", "ids")}
            for doc, tag, text in zip(ids, tags, texts, strict=True):
                if not text:
                    continue
                tokens = encode(text.decode("utf-8", "replace"))
                if end is not None:
                    tokens.append(end)
                packed = np.array(tokens, kind)
                for start in range(0, len(packed), length):
                    piece = packed[start : start + length]
                    for k, v in zip(out, (doc, tag, start, len(piece), piece.tobytes()), strict=True):
                        out[k].append(v)
            a = np.array(out["_id"], np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            b = np.array(out["_tag"], np.int64).view(np.uint64) + np.array(out["start"], np.int64).astype(np.uint64)
            shard = (mix(a ^ mix(b)) % np.uint64(shards)).astype(np.int64)
            yield pa.record_batch({
                "shard": shard, "_id": pa.array(out["_id"], pa.int64()), "_tag": pa.array(out["_tag"], pa.int64()),
                "start": pa.array(out["start"], pa.int64()), "n": pa.array(out["n"], pa.int32()), "ids": pa.array(out["ids"], pa.binary()),
            })

    return task


def _pack(length: int, pad: int, kind: str):
    """All pieces of one shard to its rows."""

    def group(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("n", "descending"), ("_id", "ascending"), ("_tag", "ascending"), ("start", "ascending")])
        sizes, ids = pieces.column("n").to_pylist(), pieces.column("ids").to_pylist()
        docs, starts = pieces.column("_id").to_pylist(), pieces.column("start").to_pylist()
        rows = best_fit_decreasing(sizes, length)
        filler = np.array([pad], kind).tobytes()
        unit, ends = len(filler), [np.cumsum([0, *(sizes[i] for i in row)]) for row in rows]
        body = [b"".join(ids[i] for i in row) for row in rows]
        return pa.table({
            "shard": pa.array([pieces.column("shard")[0].as_py()] * len(rows), pa.int64()),
            "row": pa.array(range(len(rows)), pa.int32()),
            "ids": pa.array([b + filler * (length - len(b) // unit) for b in body], pa.binary()),
            "n_tokens": pa.array([int(e[-1]) for e in ends], pa.int32()),
            "cu_seqlens": pa.array([e.tolist() for e in ends], pa.list_(pa.int32())),
            "doc_ids": pa.array([[docs[i] for i in row] for row in rows], pa.list_(pa.int64())),
            "doc_starts": pa.array([[starts[i] for i in row] for row in rows], pa.list_(pa.int64())),
        })

    return group


def pack(docs: DataFrame, length: int = 2048, ranks_path: str = RANKS, end: int | None = 50256, pad: int = 50256, kind: str = "<u2") -> DataFrame:
    """One row per packed row: ``shard``, ``row``, ``ids`` (``length`` ids as little-endian numbers, filled
    up with ``pad``), ``n_tokens`` (without the filling), ``cu_seqlens`` (0 and the end of each segment),
    ``resets`` (places where positions begin at 0 again), ``doc_ids`` and ``doc_starts`` (of each
    segment: its document, and where in the document's ids it begins).

    Each document's ids are followed by ``end`` (None: by nothing), so its segments in the order of
    ``doc_starts`` give the text back byte for byte. Only ``doc_id`` and ``text`` are read, so other
    columns cannot clash. NULL and empty texts have no ids and take no place. A NULL id is shown as
    NULL in ``doc_ids``. Rows of one id are encoded each; rows equal in id and text are packed
    as often as they occur. Empty table: no rows. A text of any length is cut into pieces.
    """
    rows = docs.select(row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.col("text").cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = partitions_for(size, SHARD_BYTES)
    schema = "shard long, _id long, _tag long, start long, n int, ids binary"
    pieces = rows.mapInArrow(_pieces(read_ranks(ranks_path), length, shards, end, kind), schema)
    made = "shard long, row int, ids binary, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<long>"
    packed = pieces.repartition(min(shards, 10_000), "shard").groupBy("shard").applyInArrow(_pack(length, pad, kind), made)
    none = F.lit((1 << 63) - 1)
    return packed.withColumns({
        "resets": F.slice("cu_seqlens", F.lit(1), F.size("cu_seqlens") - 1),
        "doc_ids": F.transform("doc_ids", lambda d: F.when(d != none, d)),
    })


def write(packed: DataFrame, path: str) -> None:
    """Packed rows as files: the rows of ``ids`` in the order of (shard, row) are the id matrix."""
    packed.sortWithinPartitions("shard", "row").write.parquet(path)


def positions(cu_seqlens: list[int], length: int) -> np.ndarray:
    """Positions of a row: from 0 up in every segment, the filling counted as one more."""
    at = np.arange(length)
    ends = np.array([*cu_seqlens, length])
    begins = ends[np.searchsorted(ends, at, "right") - 1]
    return at - begins
