"""Helpers shared by the operators: row keys, byte-level words and their hashes, Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1
"""Stands for a NULL id inside an operator; such documents come after all others."""

PIECE = 1 << 20
"""Bytes that the numpy work below holds at a time (about 40 bytes of memory for each)."""

LONG_WORD = 256
"""Bytes from which a word is hashed by BLAKE2b. The sums modulo 2**64 below have known collisions of equally long
words, of 1,024 bytes and more, that hold in every base."""

_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_id(column: str = "doc_id"):
    """The id as long, ``NO_ID`` for NULL."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def repeated_ids(docs: DataFrame, column: str = "doc_id") -> bool:
    """Whether two rows carry the same id."""
    ids = docs.groupBy(row_id(column).alias("i")).count()
    return not ids.where("count > 1").isEmpty()


def row_tag(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """Tells rows of one id apart: a hash of the text where ids repeat, else 0 (which packs well)."""
    return F.xxhash64(text_column) if repeated_ids(docs, id_column) else F.lit(0).cast("long")


def partitions_for(n_bytes: float, each: int, least: int = 1) -> int:
    return max(least, -(-int(n_bytes) // each))


# --- bytes -------------------------------------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_plain = bytearray(range(256))
for _b in range(128):
    _ch = chr(_b)
    _plain[_b] = ord(_ch.lower()) if _ch.isalnum() else 0x20
PLAIN = bytes(_plain)
"""Translation of bytes: A-Z to lower case, other ASCII characters but digits and letters to spaces."""


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the lane's base and of its inverse modulo 2**64."""
    if lane not in _POWERS or len(_POWERS[lane][0]) < n:
        size = max(n, PIECE + 1)
        base = _BASE[lane]
        both = []
        for step in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, step, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if n > 4 * PIECE:
            return both[0], both[1]  # not kept
        _POWERS[lane] = (both[0], both[1])
    return _POWERS[lane]


class Words:
    """The words of several texts: ``starts`` and ``ends`` in ``data``, ``first`` word of each text
    (one more entry than texts), per lane a 64-bit hash of each word, and hashes of its first bytes."""

    def __init__(self, texts: list[bytes], lanes: int = 1, prefixes: tuple[int, ...] = ()):
        self.data = b" ".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=offsets[1:])
        whole = np.frombuffer(self.data, np.uint8)
        starts, ends, hashes, heads = [], [], [[] for _ in range(lanes)], [[] for _ in prefixes]
        at = 0
        while at < len(whole):
            to = min(at + PIECE, len(whole))
            while to < len(whole) and not SPACE[whole[to]]:  # a word is not cut
                to += 1
            part = whole[at:to]
            edge = np.flatnonzero(np.diff(SPACE[part], prepend=True, append=True))
            s, e = edge[::2], edge[1::2]
            starts.append(s + at)
            ends.append(e + at)
            for lane in range(lanes):
                up, down = _powers(lane, len(part) + 1)
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_BYTE[lane][part] * up[: len(part)], out=total[1:])
                h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
                for k in np.flatnonzero(e - s >= LONG_WORD).tolist():
                    digest = hashlib.blake2b(part[s[k] : e[k]].tobytes(), digest_size=8, salt=bytes([lane]))
                    h[k] = int.from_bytes(digest.digest(), "little")
                hashes[lane].append(h)
                for head, n in zip(heads, () if lane else prefixes, strict=False):
                    h = (total[np.minimum(s + n, e)] - total[s]) * down[s]
                    head.append(mix(h + np.uint64(n << 32)))
            at = to
        none = [np.zeros(0, np.int64)]
        self.starts, self.ends = np.concatenate(starts or none), np.concatenate(ends or none)
        self.hashes = [np.concatenate(h or [np.zeros(0, np.uint64)]) for h in hashes]
        self.prefixes = [np.concatenate(h or [np.zeros(0, np.uint64)]) for h in heads]
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def windows(hashes: np.ndarray, width: int, seed: int = 0x94D049BB133111EB) -> np.ndarray:
    """A hash of every ``width`` consecutive hashes."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * np.uint64(pow(seed, k + 1, 1 << 64))
    return mix(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done, reach = x, 1
    while reach * 2 <= width:
        done = np.minimum(done[:-reach], done[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


# --- Arrow -------------------------------------------------------------------------------------


def groups_of(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose ``column`` (binary, NULL as empty) holds about ``size`` bytes."""
    for batch in batches:
        texts = batch.column(column)
        lengths = np.array([0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()], np.int64)
        total, at = np.cumsum(lengths), 0
        while at < len(lengths):
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + size, "right")))
            part = batch.slice(at, to - at)
            yield part, [x or b"" for x in part.column(column).to_pylist()]
            at = to


@contextmanager
def small_batches(spark: SparkSession, size: str = "16m") -> Iterator[None]:
    """Inside, Arrow batches of jobs that run hold about ``size`` bytes, so that a batch of long texts is no larger than one of
    short ones. The session's own setting comes back at the end."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
