"""Repeated passages: every word covered by a window that an earlier document also holds is removed.

Super-k-mer partitioning. Each window of ``width`` words has a minimiser, the smallest hash among its
runs of ``seed`` words. Consecutive windows with one minimiser travel to the minimiser's bucket as one
packed string, so a text is sent about three times and not ``width`` times. The packed strings that a
task sends to a bucket form one compressed block. In the bucket words become numbers that are equal exactly
where the words are. All windows are sorted by a hash and by document, windows of one hash are compared number by
number, the first document of each run of equal windows is its owner, and the windows of later documents come
back as ranges.

Hot minimisers (a passage that a large share of the documents holds) would fill one bucket. They are
found in a sample of the rows, which decides on the way only and never on the result: their
windows leave the buckets and go by a 128-bit BLAKE2b digest of their words, with partial minima before the shuffle.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import Words, groups_of, mix, partitions_for, row_id, row_tag, sliding_min, windows

BUCKET_BYTES = 24 << 20
"""Packed text for a bucket."""
BLOCK_BYTES = 8 << 20
"""Text that a task gathers before it sends its blocks."""
HOT_SHARE = 0.25
"""A minimiser with more than this share of a mean bucket's packed strings is hot."""


def _single_spaced(texts: list[bytes]) -> list[bytes]:
    return [b" ".join(t.split()) for t in texts]  # bytes split at the white space of ASCII


def _runs(words: Words, width: int, seed: int):
    """First window, number of windows, text and minimiser of each super-k-mer."""
    h = words.hashes[0]
    if len(h) < width:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    low = sliding_min(windows(h, seed), width - seed + 1)
    text = words.text_of()[: len(low)]
    whole = words.left()[: len(low)] >= width
    new = np.ones(len(low) + 1, bool)
    new[1:-1] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    at = np.flatnonzero(new)
    first, count = at[:-1], np.diff(at)
    keep = whole[first]
    first, count = first[keep], count[keep]
    return first, count, text[first], low[first]


def _pack(rows: list[tuple[np.ndarray, ...]], texts: list[bytes]) -> bytes:
    """One block: numbers as differences, then the packed strings, all compressed."""
    doc, tag, start, count = (np.concatenate(x) for x in zip(*rows, strict=True))
    columns = [np.diff(doc, prepend=0), tag, start, count]
    head = np.array([len(doc)], np.int64).tobytes() + b"".join(c.astype(np.int64).tobytes() for c in columns)
    return zstandard.compress(head + b"\n".join(texts), 3)


def _unpack(block: bytes):
    raw = zstandard.decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    doc, tag, start, count = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
    return np.cumsum(doc), tag, start, count, raw[8 + 32 * n :].split(b"\n")


def _blocks(width: int, seed: int, buckets: int, hot: np.ndarray):
    """Task: documents to (bucket, block)."""

    def send(gathered) -> Iterator[pa.RecordBatch]:
        if gathered:
            keys = sorted(gathered)
            yield pa.record_batch({
                "bucket": pa.array(keys, pa.int64()),
                "block": pa.array([_pack(*gathered[k]) for k in keys], pa.binary()),
            })

    def task(batches):
        gathered: dict = {}
        held = 0
        for part, texts in groups_of(batches, "text"):
            ids, tags = part.column("_id").to_numpy(), part.column("_tag").to_numpy()
            words = Words(_single_spaced(texts))
            first, count, text, low = _runs(words, width, seed)
            if len(hot):
                cold = ~np.isin(low, hot)
                first, count, text, low = first[cold], count[cold], text[cold], low[cold]
            bucket = (mix(low) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            first, count, text, bucket = first[by], count[by], text[by], bucket[by]
            a, b = words.starts[first], words.ends[first + count + width - 2]
            strings = [words.data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            start = first - words.first[text]
            edge = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                rows, packed = gathered.setdefault(int(bucket[x]), ([], []))
                rows.append((ids[text[x:y]], tags[text[x:y]], start[x:y], count[x:y]))
                packed.extend(strings[x:y])
            held += len(words.data)
            if held >= BLOCK_BYTES:
                yield from send(gathered)
                gathered, held = {}, 0
        yield from send(gathered)

    return task


def _ranges(doc, tag, start, count):
    """Windows that follow one another in one document as ranges."""
    by = np.lexsort((start, tag, doc))
    doc, tag, start, count = doc[by], tag[by], start[by], count[by]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + count[:-1])
    at = np.flatnonzero(new)
    ends = np.maximum.reduceat(start + count, at) if len(at) else start  # rows equal in id and text give one window often
    return doc[at], tag[at], start[at], ends - start[at]


def _equal_windows(h: np.ndarray, at: np.ndarray, codes: np.ndarray, width: int):
    """Windows in an order that puts equal ones together, otherwise as they came, and where each run of equal
    ones begins. ``h`` is a hash of each window, ``at`` its first word in ``codes``."""
    by = np.argsort(h, kind="stable")
    start, new = at[by], np.ones(len(h), bool)
    new[1:] = h[by[1:]] != h[by[:-1]]
    same = np.flatnonzero(~new)
    one, two = start[same], start[same - 1]
    mixed = np.zeros(len(same), bool)
    for k in range(width):
        mixed |= codes[one + k] != codes[two + k]
    if mixed.any():  # one hash for different words: such runs are taken apart by their words
        run = np.cumsum(new)
        kind = np.zeros(len(h), np.int64)
        for r in np.unique(run[same[mixed]]).tolist():
            held = np.flatnonzero(run == r)
            _, which = np.unique(codes[start[held, None] + np.arange(width)], axis=0, return_inverse=True)
            kind[by[held]] = which.ravel()
        by = np.lexsort((kind, h))
        new[1:] = (h[by[1:]] != h[by[:-1]]) | (kind[by[1:]] != kind[by[:-1]])
    return by, new


def _bucket(width: int, hash_of=windows):
    """All blocks of one bucket to the ranges of windows that belong to an earlier document."""

    def group(blocks: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        codes, heads, n = [], [], 0
        for block in blocks.column("block").to_pylist():
            *head, strings = _unpack(block)
            heads.append(head)
            at = 0
            while at < len(strings):  # piece by piece, as each word is an object for a moment
                size, to = 0, at
                while to < len(strings) and (to == at or size < 1 << 20):
                    size += len(strings[to])
                    to += 1
                words = b" ".join(strings[at:to]).split(b" ")
                codes.append(np.fromiter(map(known.setdefault, words, itertools.count(n)), np.int32, len(words)))
                at, n = to, n + len(words)
        codes = np.concatenate(codes)
        doc, tag, start, count = map(np.concatenate, zip(*heads, strict=True))
        first = np.cumsum(count + width - 1) - (count + width - 1)
        in_order = np.argsort(doc, kind="stable")  # windows of earlier documents come first in each run
        each = count[in_order]
        string = np.repeat(in_order.astype(np.int32), each)
        step = np.arange(len(string)) - np.repeat(np.cumsum(each) - each, each)
        at = first[string] + step
        h = hash_of(mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), width)[at]
        by, new = _equal_windows(h, at, codes, width)
        owner = doc[string[by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]]]
        late = by[owner < doc[string[by]]]
        s = string[late]
        doc, tag, start, count = _ranges(doc[s], tag[s], start[s] + step[late], np.ones(len(late), np.int64))
        return pa.table({"_id": doc, "_tag": tag, "start": start, "n": count})

    return group


def _hot_windows(width: int, seed: int, hot: np.ndarray):
    """Task: the windows of hot minimisers, one by one."""

    def task(batches):
        for part, texts in groups_of(batches, "text"):
            ids, tags = part.column("_id").to_numpy(), part.column("_tag").to_numpy()
            words = Words(_single_spaced(texts))
            first, count, text, low = _runs(words, width, seed)
            chosen = np.isin(low, hot)
            first, count, text = first[chosen], count[chosen], text[chosen]
            steps = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            at, text = np.repeat(first, count) + steps, np.repeat(text, count)
            if len(at):
                ends = words.ends[at + width - 1].tolist()
                spelled = (words.data[a:b] for a, b in zip(words.starts[at].tolist(), ends, strict=True))
                yield pa.record_batch({
                    "h": pa.array([hashlib.blake2b(w, digest_size=16).digest() for w in spelled], pa.binary()),
                    "_id": ids[text], "_tag": tags[text], "start": at - words.first[text],
                })

    return task


def _minimisers(width: int, seed: int):
    """Task: how often each minimiser begins a super-k-mer."""

    def task(batches):
        for _, texts in groups_of(batches, "text"):
            low, n = np.unique(_runs(Words(texts), width, seed)[3], return_counts=True)
            yield pa.record_batch({"low": low.view(np.int64), "n": n.astype(np.int64)})

    return task


def repeated_windows(docs: DataFrame, width: int = 13, seed: int = 3, sample: int = 16) -> DataFrame:
    """(``_id``, ``_tag``, ``start``, ``n``): ranges of windows of a document that also start in a
    document of smaller id. ``docs`` has ``_id``, ``_tag`` and binary ``text``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = partitions_for(3.2 * size, BUCKET_BYTES, 4)
    tried = docs.where(F.rand(13) < 1 / sample)  # by row: rows of one id, or equal in id and text, may be a large share
    seen = tried.mapInArrow(_minimisers(width, seed), "low long, n long").groupBy("low").agg(F.sum("n").alias("n"))
    seen = seen.where("n > 8")
    # a minimiser of k words occurs in 1 of about 6 windows: strings in a mean bucket, as sampled
    mean = size / 6.5 / 6 / sample / buckets
    found = seen.where(F.col("n") > max(8, HOT_SHARE * mean)).select("low").collect()  # at most buckets / HOT_SHARE rows
    hot = np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))
    n_tasks = min(buckets, 4096)
    late = (
        docs.mapInArrow(_blocks(width, seed, buckets, hot), "bucket long, block binary")
        .repartition(n_tasks, "bucket")
        .groupBy("bucket").applyInArrow(_bucket(width), "_id long, _tag long, start long, n long")
    )
    if len(hot):
        single = docs.mapInArrow(_hot_windows(width, seed, hot), "h binary, _id long, _tag long, start long")
        owners = single.groupBy("h").agg(F.min("_id").alias("owner"))
        again = single.join(owners, "h").where("owner < _id")
        late = late.union(again.select("_id", "_tag", "start", F.lit(1).cast("long").alias("n")))
    return late


def _kept(width: int):
    """Task: texts and their ranges to what is left."""

    def task(batches):
        for batch in batches:
            total, gone, kept = [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                words = left = (text.as_py() or b"").split()  # bytes split at the white space of ASCII
                if ranges.is_valid:
                    start, n = (x.to_numpy() for x in ranges.values.flatten())
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + n + width - 1, -1)
                    left = [w for w, c in zip(words, np.cumsum(cover).tolist(), strict=False) if not c]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()),
            })

    return task


def remove_repeated(docs: DataFrame, width: int = 13, seed: int = 3, sample: int = 16) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text``.

    A word goes if a window of ``width`` words that covers it also starts in a document with a
    smaller id. Words are split at the white space of ASCII and compared as they are; windows are
    judged on the input. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.

    NULL or empty text: no words, nothing removed, kept text empty. Fewer than ``width`` words: kept
    whole. NULL id: after all other documents. Rows of one id: one document in the order of ids (none
    removes words of another), each row keeps its own words. Empty table: no rows. A text of any
    length is hashed piece by piece.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("_id"), row_tag(docs).alias("_tag"),
        F.col("text").cast("binary").alias("text"),
    )
    late = repeated_windows(rows.select("_id", "_tag", "text"), width, seed, sample)
    ranges = late.groupBy("_id", "_tag").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    joined = rows.join(ranges, ["_id", "_tag"], "left").select("doc_id", "text", "ranges")
    done = joined.mapInArrow(_kept(width), "doc_id long, n_words long, n_removed long, kept_text binary")
    return done.withColumn("kept_text", F.col("kept_text").cast("string"))
