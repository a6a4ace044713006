"""Periodic stretches of words (maximal repetitions) and texts without their later periods.

Scale-tiled distribution. The periods of an octave, P to 2P, are looked for at boundaries P words apart. A run of
exponent 3 or more spans so many of them that its first boundary b sees the same P words again at b + q, for its
period q. Such pairs (b, q) are found for all boundaries of a tile at once; their Z-functions, how far the words from b and
from b + q agree forwards (to 2P) and backwards (to P), are evaluated by halving steps over hashes of
1, 2, 4, ... words. What a tile finds, the words i with w[i] = w[i + q], is compared word by word, so no hash decides.

Tiles of one octave overlap: each covers a stretch of boundaries, P words before and 4P after them. A tile thus grows with its
octave, and a run that crosses tiles comes out as overlapping fragments of equal document and period.
These are shuffled by (document, period) and stitched to whole runs. Tiles of a text of up to ``LONG`` bytes are
solved where it is read; those of a longer one are dealt out over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.llm.common import groups_of, mix, row_id, row_tag

LONG = 1 << 20
"""Bytes of a text whose tiles are dealt out."""
STRETCH = 1 << 14
"""Words that the boundaries of one tile span, at least; 16 P for long periods."""
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_FRAGMENT = "_id long, _tag long, period long, a long, b long"


def _grown(h: np.ndarray, p: int) -> np.ndarray:
    """Hashes of 2p words from those of p."""
    return mix(h[:-p] * _PAIR + h[p:]) if len(h) > p else h[:0]


def _z(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, most: int, back: bool = False) -> np.ndarray:
    """How many words (at most ``most``) agree from places x < y on, or before them."""
    done = np.zeros(len(x), np.int64)
    for k in reversed(range(len(levels))):
        step, h = 1 << k, levels[k]
        if not len(h):
            continue
        i, j = (x - done - step, y - done - step) if back else (x + done, y + done)
        fits = (done + step <= most) & (i >= 0) & (j < len(h))
        same = fits & (h[np.where(fits, i, 0)] == h[np.where(fits, j, 0)])
        done[same] += step
    return done


def _true_parts(codes: np.ndarray, q: int, a: int, b: int) -> Iterator[tuple[int, int]]:
    """The stretches of [a, b) in which each word equals the one q later."""
    same = codes[a:b] == codes[a + q : b + q]
    if same.all():
        yield a, b
        return
    edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        yield a + s, a + e


def _is_power(block: np.ndarray) -> bool:
    """Whether a block is a shorter one several times over, so that its length is not its smallest period."""
    n = left = len(block)
    r = 2
    while left > 1:
        if r * r > left:
            r = left
        if left % r == 0:
            if np.array_equal(block[: n - n // r], block[n // r :]):
                return True
            while left % r == 0:
                left //= r
        r += 1
    return False


def _octave(codes, levels, p, first, last, ends, length, exponent) -> list[tuple[int, int, int]]:
    """Fragments (q, a, b) of periods p to 2p - 1 from the boundaries in [first, last): words a <= i < b equal those q later.
    ``ends``: whether the codes begin and end where their text does; else a fragment that reaches the tile's edge stays."""
    h, n = levels[-1], len(codes)
    last = min(last, n - 2 * p + 1)
    if last <= first:
        return []
    places = np.arange(first, last, p)
    reach = len(places) * p + p
    later = h[first + p : first + p + reach]
    if len(later) < reach:  # beyond the end nothing is equal: a text has no such hash twice by accident of padding
        later = np.concatenate([later, np.zeros(reach - len(later), np.uint64)])
    grid = np.lib.stride_tricks.as_strided(later, (len(places), p), (p * 8, 8))
    at, shift = np.nonzero(grid == h[places][:, None])
    if not len(at):
        return []
    b, q = places[at], p + shift
    inside = b + q + p <= n
    b, q = b[inside], q[inside]
    start = b - _z(levels, b, b + q, p, back=True)
    end = b + p + _z(levels, b + p, b + q + p, p)
    by = np.lexsort((b, q))
    q, start, end = q[by], start[by], end[by]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (start[1:] > end[:-1])
    heads = np.flatnonzero(new)
    if not len(heads):
        return []
    q, start, end = q[heads], start[heads], np.maximum.reduceat(end, heads)
    left = (start <= max(0, first - p)) & ~((start == 0) & ends[0])
    right = (end >= places[-1] + 2 * p) | ((end + q >= n) & (not ends[1]))
    enough = (end - start >= np.maximum(length - q, (exponent - 1) * q)) | left | right
    q, start, end, right = q[enough], start[enough], end[enough], right[enough]
    # two periods of one stretch that holds both together are multiples of a smaller or of the first one
    by = np.lexsort((q, np.where(right, end, end + q), right, start))
    q, start, end, right = q[by], start[by], end[by], right[by]
    close = np.where(right, end, end + q)
    own = np.ones(len(q), bool)
    own[1:] = (start[1:] != start[:-1]) | (right[1:] != right[:-1]) | (close[1:] != close[:-1])
    least = q[np.maximum.accumulate(np.where(own, np.arange(len(q)), 0))]
    own |= end + q - start < least + q
    found = []
    for x, s, e in zip(q[own].tolist(), start[own].tolist(), end[own].tolist(), strict=True):
        if not _is_power(codes[s : s + x]):
            found.extend((x, i, j) for i, j in _true_parts(codes, x, s, e))
    return found


def fragments(codes: np.ndarray, longest: int, length: int, exponent: int, stretch: int) -> list[tuple[int, int, int]]:
    """Fragments of all octaves whose runs fit into ``longest`` words, tile by tile."""
    found, levels, p = [], [mix(codes.astype(np.uint64) + _PAIR)], 1
    while exponent * p <= longest:
        step = max(stretch, 16 * p) // p * p
        for first in range(0, len(codes), step):
            found += _octave(codes, levels, p, first, min(first + step, len(codes)), (True, True), length, exponent)
        levels.append(_grown(levels[-1], p))
        p *= 2
    return found


def _codes(words: list[bytes], table: dict) -> np.ndarray:
    """Numbers that are equal exactly where the words are."""
    for w in words:
        table.setdefault(w, len(table))
    return np.fromiter(map(table.__getitem__, words), np.int64, len(words))


def _rows(ids, tags, firsts, found) -> pa.RecordBatch:
    q, a, b = (np.array(c, np.int64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    doc = np.searchsorted(firsts, a, "right") - 1
    return pa.record_batch({"_id": ids[doc], "_tag": tags[doc], "period": q, "a": a - firsts[doc], "b": b - firsts[doc]})


def _solve_texts(length: int, exponent: int, stretch: int):
    """Task: fragments of the runs of whole texts. Short texts go together, each closed by a word of its own."""

    def task(batches):
        for part, texts in groups_of(batches, "text"):
            table: dict = {}
            parts = [_codes(t.split(), table) for t in texts]
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            firsts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
            codes = np.full(int(sizes.sum()) + len(sizes), -1, np.int64)
            for f, c in zip(firsts.tolist(), parts, strict=True):
                codes[f : f + len(c)] = c
            codes[firsts + sizes] = len(table) + np.arange(len(sizes))
            found = fragments(codes, int(sizes.max()), length, exponent, stretch)
            yield _rows(part.column("_id").to_numpy(), part.column("_tag").to_numpy(), firsts, found)

    return task


def _cut_tiles(exponent: int, stretch: int):
    """Task: the tiles of each text: first word, the boundaries' stretch and its octaves, and the words' numbers."""
    shared = max(1, stretch // 16)

    def task(batches):
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                codes = _codes((text.as_py() or b"").split(), {}).astype(np.int32)
                n, p = len(codes), 1
                while exponent * p <= n:
                    top = p if p > shared else 1 << (min(shared, n // exponent).bit_length() - 1)
                    step = max(stretch, 16 * p) // top * top
                    for first in range(0, n, step):
                        a, b = max(0, first - top), min(n, first + step + 4 * top)
                        yield pa.record_batch({
                            "_id": batch.column("_id").slice(i, 1), "_tag": batch.column("_tag").slice(i, 1),
                            "low": [p], "top": [top], "start": [a], "first": [first - a], "last": [min(first + step, n) - a],
                            "closed": [b == n], "codes": pa.array([codes[a:b].tobytes()], pa.binary()),
                        })
                    p = 2 * top

    return task


_TILE = "_id long, _tag long, low long, top long, start long, first long, last long, closed boolean, codes binary"


def _solve_tiles(length: int, exponent: int):
    """Task: fragments of the octaves ``low`` to ``top`` of each tile."""

    def task(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                codes = np.frombuffer(row["codes"], np.int32).astype(np.int64)
                levels, p, found = [mix(codes.astype(np.uint64) + _PAIR)], 1, []
                while p <= row["top"]:
                    if p >= row["low"]:
                        ends = (row["start"] == 0, row["closed"])
                        found += _octave(codes, levels, p, row["first"], row["last"], ends, length, exponent)
                    levels.append(_grown(levels[-1], p))
                    p *= 2
                if found:
                    q, a, b = (np.array(c, np.int64) for c in zip(*found, strict=True))
                    one = np.ones(len(q), np.int64)
                    yield pa.record_batch({"_id": one * row["_id"], "_tag": one * row["_tag"], "period": q, "a": a + row["start"], "b": b + row["start"]})

    return task


def runs(docs: DataFrame, length: int = 6, exponent: int = 4, long: int = LONG, stretch: int = STRETCH) -> DataFrame:
    """(``_id``, ``_tag``, ``start``, ``length``, ``period``): every run of every text once. ``docs`` has ``_id``, ``_tag`` and
    binary ``text``; rows equal in all three give their runs once."""
    if exponent < 3:
        raise ValueError("runs of an exponent below 3 need not show at a boundary of their octave")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    near = docs.where(n_bytes <= long).mapInArrow(_solve_texts(length, exponent, stretch), _FRAGMENT)
    tiles = docs.where(n_bytes > long).mapInArrow(_cut_tiles(exponent, stretch), _TILE).repartition("_id", "_tag", "low", "start")
    far = tiles.mapInArrow(_solve_tiles(length, exponent), _FRAGMENT)
    pieces = near.union(far).distinct()
    ordered = Window.partitionBy("_id", "_tag", "period").orderBy("a", "b")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.coalesce((F.col("a") > F.max("b").over(earlier)).cast("int"), F.lit(1))
    islands = pieces.withColumn("_gap", gap).withColumn("_island", F.sum("_gap").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("_id", "_tag", "period", "_island").agg(F.min("a").alias("start"), F.max("b").alias("_b"))
    whole = whole.withColumn("length", F.col("_b") - F.col("start") + F.col("period"))
    enough = (F.col("length") >= length) & (F.col("length") >= exponent * F.col("period"))
    return whole.where(enough).select("_id", "_tag", "start", "length", "period")


def _collapsed(batches):
    """Task: texts and their runs to the words left, and the run of greatest exponent."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for part, texts in groups_of(batches, "text"):
        n_words, left, best = [], [], []
        for text, found in zip(texts, part.column("runs").to_pylist(), strict=True):
            words = text.split()
            n_words.append(len(words))
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for r in found:
                    gone[r["start"] + r["period"]] += 1
                    gone[r["start"] + r["length"]] -= 1
                words = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
            left.append(b" ".join(words))
            best.append(max(found, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"])) if found else None)
        yield pa.record_batch({
            "doc_id": part.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "runs": part.column("runs"),
            "strongest": pa.array(best, run), "collapsed_text": pa.array(left, pa.binary()),
        })


def collapse(docs: DataFrame, length: int = 6, exponent: int = 4, long: int = LONG, stretch: int = STRETCH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period),
    ``strongest`` (the run of greatest length / period; ties by start, then period; NULL without runs) and
    ``collapsed_text``: words that a run contains after its first period are gone, the others joined by a space.

    A run is a stretch of words with smallest period q, at least ``length`` and ``exponent`` * q long, that no
    neighbouring word extends. Words are split at the white space of ASCII and compared as they are. NULL
    or empty text: no words, no runs, collapsed text empty. Rows of one id are told apart by their texts; repeated
    rows each give a row. NULL ids are kept. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    Empty table: no rows. A text of any length is used whole; a tile takes some 100 bytes of memory a word.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("_id"), row_tag(docs).alias("_tag"),
        F.col("text").cast("binary").alias("text"),
    )
    found = runs(rows.select("_id", "_tag", "text"), length, exponent, long, stretch)
    listed = found.groupBy("_id", "_tag").agg(F.collect_list(F.struct("start", "period", "length")).alias("runs"))
    listed = listed.withColumn("runs", F.transform(F.array_sort("runs"), lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))))
    joined = rows.join(listed, ["_id", "_tag"], "left")
    none = F.array().cast("array<struct<start:long,length:long,period:long>>")
    run = "struct<start:long,length:long,period:long>"
    done = joined.select("doc_id", "text", F.coalesce("runs", none).alias("runs")).mapInArrow(
        _collapsed, f"doc_id long, n_words long, runs array<{run}>, strongest {run}, collapsed_text binary"
    )
    return done.withColumn("collapsed_text", F.col("collapsed_text").cast("string"))


def planted(docs: DataFrame, share: int = 10) -> DataFrame:
    """``docs`` in which some texts repeat: with h = crc32(doc_id) and g = h // ``share``, each word i >= a of a text with
    h % ``share`` = 0 becomes word a + (i - a) % p, where a = g % n, p = 1 + (n - a) // (3 + g % 8), n its words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / share)
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")

    def again(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        whole = F.flatten(F.array_repeat(F.slice(w, a + 1, p), (F.floor((n - a) / p) + 1).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(whole, F.lit(1), n - a)), " ")

    # the one-element array binds the words, which are then split once
    text = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, again(w)).otherwise("")), 1)
    return docs.withColumn("text", F.when((h % share == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")))
