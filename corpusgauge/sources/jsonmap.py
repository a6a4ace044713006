"""One JSON map of any size, read by many tasks.

The text source cuts a file into byte ranges and each range into pieces that end in a closing brace. What a
range does to the reader's state is a function of the state at its start that needs few numbers: whether it turns
inside and outside of strings round, and by how much it changes the depth from either side. These functions are
composed over the ranges (one small row each), so every range learns the state it begins in. A second
pass then cuts the entries at depth one. Entries that cross a range come out in fragments, which meet by the range in
which their entry begins. No task holds a file, and an entry is held whole only once it is a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusgauge.session import cut

_QUOTE, _SLASH, _COMMA = 0x22, 0x5C, 0x2C
_STEP = np.zeros(256, np.int64)
_STEP[[0x7B, 0x5B]], _STEP[[0x7D, 0x5D]] = 1, -1
_MARK = _STEP != 0
_MARK[_COMMA] = True


def _quotes(text: np.ndarray) -> np.ndarray:
    """Places of the quotes that no backslash escapes."""
    at = np.flatnonzero(text == _QUOTE)
    slashed = at[(at > 0) & (text[np.maximum(at, 1) - 1] == _SLASH)]
    if not len(slashed):
        return at
    other = np.flatnonzero(text != _SLASH)
    before = np.searchsorted(other, slashed) - 1  # last byte before the run of backslashes
    run = slashed - 1 - np.where(before >= 0, other[before], -1)
    return np.setdiff1d(at, slashed[run % 2 == 1], assume_unique=True)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """(file, start of range) and the next bytes of it."""
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        keys = list(zip(files, starts, strict=True))
        at = 0
        while at < len(keys):
            to = at + 1
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            yield keys[at], b"".join(x + b"}" for x in batch.column("piece").slice(at, to - at).to_pylist())
            at = to


def _effects(batches):
    """Task: what each stretch of a range does: ``turns`` of strings, change of depth from outside and inside a string."""
    for (file, block), data in _pieces(batches):
        text = np.frombuffer(data, np.uint8)
        quotes = _quotes(text)
        brackets = np.flatnonzero(_STEP[text])
        inside = np.searchsorted(quotes, brackets) % 2 == 1
        step = _STEP[text[brackets]]
        yield pa.record_batch({
            "file": [file], "block": [block], "turns": [len(quotes) % 2],
            "outer": [int(step[~inside].sum())], "inner": [int(step[inside].sum())],
        })


def _starts(effects: list) -> tuple[dict, list[str]]:
    """State (inside a string, depth) at the start of each range, and the files that do not end outside at depth 0."""
    states, ends = {}, {}
    for r in effects:  # ordered by file, range and stretch
        inside, depth = ends.get(r.file, (0, 0))
        states.setdefault((r.file, r.block), (inside, depth))
        ends[r.file] = (inside ^ r.turns, depth + (r.inner if inside else r.outer))
    # a file that ends in white space has one brace more, which closes the last piece
    return states, [f for f, (inside, depth) in ends.items() if inside or depth not in (0, -1)]


def _cut_entries(states: dict):
    """Task: the entries of a range and the fragments at its ends."""

    def rows(key, n, parts, opened, closed):
        return {"file": key[0], "block": key[1], "n": n, "entry": b"".join(parts), "opened": opened, "closed": closed}

    def task(batches):
        key, out, size = None, [], 0

        for now, data in _pieces(batches):
            if now != key:
                if key is not None and depth > 0:
                    out.append(rows(key, n, parts, opened, False))
                key, n, parts = now, 0, []
                inside, depth = states[now]
                opened, done = False, False
            if done:
                continue
            text = np.frombuffer(data, np.uint8)
            quotes = _quotes(text)
            marks = np.flatnonzero(_MARK[text])
            marks = marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]
            step = _STEP[text[marks]]
            after = depth + np.cumsum(step)
            edge = ((step == 0) & (after == 1)) | ((step == 1) & (after == 1)) | ((step == -1) & (after == 0))
            at = 0
            for place, level in zip(marks[edge].tolist(), after[edge].tolist(), strict=True):
                begins = data[place] not in (_COMMA, 0x7D)
                if not begins:
                    parts.append(data[at:place])
                    out.append(rows(key, n, parts, opened, True))
                    size += len(out[-1]["entry"])
                n, parts, opened, at = n + 1, [], True, place + 1
                if level == 0:
                    done = True
                    break
            if not done:
                parts.append(data[at:])
            inside ^= len(quotes) % 2
            depth = 0 if done else (int(after[-1]) if len(after) else depth)
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                out, size = [], 0
        if key is not None and depth > 0:
            out.append(rows(key, n, parts, opened, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return task


_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("entry", pa.binary()), ("opened", pa.bool_()), ("closed", pa.bool_())])
_DDL = "file string, block long, n long, entry binary, opened boolean, closed boolean"


def read_json_map(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``block``, ``n``, ``entry``): each entry of the JSON map in every file under ``path``, as a map of its own
    (``{"key": value}``) that ``from_json`` can read. (``block``, ``n``) is the order within the file.

    Entries are not parsed here: nested values, braces and commas in strings and escaped quotes are passed over. A file
    that does not close what it opens raises. White space around the map is allowed, an empty map has no rows. The size of a range is
    ``spark.sql.files.maxPartitionBytes``; the driver keeps one small row for each, as it does to plan the scan.
    """
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))
    effects = pieces.mapInArrow(_effects, "file string, block long, turns long, outer long, inner long")
    # stretches of a range are in one task one after another, so their number within it is their order
    effects = effects.withColumn("at", F.monotonically_increasing_id()).orderBy("file", "block", "at").collect()
    states, broken = _starts(effects)
    if broken:
        raise ValueError(f"{len(broken)} files are no closed JSON map, the first is {sorted(broken)[0]}")
    found = cut(pieces.mapInArrow(_cut_entries(states), _DDL), "entries")
    whole = found.where("opened and closed").select("file", "block", "n", "entry")
    crossing = found.where("not (opened and closed)")
    so_far = Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, 0)
    owner = crossing.select("file", "block", "n", F.last(F.when(F.col("opened"), F.struct("block", "n")), ignorenulls=True).over(so_far).alias("owner"))
    joined = crossing.join(owner, ["file", "block", "n"]).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "n", "entry"))).alias("parts"))
    bytes_of = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["entry"]))
    joined = joined.select("file", "owner.block", "owner.n", bytes_of.alias("entry"))
    texts = whole.union(joined).withColumn("entry", F.col("entry").cast("string"))
    return texts.where(F.col("entry").rlike(r"\S")).withColumn("entry", F.concat(F.lit("{"), "entry", F.lit("}")))


def write_json_map(df: DataFrame, key: str, value: str, path: str) -> None:
    """One JSON map a partition: ``value`` (JSON text) under ``key``."""
    def task(batches):
        first = True
        for batch in batches:
            rows = []
            for entry in batch.column("entry").to_pylist():
                rows.append(("{" if first else ",") + entry)
                first = False
            yield pa.record_batch({"value": pa.array(rows, pa.string())})
        yield pa.record_batch({"value": pa.array(["{}" if first else "}"])})

    name = F.to_json(F.array(F.col(key).cast("string")))  # quoted and escaped
    entries = df.select(F.concat(F.substring(name, 2, F.length(name) - 2), F.lit(": "), F.col(value)).alias("entry"))
    entries.mapInArrow(task, "value string").write.text(path)
