"""An index of the keys that earlier batches committed, on shared storage.

The keys of a batch are one run. ``fanout`` runs of neighbouring batches merge into one of the next level, so batch n is covered
by at most (fanout - 1) * log(n) runs, whose names follow from n alone: nothing is listed. A run is cut into
parts by the hash of the key, one file each, and has a Bloom filter of some sixteen bits a key: each key sets four bits of one
64-bit word, so building it is one sum of words and asking it one lookup. A batch of few keys first meets the filters; only the parts that may
hold one of its keys are opened. A batch of many keys would open every part for the filters' errors alone, and opens them at once. Keys are
then compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.sources.catalog import remove

WORD = 64
"""Bits of one word of a filter."""
PER_KEY = 16
PROBES = 4
FEW = 1 << 12
"""A batch of more keys than this does not ask the filters: one key in some hundred is taken for known, so all parts would be opened."""


def _mask(h):
    """The bits that a key sets in its word."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(h, F.lit(i)), F.lit(WORD)).cast("int"))
    mask = bit(0)
    for i in range(1, PROBES):
        mask = mask.bitwiseOR(bit(i))
    return mask


class KeyIndex:
    """``held`` says which keys batches before this one committed, ``add`` commits those of a batch.

    Both may be repeated for the same batch, as a replay does: the same files come out. Batches are numbered
    from 0 without gaps. Key columns may hold NULL, which equals NULL."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], fanout: int = 8, parts: int = 16):
        self.spark, self.root, self.key, self.fanout, self.parts = spark, root.rstrip("/"), list(key), fanout, parts
        self.opened: list[str] = []
        """Parts that the last ``held`` read."""
        self._words: dict[str, int] = {}  # words for each part of the runs written or met so far

    def runs(self, before: int) -> Iterator[tuple[int, int]]:
        """(level, first batch) of the runs that cover the batches before this one, the largest first."""
        level, first = 0, 0
        while self.fanout ** (level + 1) <= before:
            level += 1
        while first < before:
            while first + self.fanout**level > before:
                level -= 1
            yield level, first
            first += self.fanout**level

    def _path(self, kind: str, level: int, first: int) -> str:
        return f"{self.root}/{kind}/level={level}/first={first}"

    def _read(self, schema, paths: list[str]) -> DataFrame:
        """Files below the paths, whose names are not columns."""
        return self.spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*paths)

    def _hashed(self, keys: DataFrame) -> DataFrame:
        h = F.xxhash64(*self.key)
        return keys.select(*self.key, h.alias("_h")).withColumn("part", F.pmod(F.col("_h"), F.lit(self.parts)).cast("int"))

    def held(self, keys: DataFrame, before: int) -> DataFrame | None:
        """The distinct ``keys`` that were committed before batch ``before``; None if there are no earlier batches."""
        runs = list(self.runs(before))
        self.opened = []
        if not runs:
            return None
        asked = self._hashed(keys.select(*self.key).distinct())
        schema = keys.select(*self.key).schema
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.key]
        among = lambda paths: asked.select(*self.key).alias("a").join(self._read(schema, paths).alias("b"), same, "left_semi")
        if asked.count() > FEW:
            self.opened = [self._path("keys", *r) for r in runs]
            return among(self.opened)
        filters = self._read("run string, part int, words long, word long, bits long", [self._path("filters", *r) for r in runs])
        names = [f"level={level}/first={first}" for level, first in runs]
        if any(run not in self._words for run in names):  # after a restart; one row for each run
            self._words |= dict.fromkeys(names, 1) | dict(map(tuple, filters.select("run", "words").distinct().collect()))
        known = [(run, self._words[run]) for run in names]
        each_run = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.lit(n).cast("long").alias("words")) for r, n in known]))
        each = asked.select("_h", "part").distinct().select("_h", "part", each_run.alias("r")).select("_h", "part", "r.*")
        each = each.select("run", "part", F.pmod(F.shiftright("_h", 20), F.col("words")).alias("word"), _mask(F.col("_h")).alias("mask"))
        hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        maybe = each.join(filters.drop("words"), ["run", "part", "word"]).where(hit).select("run", "part").distinct()
        found = sorted((r.run, r.part) for r in maybe.collect())  # at most one row for each part of each run
        self.opened = [f"{self.root}/keys/{run}/part={part}" for run, part in found]
        if not found:
            return self.spark.createDataFrame([], schema)
        return among(self.opened)

    def _write(self, keys: DataFrame, level: int, first: int) -> None:
        run = f"level={level}/first={first}"
        rows = self._hashed(keys).repartition("part")
        rows.drop("_h").sortWithinPartitions("part", *self.key).write.mode("overwrite").partitionBy("part").parquet(self._path("keys", level, first))
        stored = self._hashed(self._read(keys.schema, [self._path("keys", level, first)]))
        n = stored.count()
        words = self._words[run] = max(1, -(-n * PER_KEY // (WORD * self.parts)))
        made = stored.groupBy("part", F.pmod(F.shiftright("_h", 20), F.lit(words)).cast("long").alias("word")).agg(F.bit_or(_mask(F.col("_h"))).alias("bits"))
        made = made.select(F.lit(run).alias("run"), "part", F.lit(words).cast("long").alias("words"), "word", "bits")
        made.write.mode("overwrite").parquet(self._path("filters", level, first))

    def add(self, keys: DataFrame, batch: int) -> None:
        """Commit the ``keys`` of ``batch``, and merge the runs it completes."""
        if batch % self.fanout == 0 and batch:  # the batch that merged these is committed, so no replay needs them
            self._forget(batch)
        self._write(keys.select(*self.key).distinct(), 0, batch)
        level = 1
        while (batch + 1) % self.fanout**level == 0:
            span, first = self.fanout ** (level - 1), batch + 1 - self.fanout**level
            paths = [self._path("keys", level - 1, first + i * span) for i in range(self.fanout)]
            schema = keys.select(*self.key).schema
            whole = self._read(schema, paths)
            self._write(whole, level, first)
            level += 1

    def _forget(self, batch: int) -> None:
        level = 1
        while batch % self.fanout**level == 0:
            span, first = self.fanout ** (level - 1), batch - self.fanout**level
            for i in range(self.fanout):
                for kind in ("keys", "filters"):
                    remove(self.spark, self._path(kind, level - 1, first + i * span))
            level += 1
