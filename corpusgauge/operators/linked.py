"""Sums along linked lists, in rounds that grow with the logarithm of their length.

An element knows only its successor. Chains of elements that lie side by side are contracted where they are
read, then elements are swallowed by their predecessors by coin tosses (one in four each round), until
so few are left that one task ranks them. The swallowed ones are then placed in the reverse order. The work of
all rounds together is in proportion to the number of elements.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.session import cut

AT_ONCE = 1 << 18
"""Elements that one task ranks (some 40 bytes each)."""


def _jump(ids: np.ndarray, successors: np.ndarray, weights: list[np.ndarray]):
    """Head of each element's chain among these elements, sums before it there, and whether it ends one."""
    n = len(ids)
    by = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids[by], successors), n - 1)
    inner = ids[by][at] == successors
    before = np.full(n, -1)
    before[by[at[inner]]] = np.flatnonzero(inner)
    first = before < 0
    head = np.where(first, np.arange(n), before)
    sums = [np.where(first, w.dtype.type(0), w[before]) for w in weights]
    while True:
        far = head[head]
        if (far == head).all():
            return head, sums, ~inner
        sums = [s + s[head] for s in sums]
        head = far


def _chains(values: Sequence[str]):
    """Task: chains inside each batch become their heads; the others keep their place behind the head."""

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, successors = (batch.column(c).to_numpy() for c in ("id", "next"))
            weights = [batch.column(v).to_numpy() for v in values]
            head, sums, ends = _jump(ids, successors, weights)
            tail = np.zeros(len(ids), np.int64)
            tail[head[ends]] = np.flatnonzero(ends)
            leads = head == np.arange(len(ids))
            yield pa.record_batch({
                "id": ids, "head": ids[head], "next": np.where(leads, successors[tail], -1),
                **{v: np.where(leads, s[tail] + w[tail], s) for v, s, w in zip(values, sums, weights, strict=True)},
            })

    return task


def _ranked(values: Sequence[str]):
    """Task: the sums before each of the few elements that are left."""

    def task(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            ids, successors = (whole.column(c).to_numpy() for c in ("id", "next"))
            _, sums, _ = _jump(ids, successors, [whole.column(v).to_numpy() for v in values])
            yield pa.record_batch({"id": ids, **dict(zip(values, sums, strict=True))})

    return task


def list_sums(links: DataFrame, values: Sequence[str], home: Sequence[Column | str] = (), at_once: int = AT_ONCE) -> DataFrame:
    """(``id``, one column for each of ``values``): the sum of the values of all elements before this one.

    ``links`` holds one row for each element of one or more lists: ``id`` (unique, 0 or more), ``next`` (id of its
    successor, NULL at an end) and ``values`` (long or double, no NULL). Elements of one ``home`` are read
    together, so a list whose neighbours mostly share one shrinks before the first join. Rings do not end.
    """
    kinds = dict(links.dtypes)
    schema = "id long, head long, next long, " + ", ".join(f"{v} {kinds[v]}" for v in values)
    rows = links.select("id", F.coalesce("next", F.lit(-1).cast("long")).alias("next"), *values, *[F.col(h).alias(f"_h{i}") if isinstance(h, str) else h.alias(f"_h{i}") for i, h in enumerate(home)])
    if home:
        keys = [f"_h{i}" for i in range(len(home))]
        rows = rows.repartition(*keys).sortWithinPartitions(*keys, "id")
    placed = cut(rows.select("id", "next", *values).mapInArrow(_chains(values), schema), "chains")
    behind = [placed.where("id != head")]
    left = placed.where("id = head").drop("head")
    n, toss = left.count(), 0
    while n > at_once:
        toss += 1
        coin = lambda c: F.xxhash64(F.col(c), F.lit(toss)) % 2 == 0  # noqa: E731, B023
        met = left.where(~coin("id")).select(F.col("id").alias("gone"), F.col("next").alias("_next"), *[F.col(v).alias(f"_{v}") for v in values])
        taken = left.join(met, (F.col("next") == F.col("gone")) & coin("id"), "left")
        taken = cut(taken, "mates")
        swallowed = taken.where("gone is not null").select(F.col("gone").alias("id"), F.col("id").alias("head"), *values)
        behind.append(swallowed)
        sums = [(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).cast(kinds[v]).alias(v) for v in values]
        grown = taken.select("id", F.when(F.col("gone").isNotNull(), F.col("_next")).otherwise(F.col("next")).alias("next"), *sums)
        left = cut(grown.join(swallowed.select("id"), "id", "left_anti"), "mates")
        n = left.count()
    few = "id long, " + ", ".join(f"{v} {kinds[v]}" for v in values)
    known = left.repartition(1).mapInArrow(_ranked(values), few)
    for later in reversed(behind):
        known = cut(known, "places")
        far = known.select(F.col("id").alias("head"), *[F.col(v).alias(f"_{v}") for v in values])
        found = later.join(far, "head").select("id", *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in values])
        known = known.union(found)
    return known
