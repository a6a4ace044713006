"""Prefix tree of conversations, with totals of every subtree by the Euler-tour technique.

A turn is known by a digest of its role and text. The digests, each bound to its place, are added up along a
conversation in five lanes of 32 bits, so the sums up to a turn name its whole prefix, and the sums without
the turn name the parent: no prefix is ever spelled out. Equal prefixes are one node.

Every node has an enter and an exit arc. Enter leads to the first child (to the own exit from a leaf), exit to
the next sibling (to the parent's exit after the last child). The arcs form one list, the tour. It is ranked in
rounds that swallow a fixed share of the list each (``operators.linked``), with the number of leaves and the
saving as weights: the total of a subtree is the difference between the prefix sums at its two arcs.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators.linked import AT_ONCE, list_sums
from corpusgauge.operators.ordering import in_order, neighbour, running_totals
from corpusgauge.session import cut

LANES = 5
ROOT = "0" * 8 * LANES
STRETCH = 1 << 12
"""Turns of one conversation that start out in one place for the ranking."""
PACK = 1 << 13
"""Conversation ids that are joined into one string before they meet those of other tasks."""


def numbered(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``pos``, ``digest``, ``chars``): the turns of each conversation in order, from 0.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not read. A NULL turn
    comes first; equal turns follow the digests of role and text, so the order is the same in every run. NULL role
    or text count as empty. Rows with a NULL ``conv_id`` belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        own.alias("digest"), F.char_length(text).cast("long").alias("chars"),
    )
    tagged = in_order(rows, [F.asc_nulls_first("turn"), "digest"], ["conv_id"])
    counted = running_totals(tagged, {"pos": F.lit(1).cast("long")}, ["conv_id"])
    return cut(counted.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "chars"), "turns")


def _named(rows: DataFrame) -> DataFrame:
    """Rows with ``key``, the name of the prefix that ends in them, and ``parent_key``."""
    whole = F.sha2(F.concat_ws(":", "digest", "pos"), 256)
    own = [F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long") for k in range(LANES)]
    tagged = in_order(rows.withColumn("_h", whole), ["pos"], ["conv_id"])
    sums = running_totals(tagged, {f"_s{k}": x for k, x in enumerate(own)}, ["conv_id"])
    spelled = lambda lanes: F.concat(*[F.lpad(F.hex(F.pmod(x, F.lit(1 << 32))), 8, "0") for x in lanes])
    up = [F.col(f"_s{k}") for k in range(LANES)]
    return sums.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "chars", spelled(up).alias("key"),
        spelled([s - x for s, x in zip(up, own, strict=True)]).alias("parent_key"),
    )


def _packs(batches):
    """Task: sorted (key, conv_id) to strings of ids, cut at ``PACK`` ids."""
    key, first, held = None, None, []
    for batch in batches:
        out = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held and (k != key or len(held) == PACK):
                out.append((key, first, ",".join(held)))
                held = []
            if not held:
                key, first = k, c
            held.append(str(c))
        if out:
            yield pa.record_batch(dict(zip(("key", "first", "names"), map(list, zip(*out, strict=True)), strict=True)))
    if held:
        yield pa.record_batch({"key": [key], "first": [first], "names": [",".join(held)]})


def _digests(batches):
    """Task: sorted strings of one key after another to the digest of their whole."""
    key, digest = None, None
    for batch in batches:
        out = []
        for k, names in zip(batch.column("key").to_pylist(), batch.column("names").to_pylist(), strict=True):
            if k == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            digest.update(names.encode())
        if out:
            yield pa.record_batch(dict(zip(("key", "ends_sha256"), map(list, zip(*out, strict=True)), strict=True)))
    if key is not None:
        yield pa.record_batch({"key": [key], "ends_sha256": [digest.hexdigest()]})


def _ends(named: DataFrame, members: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids that end in a node, ascending. The ids of a node that holds a large share
    of all conversations are joined in many tasks, and their strings pass through the last one as a stream."""
    last = named.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    ends = members.join(last, "conv_id", "left").select("conv_id", F.coalesce("key", F.lit(ROOT)).alias("key"))
    packs = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packs = packs.mapInArrow(_packs, "key string, first long, names string")
    done = packs.repartition("key").sortWithinPartitions("key", "first")
    return done.mapInArrow(_digests, "key string, ends_sha256 string")


def prefix_trie(rows: DataFrame, members: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree: one less than the members, times the characters of the last
    turn: what is not computed again when prefixes are shared) and ``ends_sha256``.

    ``rows``: ``conv_id``, ``pos`` from 0 without gaps, ``digest``, ``chars``, as ``numbered`` gives them. ``members``:
    every ``conv_id`` once; one without rows ends in the root. Repeated turns are turns of their own.
    No conversations: no rows. Other columns are not read, so they cannot clash.
    """
    members = members.select("conv_id").where("conv_id is not null").distinct()
    named = cut(_named(rows), "prefixes")
    found = named.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.max("parent_key").alias("parent_key"),
    )
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("chars"), F.lit(None).cast("string").alias("parent_key"),
    )
    nodes = cut(found.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(F.col("key").alias("parent_key"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tree = cut(nodes.join(above, "parent_key", "left").drop("parent_key"), "tree")
    below = tree.where("parent is not null").select("parent", "id")
    kids = below.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first"))
    after = neighbour(below, ["id"], F.col("id"), "after", ["parent"]).select("id", "after")
    tied = tree.join(kids.withColumnRenamed("parent", "id"), "id", "left").join(after, "id", "left")
    tied = cut(tied.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    leaf = (F.col("n_children") == 0).cast("long")
    none = F.lit(0).cast("long")
    arcs = tied.select("conv_id", F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"), F.explode(F.array(
        F.struct(enter.alias("id"), F.coalesce(F.col("first") * 2, leave).alias("next"), leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")),
        F.struct(leave.alias("id"), F.coalesce(F.col("after") * 2, F.col("parent") * 2 + 1).alias("next"), none.alias("leaves"), none.alias("saved")),
    )).alias("arc")).select("conv_id", "stretch", "arc.*")
    sums = list_sums(arcs, ["leaves", "saved"], ["conv_id", "stretch"], at_once)
    way = F.when(F.col("id") % 2 == 1, 1).otherwise(-1)
    totals = sums.groupBy(F.shiftright("id", 1).alias("id")).agg(
        F.sum(F.col("leaves") * way).alias("n_leaves"), F.sum(F.col("saved") * way).alias("saved_tokens")
    )
    done = tied.join(totals, "id").join(_ends(named, members), "key", "left")
    return done.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def spliced(rows: DataFrame, group: int, most: int) -> DataFrame:
    """``rows`` as ``numbered`` gives them, with the first turns of each conversation c replaced by those of the
    conversation c - c % ``group``: h of them, or all if it has fewer, where h is crc32(c) % ``most``."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    head = F.col("conv_id") - F.col("conv_id") % group
    heads = rows.where(F.col("conv_id") % group == 0).where(F.col("pos") < most - 1).groupBy(F.col("conv_id").alias("head")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("lead")  # fewer than ``most``
    )
    convs = rows.select("conv_id").distinct().withColumns({"h": h, "head": head}).join(heads, "head", "left")
    convs = convs.withColumn("lead", F.coalesce(F.slice("lead", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:long,digest:string,chars:long>>")))
    led = convs.select("conv_id", F.explode("lead").alias("t")).select("conv_id", "t.*")
    own = rows.withColumn("h", h).where("pos >= h").join(convs.select("conv_id", F.size("lead").alias("k")), "conv_id")
    return led.union(own.select("conv_id", F.col("pos") - F.col("h") + F.col("k"), "digest", "chars"))
