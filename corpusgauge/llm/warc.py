"""Fixity audit of web archives by Merkle trees.

Records are put in the order of their key, a range of keys to an archive file, each record at an
offset. A leaf is the hash of a record with its offset range; ``fanout`` neighbours in the order of offsets hash to a node of
the next level, up to one root for a file, and on over the files to one root for the replica. Two replicas
are compared from the roots down: on each level only children of nodes that differ are read, so intact
branches cost nothing below the level where they agree. What differs at the leaves is then aligned by key and digest, so
one record that is lost or put in leaves those after it as they are, moved to another offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import NO_ID
from corpusgauge.operators.ordering import in_order, row_numbers, running_totals
from corpusgauge.session import cut

FANOUT = 16
PER_FILE = 1024
"""Slots of a file: record keys that differ only in the last so many numbers share one."""


def record(url: Column, body: Column) -> Column:
    """The bytes of a response record. NULL is an empty field."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", per_file: int = PER_FILE) -> DataFrame:
    """One row per row of ``pages``: ``file``, ``slot`` (place in the file), ``key``, ``start``, ``length`` and
    ``digest`` (SHA-256) of its record.

    A file holds the keys of one range of ``per_file`` numbers, ordered by key and then by digest; records of NULL
    key form the files with negative numbers, dealt by digest. A file may hold any share of all records, repeated ones
    too: slots and offsets are running sums over chunks of the ordered records. Only the three named columns are
    read, so others cannot clash.
    """
    made = pages.select(F.col(key).cast("long").alias("key"), record(F.col(url), F.col(body)).cast("binary").alias("record"))
    made = made.select("key", F.sha2("record", 256).alias("digest"), F.octet_length("record").cast("long").alias("length"))
    lost = -1 - F.pmod(F.xxhash64("digest"), F.lit(1 << 20))
    placed = made.withColumn("file", F.coalesce(F.floor(F.col("key") / per_file), lost))
    # equal records are ordered by where they were read, which changes no slot's content, so they may spread
    tagged = in_order(placed.withColumn("_row", F.monotonically_increasing_id()), ["key", "digest", "_row"], ["file"])
    sums = running_totals(tagged, {"_n": F.lit(1).cast("long"), "_upto": F.col("length")}, ["file"])
    return sums.select("file", (F.col("_n") - 1).alias("slot"), "key", (F.col("_upto") - F.col("length")).alias("start"), "length", "digest")


def trees(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], int]:
    """Levels of the trees of two replicas, the leaves first: (replica, file, place, hash). From the level
    of the files' roots on, ``file`` is NULL and ``place`` counts files. The last level has one place, 0.
    Also the number of that first level over files.

    A leaf hashes offset, length and digest. Children are hashed with their places, in order."""
    leaf = F.sha2(F.concat_ws(":", "start", "length", "digest").cast("binary"), 256)
    leaves = [r.select(F.lit(n).alias("replica"), "file", F.col("slot").cast("long").alias("place"), leaf.alias("hash")) for n, r in enumerate((first, second))]
    levels, whole, turn = [cut(leaves[0].union(leaves[1]), "tree")], False, 0
    while True:
        last = levels[-1]
        most = last.agg(F.max("place")).first()[0] or 0
        if whole and most == 0:
            return levels, turn
        if not whole and most == 0:
            # numbers below 0 to odd places, the others to even ones
            place = F.when(F.col("file") >= 0, 2 * F.col("file")).otherwise(-2 * F.col("file") - 1)
            whole, turn = True, len(levels)
            levels.append(last.select("replica", F.lit(None).cast("long").alias("file"), place.alias("place"), "hash"))
            continue
        up = last.groupBy("replica", "file", F.floor(F.col("place") / fanout).alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("place", "hash"))).alias("below")  # at most fanout
        )
        text = F.array_join(F.transform("below", lambda x: F.concat_ws(":", x["place"], x["hash"])), ",")
        levels.append(cut(up.select("replica", "file", F.col("at").alias("place"), F.sha2(text.cast("binary"), 256).alias("hash")), "tree"))


def _differing(level: DataFrame) -> DataFrame:
    of = lambda n: F.max(F.when(F.col("replica") == n, F.col("hash")))
    both = level.groupBy("file", "place").agg(of(0).alias("a"), of(1).alias("b"))
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "place")


def _paired(rows: DataFrame, group: list[str]) -> DataFrame:
    """Records of the two sides with equal ``group``, in the order of their slots: one row with structs ``a`` and ``b``,
    of which one is NULL where the other side has no more."""
    keys = ["side", *group]
    many = rows.groupBy(*keys).count().where("count > 1").drop("count")
    single = rows.join(many, keys, "left_anti").withColumn("i", F.lit(0).cast("long"))
    more = row_numbers(rows.join(many, keys, "left_semi"), ["slot"], "i", keys)
    numbered = single.unionByName(more.select(single.columns))
    held = lambda n: F.max(F.when(F.col("side") == n, F.struct("slot", "start", "length", "digest")))
    return numbered.groupBy(*group, "i").agg(held(0).alias("a"), held(1).alias("b")).drop("i")


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The records in which two archives differ: ``file``, ``slot`` (in the first archive, NULL for an extra one), ``key``,
    ``start``, ``length``, ``digest`` and ``other_start``, ``other_length``, ``other_digest``, and ``status``: altered, missing, extra, or moved (the same record at another
    offset).

    Equal roots end the comparison. Else each level is read only below nodes that differ. Differing records of a file are aligned by key
    and digest; those left are paired by key, in the order of their slots, as altered. NULL keys,
    urls and bodies and repeated records are records like others (see ``archive``): of one that occurs more often in one archive,
    the last ones are missing or extra. Two empty archives do not differ; of an empty and another one, every record is
    missing or extra."""
    levels, turn = trees(first, second, fanout)
    found = _differing(levels[-1])
    for i in range(len(levels) - 2, -1, -1):
        lower = levels[i]
        parent = found.select(F.col("file").alias("_f"), F.col("place").alias("_p"))
        if i + 1 == turn:  # a file's root lies below the replica's leaf of that file
            number = F.when(F.col("_p") % 2 == 0, F.col("_p") / 2).otherwise(-(F.col("_p") + 1) / 2).cast("long")
            on = F.col("file") == F.col("_n")
            parent = parent.select(number.alias("_n"))
        else:
            on = F.col("file").eqNullSafe(F.col("_f")) & (F.floor(F.col("place") / fanout) == F.col("_p"))
        found = _differing(lower.join(parent, on, "left_semi"))
    places = found.select("file", F.col("place").cast("long").alias("slot"))
    of = lambda r, n: r.join(places, ["file", "slot"], "left_semi").select(F.lit(n).alias("side"), "file", F.coalesce("key", F.lit(NO_ID)).alias("key"), "slot", "start", "length", "digest")
    rows = cut(of(first, 0).union(of(second, 1)), "differing")
    same = cut(_paired(rows, ["file", "key", "digest"]), "aligned")
    moved = same.where("a is not null and b is not null and a.start <> b.start").drop("digest")
    side = lambda n, c: same.where(f"(a is null) <> (b is null) and {c} is not null").select(F.lit(n).alias("side"), "file", "key", f"{c}.*")
    left = _paired(side(0, "a").unionByName(side(1, "b")), ["file", "key"])
    status = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").otherwise("altered")
    every = moved.withColumn("status", F.lit("moved")).unionByName(left.withColumn("status", status))
    return every.select(
        "file", "a.slot", F.when(F.col("key") != NO_ID, F.col("key")).alias("key"), "a.start", "a.length", "a.digest",
        F.col("b.start").alias("other_start"), F.col("b.length").alias("other_length"), F.col("b.digest").alias("other_digest"), "status",
    )
