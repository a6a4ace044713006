"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text becomes its shingles of ``width`` plain words. A shingle weighs its count in the text times the
mean inverse document frequency of its words, ``ln(1 + N / df)``. Document frequencies cover the whole
corpus; words in less than the share ``rare`` of all documents count as if in that share, so the table
of frequent words that the tasks get has at most (mean distinct words of a document) / ``rare`` rows,
whatever N is. The frequency is that of words, not of the shingle itself: a shingle's own frequency
grows with the number of its text's copies, and a group of thousands of near copies would lose its
links for that reason alone.

Each text draws ``bands * rows`` consistent weighted samples (Ioffe's form); texts that agree on all
samples of a band meet in a bucket. Equal word sequences are one class from the start. In a bucket the
candidates are all pairs if it is small; else every member is compared with leaders. The text
that meets most others leads first. If some members are not similar to it, the bucket's texts meet again by their
rarest shingles, which loses no link: a fifth of a text's weight, counted from its rarest shingles, meets any
text that is similar to it. In what is still large there, more and more of the members that no leader is
similar to lead from round to round, until none is left. Members that are similar to different leaders can be
similar to each other, so those of different components meet last, unless the similarity of the texts they
are grouped by rules it out. (Texts of similarity 0.8 agree on a band with probability 0.99996.) Every
candidate is verified by its weighted Jaccard similarity over the whole texts. Classes are the
connected components of the verified links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.llm.common import NO_ID, PLAIN, Words, groups_of, mix, repeated_ids, row_id, small_batches, windows
from corpusgauge.session import cut

SMALL = 6
"""Buckets of up to so many different texts are compared pair by pair."""
TOGETHER = 512
"""Pairs of one hub that are verified together."""
GROWTH = 64
"""So many times more leaders from round to round."""


def _plain(texts: list[bytes]) -> list[bytes]:
    return [t.translate(PLAIN) for t in texts]


# --- document frequencies ------------------------------------------------------------------------


def _frequencies(batches, together: int = 8 << 20):
    """Task: in how many documents of a stretch each word occurs. Texts are looked at about 1 MB at a time; what they give is added up over
    ``together`` bytes."""
    held, size = [], 0

    def added() -> pa.RecordBatch:
        h, n = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.argsort(h, kind="stable")
        h = h[by]
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        return pa.record_batch({"w": h[at].view(np.int64), "n": np.add.reduceat(n[by], at)})

    for _, texts in groups_of(batches, "text"):
        words = Words(_plain(texts))
        by = np.argsort(words.hashes[0], kind="stable")  # equal words in the order of their texts
        h, text = words.hashes[0][by], words.text_of()[by]
        if not len(h):
            continue
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        other = new.copy()
        other[1:] |= text[1:] != text[:-1]
        at = np.flatnonzero(new)
        held.append((h[at], np.add.reduceat(other.astype(np.int64), at)))
        size += len(words.data)
        if size >= together:
            yield added()
            held, size = [], 0
    if held:
        yield added()


def frequent_words(texts: DataFrame, rare: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes of the words in at least the share ``rare`` of all texts, their idf, and that of the others."""
    n = texts.count()
    counted = texts.mapInArrow(_frequencies, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= max(1.0, rare * n)).collect()  # at most (words of a text) / rare rows
    h = np.array([r["w"] for r in found], np.int64).view(np.uint64)
    idf = np.log1p(n / np.array([r["n"] for r in found], float))
    by = np.argsort(h)
    return h[by], idf[by].astype(np.float32), math.log1p(1 / rare)


# --- weighted shingles and their samples -----------------------------------------------------------


class Shingles:
    """Distinct shingles of texts: ``of`` text, hash ``s`` and weight ``w``, in the order of texts."""

    def __init__(self, texts: list[bytes], width: int, frequent):
        known, idfs, other = frequent
        words = Words(texts)
        h = words.hashes[0]
        idf = np.full(len(h), other, np.float32)
        if len(known):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            idf = np.where(known[at] == h, idfs[at], idf)
        self.n_words = np.diff(words.first)
        whole = np.flatnonzero(words.left() >= width)
        s = windows(h, width)[whole]
        mean = sum(idf[whole + k] for k in range(width)) / np.float32(width)
        text = words.text_of()[whole]
        short = np.flatnonzero((self.n_words > 0) & (self.n_words < width))
        if len(short):  # the whole text is one shingle
            one = [(windows(h[a:b], b - a, 0xD1342543DE82EF95 + 2 * int(b - a))[0], idf[a:b].mean()) for a, b in zip(words.first[short], words.first[short + 1], strict=True)]
            s = np.concatenate([s, np.array([x for x, _ in one], np.uint64)])
            mean = np.concatenate([mean, np.array([x for _, x in one], np.float32)])
            text = np.concatenate([text, short])
        by = np.lexsort((s, text))
        s, mean, text = s[by], mean[by], text[by]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        self.s, self.of = s[at], text[at]
        self.w = mean[at] * np.diff(np.append(at, len(s))).astype(np.float32)
        self.log_w = np.log(self.w)
        self.first = np.searchsorted(self.of, np.arange(len(texts) + 1))


def samples(x: Shingles, k: int) -> np.ndarray:
    """The k-th consistent weighted sample of each text (0 for a text without shingles)."""
    n = len(x.first) - 1
    out = np.zeros(n, np.uint64)
    if not len(x.s):
        return out
    z = mix(x.s + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)))
    half = np.float32(0.5)
    u = z.view(np.uint16).reshape(-1, 4).T.astype(np.float32) + half  # four draws of 16 bits
    unit = np.float32(2.0**-32)
    r = -np.log(u[0] * u[1] * unit)  # Gamma(2, 1), as is c
    log_c = np.log(-np.log(u[2] * u[3] * unit))
    beta = ((z * np.uint64(0xA0761D6478BD642F)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(x.log_w / r + beta)
    log_a = log_c - r * (t - beta + np.float32(1))
    have = np.flatnonzero(np.diff(x.first))
    least = np.minimum.reduceat(log_a, x.first[have])
    hit = np.flatnonzero(log_a == np.repeat(least, np.diff(x.first)[have]))
    chosen = hit[np.searchsorted(x.of[hit], have)]
    out[have] = mix(x.s[chosen] ^ (t[chosen].astype(np.int64).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
    return out


def _signatures(width: int, bands: int, rows: int, frequent):
    """Task: digest of the word sequence, total weight and band keys of each text."""

    def task(batches):
        for part, texts in groups_of(batches, "text"):
            texts = _plain(texts)
            x = Shingles(texts, width, frequent)
            digest = [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() if n else None for t, n in zip(texts, x.n_words.tolist(), strict=True)]
            keys = []
            for band in range(bands):
                key = np.full(len(texts), band + 1, np.uint64)
                for k in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples(x, band * rows + k))
                keys.append(key)
            flat = np.stack(keys, axis=1).ravel().view(np.int64)
            yield pa.record_batch({
                "_id": part.column("_id"), "_tag": part.column("_tag"),
                "node": pa.array(digest, pa.binary()),
                "weight": pa.array(np.bincount(x.of, x.w, len(texts)), pa.float64()),
                "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), pa.array(flat)),
            })

    return task


def _similarities(width: int, frequent):
    """Task: weighted Jaccard similarity of each hub and the texts after it. A row without a ``node`` is the hub itself; its
    shingles are kept until the next one, also over batches. Texts are looked at about 1 MB at a time."""

    def task(batches):
        hub, known, weights, whole = None, None, None, 0.0
        for part, texts in groups_of(batches, "text"):
            x = Shingles(_plain(texts), width, frequent)
            total = np.bincount(x.of, x.w, len(texts))
            found = []
            for i, (of, node) in enumerate(zip(part.column("hub").to_pylist(), part.column("node").to_pylist(), strict=True)):
                here = slice(x.first[i], x.first[i + 1])
                if node is None:
                    hub, known, weights, whole = of, x.s[here].copy(), x.w[here].copy(), float(total[i])
                    continue
                s = x.s[here]
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                same = known[at] == s
                both = float(np.minimum(weights[at[same]], x.w[here][same]).sum(dtype=np.float64))
                found.append((min(hub, node), max(hub, node), both / (whole + float(total[i]) - both)))
            if found:
                left, right, similar = zip(*found, strict=True)
                yield pa.record_batch({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary()), "similarity": pa.array(similar, pa.float64())})

    return task


# --- texts that share much and are not alike ------------------------------------------------------


def _seen(width: int, frequent):
    """Task: in how many texts each shingle occurs."""

    def task(batches):
        for _, texts in groups_of(batches, "text"):
            s, n = np.unique(Shingles(_plain(texts), width, frequent).s, return_counts=True)
            yield pa.record_batch({"s": s.view(np.int64), "n": n.astype(np.int64)})

    return task


def _common(held: DataFrame, width: int, frequent, sample: int = 8, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most common shingles of a sample of texts. They only set the order in
    which shingles are looked at: any order gives the same links."""
    some = held.where(F.pmod(F.xxhash64("node"), F.lit(sample)) == 0).select("text")
    seen = some.mapInArrow(_seen(width, frequent), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n > 2")
    found = seen.orderBy(F.desc("n"), "s").limit(most).collect()
    s, n = np.array([r["s"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found], np.int64)
    by = np.argsort(s)
    return s[by], n[by]


def _prefixes(width: int, threshold: float, frequent, common):
    """Task: the rarest shingles of each text, so many that the others weigh less than ``threshold`` of
    it. Two texts of that similarity share more than these others, hence one of the first ones."""
    known, counts = common

    def task(batches):
        for part, texts in groups_of(batches, "text"):
            x = Shingles(_plain(texts), width, frequent)
            n = np.zeros(len(x.s), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, x.s), len(known) - 1)
                n = np.where(known[at] == x.s, counts[at], 0)
            by = np.lexsort((x.s, n, x.of))
            w, of = x.w[by].astype(float), x.of[by]
            before, total = np.cumsum(w) - w, np.bincount(of, w, len(texts))[of]
            if len(w):
                before -= before[np.minimum(x.first[:-1], len(w) - 1)][of]
            keep = np.flatnonzero(before <= (1 - threshold + 1e-6) * total)
            chosen = pa.array(of[keep])
            yield pa.record_batch({
                "key": x.s[by][keep].view(np.int64), "node": part.column("node").take(chosen),
                "weight": total[keep], "rest": (total - before)[keep], "open": part.column("open").take(chosen),
            })

    return task


# --- links and classes ----------------------------------------------------------------------------


def _ordered(pairs: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs with a < b that the threshold allows: x and y have the weights wx and wy, of which
    rx and ry are from the common key on, and no more can be common. ``turned``: x, which often has many pairs, is b."""
    fits = F.least("rx", "ry") >= (F.col("wx") + F.col("wy")) * (threshold / (1 + threshold) - 1e-6)
    each = pairs.where(F.col("x") != F.col("y")).where(fits).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("x") > F.col("y")).alias("turned")
    )
    return each.groupBy("a", "b").agg(F.min("turned").alias("turned"))


def _starred(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v: every node hands its least neighbour, or itself, to its larger neighbours (a large
    star) or to all smaller ones and itself (a small star). One shuffle, by node; a hub's edges pass as a stream."""
    both = edges if small else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    own = both.repartition("u").distinct()  # equal edges meet in the partition of their node
    least = own.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    if small:
        out = least.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    else:
        out = least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v")


def _components(links: DataFrame, steps: int | None = None) -> DataFrame:
    """(node, label): the least node of the connected component of each node but that one, by large and small stars in turn.
    After so many ``steps``, if given: some node of it, so that equal labels still mean one component."""
    edges = cut(links.select(F.col("b").alias("u"), F.col("a").alias("v")), "edges")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = None
    while True:
        edges = cut(_starred(_starred(edges, False), True), "edges")
        steps = None if steps is None else steps - 1
        now = mark(edges) if steps is None else None
        if steps == 0 or (now is not None and now == before):
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
        before = now


def classes(docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 14, rows: int = 3, rare: float = 0.01) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (least id of the class), ``n_links`` (verified
    links of its word sequence to others; inside a class not every link is looked for), ``keep`` (true for
    one row of each class, the first by id and hash of the text), and the row key ``_id``, ``_tag``.

    Plain words: A-Z in lower case, split at ASCII characters that are no letter or digit. A text of
    fewer words than ``width`` is one shingle. Texts without words, NULL and empty ones among them, are
    classes of their own. A NULL id comes after all others and shows as a NULL class id if no row of
    the class has one. Rows of one id are judged by their texts; rows equal in both share one class,
    and ``keep`` is true for each of them (drop duplicates to keep one). Only ``doc_id`` and ``text``
    are read, so other columns cannot clash. Empty table: no rows. Whole texts of any length are used,
    and reach the tasks in Arrow batches of a bounded size.
    """
    with small_batches(docs.sparkSession):
        return _classes(docs, width, threshold, bands, rows, rare)


def _classes(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 14, rows: int = 3, rare: float = 0.01
) -> DataFrame:
    rows_of = docs.select(row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.col("text").cast("binary").alias("text"))
    frequent = frequent_words(rows_of.select("text"), rare)
    schema = "_id long, _tag long, node binary, weight double, keys array<long>"
    signed = cut(rows_of.mapInArrow(_signatures(width, bands, rows, frequent), schema), "signatures")
    wordy = signed.where("node is not null")
    texts = cut(wordy.groupBy("node").agg(
        F.min(F.struct("_id", "_tag")).alias("at"), F.first("weight").alias("weight"), F.first("keys").alias("keys"),
    ), "texts")  # one row for each different word sequence

    def buckets(member: DataFrame) -> DataFrame:
        """``member`` (key, node, weight, rest, ...) with the size and the leader of each bucket of two texts
        or more. ``rest`` is the weight from the key on. ``leads``: whether so little comes before the key
        that a text of the same weight or more can be similar; of two similar texts, the lighter one leads."""
        leads = F.col("rest") >= F.col("weight") * (2 * threshold / (1 + threshold) - 1e-6)
        member = member.withColumn("leads", leads)
        sizes = member.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("leads").alias("led")).where("size > 1 and led").drop("led")
        member = cut(member.join(sizes, "key"), "members")
        # texts that meet most others lead: the one that many copies were made from comes before its copies
        met_by = member.groupBy("node").agg(F.sum("size").alias("met"))
        member = member.join(met_by, "node").withColumn("first", F.struct(-F.col("met"), "node", "weight", "rest"))
        leaders = member.where("leads").groupBy("key").agg(F.min("first").alias("leader"), F.min("weight").alias("lightest"))
        return cut(member.join(leaders, "key"), "buckets")

    def named(x: str, y: str) -> list:
        return [F.col(f"{s}.{c}").alias(n) for s, names in ((x, ("x", "wx", "rx")), (y, ("y", "wy", "ry"))) for c, n in zip(("node", "weight", "rest"), names, strict=True)]

    def candidates(member: DataFrame) -> DataFrame:
        """All pairs of small buckets, and the pairs with the leader of large ones."""
        few = member.where(F.col("size").between(3, SMALL)).groupBy("key").agg(
            F.collect_list(F.struct("node", "weight", "rest")).alias("all")
        )
        few = few.select(F.explode("all").alias("p"), "all").select("p", F.explode("all").alias("q")).where("p.node < q.node")
        led = member.where(f"size = 2 or size > {SMALL}").select(F.struct("node", "weight", "rest").alias("q"), F.col("leader").alias("p"))
        return _ordered(few.select(*named("p", "q")).union(led.select(*named("p", "q"))), threshold)

    def unsettled(open_: DataFrame, led_by: DataFrame, links: DataFrame) -> DataFrame:
        """Members that neither lead their bucket nor are linked to one of its leaders."""
        linked = links.select(F.col("a").alias("leader"), F.col("b").alias("node")).union(links.select(F.col("b").alias("leader"), F.col("a").alias("node")))
        settled = open_.join(led_by, "key").join(linked, ["leader", "node"], "left_semi").select("key", "node")
        settled = settled.union(led_by.select("key", F.col("leader").alias("node"))).distinct()
        return cut(open_.join(settled, ["key", "node"], "left_anti"), "open")

    def text_of(nodes: DataFrame) -> DataFrame:
        """(node, text) of the distinct ``nodes``."""
        place = texts.join(nodes, "node").select("node", "at._id", "at._tag")
        full = rows_of.join(place, ["_id", "_tag"]).select("node", "text")
        return full.dropDuplicates(["node"]) if again else full

    def compared(pairs: DataFrame) -> DataFrame:
        """Pairs with their similarity by the whole texts.

        Pairs are dealt by their hub, the one of the two that leads others, at most about ``TOGETHER`` to a group. The hub's text
        comes once for each group and the other texts follow it as a stream, so no row holds two texts."""
        hub = F.when(F.col("turned"), F.col("b")).otherwise(F.col("a"))
        other = F.when(F.col("turned"), F.col("a")).otherwise(F.col("b"))
        p = pairs.select(hub.alias("hub"), other.alias("node"))
        sizes = p.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("groups"))
        after = p.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("groups")).alias("slot"), "node", F.col("node").alias("at"))
        heads = sizes.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("slot"), F.lit(None).cast("binary").alias("node"), F.col("hub").alias("at"))
        rows = heads.union(after).join(held_texts.withColumnRenamed("node", "at"), "at").select("hub", "slot", "node", "text")
        rows = rows.repartition("hub", "slot").sortWithinPartitions("hub", "slot", F.asc_nulls_first("node"))
        return rows.select("hub", "node", "text").mapInArrow(_similarities(width, frequent), "a binary, b binary, similarity double")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs similar by the whole texts."""
        return compared(pairs).where(F.col("similarity") >= threshold)

    def between(members: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of ``members`` of one bucket and different components, one of them open, that can be similar.

        A member goes with its centre, the text of most links among itself and those it is linked to. One less the
        similarity is a metric, so members at distances dx and dy from their centres are no closer to
        each other than the centres are, less dx + dy."""
        both = links.select("a", "b", "similarity").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
        n_of = cut(both.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "degrees")
        near = both.join(n_of.select(F.col("a").alias("b"), "n"), "b").select(F.col("a").alias("node"), "n", F.col("b").alias("centre"), (1 - F.col("similarity")).alias("far"))
        near = near.union(n_of.select(F.col("a").alias("node"), "n", F.col("a").alias("centre"), F.lit(0.0).alias("far")))
        near = near.groupBy("node").agg(F.max(F.struct("n", "centre", "far")).alias("near")).select("node", "near.centre", "near.far")
        mixed = members.select("key", "node", "weight", "rest", "open").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        several = mixed.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.max("open").alias("any")).where("l0 != l1 and any")
        mixed = mixed.join(several.select("key"), "key", "left_semi").join(near, "node", "left")
        mixed = cut(mixed.withColumn("centre", F.coalesce("centre", "node")).withColumn("far", F.coalesce("far", F.lit(0.0))), "mixed")
        groups = cut(mixed.groupBy("key", "label", "centre").agg(
            F.min("weight").alias("w"), F.max("rest").alias("r"), F.max("far").alias("far"), F.max("open").alias("open"),
        ), "groups")
        side = lambda df, n: df.select("key", *(F.col(c).alias(c + n) for c in df.columns if c != "key"))
        met = side(groups, "x").join(side(groups, "y"), "key").where("labelx < labely and (openx or openy)")
        met = met.where(F.least("rx", "ry") >= (F.col("wx") + F.col("wy")) * (threshold / (1 + threshold) - 1e-6))
        met = cut(met.select("key", "labelx", "centrex", "labely", "centrey", (F.col("farx") + F.col("fary")).alias("reach"),
                             F.least("centrex", "centrey").alias("a"), F.greatest("centrex", "centrey").alias("b")), "met")
        apart = compared(met.select("a", "b", F.lit(False).alias("turned")).distinct())
        met = met.join(apart, ["a", "b"]).where(1 - F.col("similarity") <= F.col("reach") + (1 - threshold + 1e-5))
        met = met.select("key", "labelx", "centrex", "labely", "centrey", (1 - F.col("similarity")).alias("apart"))
        full = met.join(side(mixed, "x"), ["key", "labelx", "centrex"]).join(side(mixed, "y"), ["key", "labely", "centrey"])
        full = full.where("openx or openy").where(F.col("apart") <= F.col("farx") + F.col("fary") + (1 - threshold + 1e-5))
        return _ordered(full.select(
            F.col("nodex").alias("x"), F.col("weightx").alias("wx"), F.col("restx").alias("rx"),
            F.col("nodey").alias("y"), F.col("weighty").alias("wy"), F.col("resty").alias("ry"),
        ), threshold)

    again = repeated_ids(docs)
    member = buckets(texts.select("node", "weight", F.col("weight").alias("rest"), F.explode("keys").alias("key")))
    # the texts of all candidates, once: every later pair is of these
    held_texts = cut(text_of(member.select("node").distinct()), "texts")
    pairs = cut(candidates(member), "pairs")
    links, labels = cut(verified(pairs), "links"), None
    large = member.where(F.col("size") > SMALL)
    open_ = unsettled(large.where("node != leader.node").select("key", "node"), large.select("key", F.col("leader.node").alias("leader")).distinct(), links)
    if not open_.isEmpty():
        # large buckets of texts that are not alike: similar texts share one of their rarest shingles
        unlike = large.join(open_.select("key").distinct(), "key", "left_semi").groupBy("node").agg(F.first("weight").alias("weight"))
        unlike = unlike.join(open_.select("node", F.lit(True).alias("open")).distinct(), "node", "left")
        held = cut(held_texts.join(unlike, "node").select("node", "weight", F.coalesce("open", F.lit(False)).alias("open"), "text"), "unlike")
        common = _common(held, width, frequent)
        member = buckets(held.mapInArrow(_prefixes(width, threshold, frequent, common), "key long, node binary, weight double, rest double, open boolean"))
        new = cut(candidates(member).join(pairs, ["a", "b"], "left_anti"), "pairs")
        pairs, links = pairs.union(new), links.union(cut(verified(new), "links"))
        large = member.where(F.col("size") > SMALL)
        led_by = large.select("key", F.col("leader.node").alias("leader")).distinct()
        partner = F.col("rest") >= (F.col("weight") + F.col("lightest")) * (threshold / (1 + threshold) - 1e-6)
        open_ = large.where("open and node != leader.node").where(partner).select("key", "node", "first")
        slots, led_once = 1, led_by
        while True:
            open_ = unsettled(open_, led_by, links)
            if open_.isEmpty():
                break
            slots *= GROWTH
            chosen = open_.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(slots)).alias("slot")).agg(F.min("first").alias("p"))
            led_by = chosen.select("key", F.col("p.node").alias("leader"))
            led_once = led_once.union(led_by)
            # a link inside a component changes no class, so only members of other components are compared
            some = cut(_components(links, 1), "labels")
            own = lambda df, node, name: df.join(some.select(F.col("node").alias("_n"), F.col("label").alias("_l")), F.col(node) == F.col("_n"), "left").withColumn(name, F.coalesce("_l", node)).drop("_n", "_l")
            leading, led = own(chosen.select("key", "p"), "p.node", "lp"), own(large.select("key", "node", F.struct("node", "weight", "rest").alias("q")), "node", "lq")
            met = led.join(leading, "key").where("lp != lq")
            new = cut(_ordered(met.select(*named("p", "q")), threshold).join(pairs, ["a", "b"], "left_anti"), "pairs")
            pairs, links = pairs.union(new), links.union(cut(verified(new), "links"))
        links = cut(links, "links")
        # leaders have met all members of their buckets; two others of different components have not met
        labels = cut(_components(links), "labels")
        rest = large.where(partner).join(led_once.select("key", F.col("leader").alias("node")), ["key", "node"], "left_anti")
        new = cut(between(rest, links, labels).join(pairs, ["a", "b"], "left_anti"), "pairs")
        new = cut(verified(new), "links")
        if not new.isEmpty():
            links, labels = links.union(new), None

    labels = _components(links) if labels is None else labels
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = texts.select("node", "at").join(labels, "node", "left").join(degree, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(F.min("at").alias("head"))
    named = named.join(heads, "label").select("node", "head", "n_links")
    judged = signed.select("_id", "_tag", "node").join(named, "node", "left")
    own = F.coalesce("head", F.struct("_id", "_tag"))
    class_id = own["_id"]
    hide = lambda c: F.when(c != NO_ID, c)
    return judged.select(
        hide(F.col("_id")).alias("doc_id"), hide(class_id).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (own == F.struct("_id", "_tag")).alias("keep"), "_id", "_tag",
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with all its columns and one row of each class: the first by id, then by the hash of its
    text. Rows without words all stay, but rows equal in id and text stay once."""
    gone = classes(docs, **settings).where("not keep").select("_id", "_tag").distinct()
    keyed = docs.select(row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.struct("*").alias("_row"))
    left = keyed.join(gone, ["_id", "_tag"], "left_anti")
    if repeated_ids(docs):
        left = left.dropDuplicates(["_id", "_tag"])
    return left.select("_row.*")
