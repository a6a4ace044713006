"""Mixing of sources to target weights by entropy balancing.

Every document i gets a rate r_i, how often the mix takes it. Among all rates up to a cap that meet the token
constraints of the sources, ``sum over s of size_i r_i = target_s``, and come near those of the length classes, whose
shares of the corpus the mix is to keep, those with the least relative entropy to 1 (each
document once), counted in tokens, have the form ``r_i = min(cap, exp(lam of its source + mu of its length class))``: documents
are tilted exponentially. The multipliers are the solution of a convex dual, found by Newton steps with a dense Hessian. A
step is one distributed aggregation: value, gradient and curvature are sums over sources and classes.

Rates become copies without drawing at random. Within a source, cells of equal size are taken from the
largest down, and each rounds its extra copies so that the words taken come closest to the words due
so far. In a cell the documents with the smallest hashes take the extra copies, numbered over chunks, so a cell of any size is spread.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.llm.common import row_id
from corpusgauge.operators.ordering import row_numbers
from corpusgauge.session import cut

BANDS = 16
"""Classes of document length: the number of binary digits of the size, 15 and more in one."""
_EXACT = "decimal(38,10)"


def band_of(size: Column) -> Column:
    return F.least(F.length(F.bin(size)), F.lit(BANDS - 1)).cast("int")


def size_of(text: Column) -> Column:
    """Number of words, split at the white space of ASCII; 0 for NULL."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return (F.char_length(gaps) - F.char_length(F.replace(gaps, F.lit("w"), F.lit("")))).cast("long")


def targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row per source.

    Sources in the order of their code points, NULL last, take the weights in turn and share the sum of
    all sizes; no target is over ``most`` times its source, and what is over is shared among the others by
    weight until none is. That is ``min(most * size, c * weight)`` with one level c for all. In the order of
    ``most * size / weight`` the capped sources come first, so running sums give c. The windows
    run over the sources alone, not over documents.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sizes.withColumn("weight", turn).withColumn("cap", most * F.col("source_size"))
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    # the level if this source and all after it are not capped
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    w = w.withColumn("level", level)
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    c = F.max(F.when(open_, F.col("level"))).over(whole)  # levels fall from the first source that is not capped
    return w.withColumn("c", c).select(
        "source", "source_size", F.coalesce(F.least(F.col("c") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target")
    )


def _moments(mu: list[float], most: float):
    """Group of one source's bands: the source's multiplier for the given ones of the bands, exactly, and its part of the dual's value,
    of the tokens taken in each band and of the Hessian after the source's multiplier is eliminated (all as numbered cells)."""
    at = np.array(mu)

    def group(key, cells):
        cells = cells.sort_values("band")
        band, tokens, goal = cells["band"].to_numpy(), cells["tokens"].to_numpy(float), float(cells["target"].iloc[0])
        lam = _multiplier(tokens, at[band], goal, most)
        x = lam + at[band]
        open_ = x < math.log(most)
        rate = np.where(open_, np.exp(np.minimum(x, math.log(most))), most)
        taken = tokens * rate
        # conjugate of r log r - r + 1 on [0, most]; where every band is at the cap, lam cancels out
        base = lam if math.isfinite(lam) else 0.0
        high = most * (base + at[band]) - (most * math.log(most) - most + 1)
        value = (base * goal if math.isfinite(lam) else 0.0) - float((tokens * np.where(open_, rate - 1, high)).sum())
        sums = np.zeros(1 + BANDS + BANDS * BANDS)
        sums[0] = value
        np.add.at(sums, 1 + band, taken)
        w = np.where(open_, taken, 0.0)
        if w.sum() > 0:
            inner = np.zeros((BANDS, BANDS))
            inner[band, band] = w
            inner[np.ix_(band, band)] -= np.outer(w, w) / w.sum()
            sums[1 + BANDS :] = inner.ravel()
        used = np.flatnonzero(sums)
        return pd.DataFrame({"cell": used, "x": sums[used]})

    return group


def _multiplier(tokens: np.ndarray, mu: np.ndarray, goal: float, most: float) -> float:
    """The number lam with sum(tokens * min(most, exp(lam + mu))) = goal; infinite if only every band at ``most`` reaches it."""
    by = np.argsort(-mu, kind="stable")
    t, m = tokens[by], mu[by]
    for k in range(len(t)):  # the k bands of the largest mu are at the cap
        left = goal - most * t[:k].sum()
        lam = math.log(left) - math.log(float((t[k:] * np.exp(m[k:])).sum())) if left > 0 else -math.inf
        if lam + m[k] <= math.log(most):
            return lam
    return math.inf


def balance(strata: DataFrame, goals: DataFrame, most: float = 3.0, margin: float = 1.0, tolerance: float = 1e-9, most_steps: int = 60) -> DataFrame:
    """(source, band, rate): the rates nearest to 1 in relative entropy, per token, that meet two kinds of constraints.

    The tokens of each source, taken at their rates, are its target, exactly. The bands (classes of document length, shared by all
    sources) keep the shares they have in the corpus as far as the sources allow: what they miss is charged with
    ``margin`` times its square. No rate is over ``most``. In the dual a rate is ``min(most, exp(lam of the source + mu of the band))``.
    For given mu the lam of each source follows from its own bands, so Newton steps go over mu alone, with the dense
    Hessian that is left when all lam are eliminated; its entries, the gradient and the dual's value are sums over
    the sources, made by one Spark job a step, in decimals, so that they do not hang on the order of the sum.

    ``strata``: (source, band, tokens), ``goals``: (source, target), sources without tokens or target left out.
    """
    named = strata.alias("t").join(goals.where("target > 0").alias("g"), F.expr("t.source <=> g.source")).select("t.source", "band", "tokens", "target")
    named = cut(named.where("tokens > 0"), "strata")
    totals = {r.band: int(r.tokens) for r in named.groupBy("band").agg(F.sum("tokens").alias("tokens")).collect()}  # BANDS rows
    whole = sum(totals.values())
    wanted = named.groupBy("source").agg(F.first("target").alias("target")).agg(F.sum(F.col("target").cast(_EXACT))).first()[0]
    share = np.array([totals.get(b, 0) / whole if whole else 0.0 for b in range(BANDS)]) * float(wanted or 0)
    used = np.flatnonzero(share)

    def at(mu):
        sums = named.groupBy("source").applyInPandas(_moments(mu.tolist(), most), "cell long, x double")
        found = {r.cell: float(r.x) for r in sums.groupBy("cell").agg(F.sum(F.col("x").cast(_EXACT)).alias("x")).collect()}  # 1 + BANDS + BANDS ** 2 rows
        flat = np.array([found.get(i, 0.0) for i in range(1 + BANDS + BANDS * BANDS)])
        value = flat[0] + float((mu * share - share * mu**2 / (2 * margin)).sum())
        return value, share - flat[1 : 1 + BANDS] - share * mu / margin, flat[1 + BANDS :].reshape(BANDS, BANDS) + np.diag(share / margin)

    mu = np.zeros(BANDS)
    if len(used):
        value, slope, bend = at(mu)
        for _ in range(most_steps):
            if np.abs(slope[used] / share[used]).max() <= tolerance:
                break
            step = np.zeros(BANDS)
            step[used] = np.linalg.solve(bend[np.ix_(used, used)], slope[used])
            length, gain = 1.0, float(slope @ step)
            while True:  # the dual is concave: a step that is long enough but not too long exists
                tried = at(mu + length * step)
                if tried[0] >= value + 1e-4 * length * gain - 1e-12 * abs(value) or length < 1e-6:
                    break
                length /= 2
            mu, (value, slope, bend) = mu + length * step, tried
    final = mu.tolist()

    def rates(cells):
        cells = cells.sort_values("band")
        m = np.array(final)[cells["band"].to_numpy()]
        lam = _multiplier(cells["tokens"].to_numpy(float), m, float(cells["target"].iloc[0]), most)
        return cells.assign(rate=np.minimum(most, np.exp(np.minimum(lam + m, 700.0))))[["source", "band", "rate"]]

    return named.groupBy("source").applyInPandas(rates, "source string, band int, rate double")


def _round(cells):
    """Extra copies of each cell of one source: from the largest size down, each cell takes as many as
    bring the words taken closest to the words due so far, so what is over or short shrinks with the size."""
    cells = cells.sort_values("size", ascending=False)
    due, taken, quota = 0.0, 0, []
    for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist(), strict=True):
        due += size * n * (rate % 1)
        q = min(n, max(0, round((due - taken) / size))) if size else 0
        taken += q * size
        quota.append(q)
    return cells.assign(quota=quota)[["source", "size", "n", "rate", "quota"]]


def mix(docs: DataFrame, weights=(5.0, 2.0, 1.0), most: float = 3.0, margin: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``,
    ``taken`` (size times copies), and the row key ``_id``, ``_tag``, ``_source``.

    Only ``doc_id``, ``text`` and ``source`` are read, so other columns cannot clash. NULL or empty text:
    size 0 and taken 0; it is taken as often as its source's rate has whole copies. NULL source: a source of its own, after all others. A source without words
    has target 0 and keeps its documents once. NULL ids and rows equal in id and text are told apart by
    nothing: they are ordered at random among themselves, but as many of them take an extra copy on any
    run. Empty table: no rows.
    """
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), row_id().alias("_id"), F.xxhash64("text").alias("_tag"), size_of(F.col("text").cast("string")).alias("size")
    )
    cells = cut(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells").withColumn("band", band_of(F.col("size")))
    tokens = F.col("size") * F.col("n")
    sizes = cells.groupBy("source").agg(F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("source_size"))
    goals = cut(targets(sizes, weights, most), "targets")
    rates = cut(balance(cells.groupBy("source", "band").agg(F.sum(tokens).alias("tokens")), goals.select("source", "target"), most, margin), "rates")
    rated = cells.alias("c").join(rates.alias("r"), F.expr("c.source <=> r.source and c.band = r.band"), "left").select("c.*", F.coalesce("r.rate", F.lit(1.0)).alias("rate"))
    quotas = cut(rated.groupBy("source").applyInPandas(_round, "source string, size long, n long, rate double, quota long"), "quotas")
    # a cell's extra copies go to its first rows; equal rows are ordered by where they were read, and are alike
    keyed = rows.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit("")), "_turn": F.xxhash64("_tag", "_id"), "_row": F.monotonically_increasing_id()})
    ranked = row_numbers(keyed, ["_turn", "_id", "_tag", "_row"], "_rank", ["_none", "_name", "size"])
    done = ranked.alias("r").join(quotas.alias("q"), F.expr("r.source <=> q.source and r.size = q.size")).select("r.*", "q.rate", "q.quota").alias("r")
    done = done.join(goals.alias("p"), F.expr("r.source <=> p.source"))
    copies = (F.floor("r.rate") + F.when(F.col("r._rank") < F.col("r.quota"), 1).otherwise(0)).cast("int")
    return done.select(
        "r.doc_id", "r.size", "p.source_size", "p.target", "r.rate", copies.alias("copies"),
        (F.col("r.size") * copies).cast("long").alias("taken"), "r._id", "r._tag", F.col("r.source").alias("_source"),
    )


def taken(docs: DataFrame, weights=(5.0, 2.0, 1.0), most: float = 3.0, margin: float = 1.0) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it. Rows equal in id, text and source share their copies."""
    key = ["_id", "_tag", "_none", "_name"]
    named = lambda source: {"_none": source.isNull(), "_name": F.coalesce(source.cast("string"), F.lit(""))}
    plan = mix(docs, weights, most, margin).select("_id", "_tag", "copies", "_source").withColumns(named(F.col("_source")))
    plan = cut(plan.groupBy(*key).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_m")), "copies")
    rows = docs.select(row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.struct("*").alias("_row")).withColumns(named(F.col("_row.source")))
    single = rows.join(plan.where("_m = 1 and _copies > 0"), key).select("_row", "_copies")
    several = plan.where("_m > 1 and _copies > 0")
    if not several.isEmpty():
        shared = rows.join(several, key).withColumns({"_turn": F.xxhash64("_row"), "_at": F.monotonically_increasing_id()}).withColumnRenamed("_at", "_place")
        shared = row_numbers(shared, ["_turn", "_place"], "_nth", key)
        each = F.floor(F.col("_copies") / F.col("_m")) + F.when(F.col("_nth") < F.col("_copies") % F.col("_m"), 1).otherwise(0)
        single = single.union(shared.select("_row", each.alias("_copies")).where("_copies > 0"))
    return single.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))).alias("_copy")).select("_row.*")
