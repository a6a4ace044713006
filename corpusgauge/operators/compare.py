"""Runs, ranks, errors and rates against each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions.angles import unwrap_step
from corpusgauge.operators.ordering import in_order, neighbour, running_total


def lineage_counts(
    facts: DataFrame, steps: Sequence[tuple[str, DataFrame, str, str]], keep: Sequence[str]
) -> DataFrame:
    """Fact counts carried up a chain of dimensions. Facts are counted per key before any join."""
    n = F.count(F.lit(1)).alias("n")
    counted = facts.groupBy(steps[0][0]).agg(n)
    for key, dim, dim_key, up in steps:
        wanted = [c for c in keep if c in dim.columns and c != up]
        counted = counted.join(dim.select(dim_key, up, *wanted), F.col(key) == F.col(dim_key))
        seen = [c for c in keep if c in counted.columns and c != up]
        counted = counted.groupBy(up, *seen).agg(F.sum("n").alias("n"))
    return counted.select(*keep, "n")


def compare_runs(
    base: DataFrame, other: DataFrame, key: Sequence[str], error: str, universe: DataFrame | None = None
) -> DataFrame:
    """Per key: base error, other error, delta and outcome, over the union of both and ``universe``
    (keys known only from failures)."""
    b = base.select(*key, F.col(error).alias("base"), F.lit(True).alias("_b"))
    o = other.select(*key, F.col(error).alias("other"), F.lit(True).alias("_o"))
    both = b.join(o, list(key), "full_outer")
    if universe is not None:
        both = universe.select(*key).distinct().join(both, list(key), "full_outer")
    delta = F.col("other") - F.col("base")
    outcome = (
        F.when(F.col("_b") & F.col("_o"),
               F.when(delta < 0, "better").when(delta > 0, "worse").otherwise("same"))
        .when(F.col("_b"), "lost by other").when(F.col("_o"), "lost by base")
        .otherwise("unscored in both")
    )
    return both.select(*key, "base", "other", delta.alias("delta"), outcome.alias("outcome"))


def unwrapped(df: DataFrame, order: Sequence[str], angle: str, into: str, group: Sequence[str] = ()) -> DataFrame:
    """``angle`` in degrees without jumps of more than half a turn along ``order``."""
    cols = [F.col(c) for c in order]
    tagged = in_order(df, cols, group)
    seen = neighbour(df, cols, F.col(angle), "_before", group, ahead=False, tagged=tagged, keep_tags=True)
    step = F.when(F.col("_before").isNotNull(), unwrap_step(F.col(angle) - F.col("_before")))
    fixed = seen.withColumn("_fix", F.coalesce(step, F.lit(0.0)))
    summed = running_total(df, cols, F.col("_fix"), "_sum", group, tagged=fixed)
    return summed.withColumn(into, F.col(angle) + F.col("_sum")).drop("_before", "_fix", "_sum")


def slope(
    df: DataFrame, group: Sequence[str], order: Sequence[str], asked: str, recovered: str, fewest: int = 3
) -> DataFrame:
    """(group, n, slope) of unwrapped recovered against asked; NaN under ``fewest`` rows."""
    flat = unwrapped(df, order, recovered, "_flat", group)
    n = F.count(F.lit(1))
    fitted = F.when(n >= fewest, F.regr_slope("_flat", asked)).otherwise(F.lit(float("nan")))
    return flat.groupBy(*group).agg(n.alias("n"), fitted.alias("slope"))


def verdict(
    df: DataFrame, group: Sequence[str], order: Sequence[str], asked: str, recovered: str,
    error: str, agreement: float = 30.0,
) -> DataFrame:
    """Slope, views within ``agreement``, and whether the subject follows the instruction.

    The slope is judged to nine places: how its sums were rounded, which hangs on their order, does not decide one of exactly one half."""
    fits = slope(df, group, order, asked, recovered)
    near = df.groupBy(*group).agg(F.count_if(F.col(error) <= agreement).alias("within"))
    follows = (F.round("slope", 9) > 0.5) & (F.col("within") >= F.col("n") * 0.6)
    word = F.when(F.col("n") < 3, "undecided").when(follows, "follows").otherwise("does not follow")
    return fits.join(near, list(group)).withColumn("verdict", word)


def rank_summary(df: DataFrame, rank: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per rank; missing values are left out, never counted as zero."""
    mean = lambda m: F.avg(F.nanvl(F.col(m), F.lit(None).cast("double"))).alias(m)
    return df.groupBy(rank).agg(*[mean(m) for m in metrics])


def control_gate(
    scores: DataFrame, group: Sequence[str], rank: str, metric: str,
    same: int, worst: int, tolerance: float = 1e-6,
) -> DataFrame:
    """Per group: the identity rank scores ~0 and the negative control is strictly worse."""
    at = lambda r: F.avg(F.when(F.col(rank) == r, F.col(metric)))
    out = scores.groupBy(*group).agg(at(same).alias("identity"), at(worst).alias("negative"))
    return out.withColumn("identity_ok", F.coalesce(F.col("identity") <= tolerance, F.lit(False))).withColumn(
        "negative_ok", F.coalesce(F.col("negative") > F.col("identity"), F.lit(False))
    )


def two_way_floor(df: DataFrame, name: str, score: str, floor: float, prefix: str = "control_") -> DataFrame:
    """Controls must fall below the floor, cases must reach it."""
    control = F.startswith(name, F.lit(prefix))
    ok = F.when(control, F.col(score) < floor).otherwise(F.col(score) >= floor)
    return df.withColumn("ok", F.coalesce(ok, F.lit(False)))


def with_refusals(df: DataFrame, group: Sequence[str], score: str) -> DataFrame:
    """Scored, refused and mean score: a refusal is never a zero."""
    c = F.col(score)
    return df.groupBy(*group).agg(
        F.count(c).alias("scored"), F.count_if(c.isNull()).alias("refused"), F.avg(c).alias("mean")
    )


def point_drift(a: DataFrame, b: DataFrame, pair: Sequence[str], idx: str, xyz: Sequence[str]) -> DataFrame:
    """Mean and worst distance between points matched by position."""
    other = b.select(*pair, idx, *[F.col(c).alias(f"_{c}") for c in xyz])
    gap = sum(((F.col(c) - F.col(f"_{c}")) ** 2 for c in xyz), F.lit(0.0))
    return a.join(other, [*pair, idx]).groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.sqrt(gap)).alias("mean_drift"), F.max(F.sqrt(gap)).alias("max_drift")
    )


def exceedance(
    df: DataFrame, group: Sequence[str], error: str, tolerances: Sequence[float]
) -> DataFrame:
    """(group, tolerance, n, over, rate, worst): share of errors strictly above each tolerance.

    All tolerances are counted in one pass over the errors.
    """
    over = [F.count_if(F.col(error) > float(x)).alias(f"_{i}") for i, x in enumerate(tolerances)]
    wide = df.groupBy(*group).agg(F.count(error).alias("n"), F.max(error).alias("worst"), *over)
    rows = F.array(*[F.struct(F.lit(float(x)).alias("tolerance"), F.col(f"_{i}").alias("over"))
                     for i, x in enumerate(tolerances)])
    flat = wide.select(*group, "n", "worst", F.inline(rows))
    return flat.withColumn("rate", F.col("over") / F.col("n"))


def rate_text(rate: Column) -> Column:
    """Parts per million, or per billion when under one ppm."""
    ppm = F.format_string("%.0f ppm", rate * 1e6)
    ppb = F.format_string("%.0f ppb", rate * 1e9)
    return F.when(rate == 0, "0 (none)").when(rate * 1e6 >= 1, ppm).otherwise(ppb)


def against_baseline(df: DataFrame, label: str, baseline: str, cost: str, per: Mapping[str, str]) -> DataFrame:
    """Cost per unit, and its ratio to the baseline row's cost per unit of the first kind."""
    out = df
    for name, units in per.items():
        out = out.withColumn(name, F.col(cost) / F.greatest(F.col(units), F.lit(1)))
    first = next(iter(per))
    base = out.where(F.col(label) == baseline).agg(F.min(first)).scalar()
    return out.withColumn("ratio", F.col(first) / base)


def nearest_anchor(size: Column, anchors: Sequence[tuple[str, float]]) -> Column:
    """Name of the anchor closest in size; the earlier one wins a tie."""
    rows = F.array(*[
        F.struct(F.abs(size - F.lit(float(s))).alias("gap"), F.lit(i).alias("i"), F.lit(n).alias("name"))
        for i, (n, s) in enumerate(anchors)
    ])
    return F.array_min(rows).getField("name")


def ratio_stats(
    a: DataFrame, b: DataFrame, key: Sequence[str], left: str, right: str, group: Sequence[str], limit: float
) -> tuple[DataFrame, DataFrame]:
    """Cells of two aligned arrays: their ratio and absolute difference, and per-group counts."""
    pair = a.select(*key, *[g for g in group if g not in key], F.col(left).alias("_a")).join(
        b.select(*key, F.col(right).alias("_b")), list(key)
    )
    cells = pair.withColumn("diff", F.abs(F.col("_a") - F.col("_b"))).withColumn(
        "ratio", F.when(F.col("_b") > 1e-6, F.col("_a") / F.col("_b"))
    )
    return cells, cells.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.max("diff").alias("max_diff"), F.avg("diff").alias("mean_diff"),
        F.count_if(F.col("diff") > limit).alias("over"),
    )
