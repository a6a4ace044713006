"""Distribution checks. Percentiles are exact and never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators.ordering import exact_percentiles, row_numbers
from corpusgauge.operators.prepare import literal_rows

# Bands of the ramp profile, as fractions of its length.
RAMP_BANDS = ((0.2, 0.35), (0.35, 0.5), (0.5, 0.65), (0.65, 0.8), (0.8, 0.95))
# Weights of the three channels in brightness.
LUMA = (0.2126, 0.7152, 0.0722)


def _wide(q: DataFrame, group: Sequence[str], names: dict[float, str]) -> DataFrame:
    cells = [F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in names.items()]
    return q.groupBy(*group).agg(F.max("n").alias("n"), *cells)


def bands(
    df: DataFrame, group: str, value: str, minimum: int, expected: Sequence[str] | None = None
) -> DataFrame:
    """(group, n, p05, p50, p95, state). A group at or under ``minimum`` rows FAILS; so does an
    expected group with no row at all."""
    q = exact_percentiles(df, value, [0.05, 0.5, 0.95], [group])
    wide = _wide(q, [group], {0.05: "p05", 0.5: "p50", 0.95: "p95"})
    if expected is not None:
        names = literal_rows(df.sparkSession, [(e,) for e in expected], group)
        wide = names.join(wide, group, "left").fillna({"n": 0})
    return wide.withColumn("state", F.when(F.col("n") > minimum, "PASS").otherwise("FAIL"))


def coverage(measured: DataFrame, group: str, references: DataFrame) -> DataFrame:
    """``references(group, name, value)`` against the p05..p95 band of their group."""
    inside = F.col("value").between(F.col("p05"), F.col("p95"))
    joined = references.join(measured, group, "left")
    return joined.select(group, "name", "value", F.coalesce(inside, F.lit(False)).alias("covered"))


def normalised(df: DataFrame, group: Sequence[str], value: str, into: str) -> DataFrame:
    """Value mapped to [0, 1] within its group, with the range kept so it can be undone."""
    span = df.groupBy(*group).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    width = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(1.0)
    return df.join(span, list(group)).withColumn(into, (F.col(value) - F.col("low")) / width)


def unit_cube(df: DataFrame, mesh: str, xyz: Sequence[str]) -> DataFrame:
    """Points centred and scaled so that their longest extent is 1, with centre and scale kept."""
    lo = [F.min(c).alias(f"_lo_{c}") for c in xyz]
    hi = [F.max(c).alias(f"_hi_{c}") for c in xyz]
    box = df.groupBy(mesh).agg(*lo, *hi)
    extent = F.greatest(*[F.col(f"_hi_{c}") - F.col(f"_lo_{c}") for c in xyz])
    box = box.select(
        mesh, (1.0 / F.when(extent > 0, extent).otherwise(1.0)).alias("scale"),
        *[((F.col(f"_hi_{c}") + F.col(f"_lo_{c}")) / 2).alias(f"centre_{c}") for c in xyz],
    )
    moved = df.join(box, mesh)
    for c in xyz:
        moved = moved.withColumn(f"unit_{c}", (F.col(c) - F.col(f"centre_{c}")) * F.col("scale"))
    return moved


def tail_means(df: DataFrame, group: str, value: str, order: Sequence[str]) -> DataFrame:
    """(group, n, top, bottom): mean of the highest and lowest tenth; NULL under 20 rows."""
    each = row_numbers(df.select(group, value, *order), [value, *order], "_i", [group], size="n")
    k = F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    enough, v = F.col("n") >= 20, F.col(value)
    top = F.avg(F.when(enough & (F.col("_i") >= F.col("n") - k), v))
    bottom = F.avg(F.when(enough & (F.col("_i") < k), v))
    return each.groupBy(group, "n").agg(top.alias("top"), bottom.alias("bottom"))


def frequent_extremes(
    df: DataFrame, group: str, channels: Sequence[str], weights: Sequence[float], decimals: int = 3
) -> DataFrame:
    """(group, n, lightest, darkest) among rounded values that cover a tenth of the group (and at
    least 3 rows); NULL under 20 rows."""
    rounded = [F.round(c, decimals).alias(c) for c in channels]
    counted = df.groupBy(group, *rounded).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counted.groupBy(group).agg(F.sum("_c").alias("n"))
    each = counted.join(sizes, group)
    frequent = (F.col("n") >= 20) & (F.col("_c") >= F.greatest(F.lit(3), F.floor(F.col("n") / 10)))
    weight = sum((F.col(c) * w for c, w in zip(channels, weights)), F.lit(0.0))
    entry = F.when(frequent, F.struct(*channels))
    light = F.struct(weight, *[-F.col(c) for c in channels])
    return each.groupBy(group, "n").agg(
        F.max_by(entry, F.when(frequent, light)).alias("lightest"),
        F.min_by(entry, F.when(frequent, F.struct(weight, *channels))).alias("darkest"),
    )


def band_rmse(
    df: DataFrame, group: str, position: str, measure: str, full: float,
    ranges: Sequence[tuple[float, float]] = RAMP_BANDS, fewest: int = 3,
) -> DataFrame:
    """(group, n_bands, rmse): median per band against a linear ramp to ``full``; NaN if no band
    has ``fewest`` points."""
    band = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(ranges):
        band = F.when((F.col(position) >= lo) & (F.col(position) < hi), i).otherwise(band)
    placed = df.select(group, band.alias("_band"), measure).where("_band is not null")
    mid = F.element_at(F.array(*[F.lit((lo + hi) / 2) for lo, hi in ranges]), F.col("_band") + 1)
    q = exact_percentiles(placed, measure, [0.5], [group, "_band"]).where(F.col("n") >= fewest)
    miss = F.pow(F.col("q") - mid * full, F.lit(2))
    scored = q.groupBy(group).agg(F.count(F.lit(1)).alias("n_bands"), F.sqrt(F.avg(miss)).alias("rmse"))
    every = df.select(group).distinct()
    return every.join(scored, group, "left").fillna({"n_bands": 0, "rmse": float("nan")})


def coverage_gaps(df: DataFrame, levels: Sequence[tuple[str, Sequence]], fewest: int = 2) -> DataFrame:
    """(levels..., n) of the expected grid cells with fewer than ``fewest`` rows."""
    axes = [a for a, _ in levels]
    grid = df.sparkSession.range(1)
    for axis, values in levels:
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(axis))
    seen = df.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"))
    filled = grid.drop("id").join(seen, axes, "left").fillna({"n": 0})
    return filled.where(F.col("n") < fewest)


def apportion(
    shares: DataFrame, name: str, share: str, total: int, floor: int = 0
) -> DataFrame:
    """Whole numbers that sum to ``total``, in proportion to ``share``, none below ``floor``.

    Largest remainders win the last units (ties in name order); no mass at all splits evenly; a
    floor that cannot be met raises when the plan runs.
    """
    sized = shares.select(name, F.greatest(F.coalesce(F.col(share).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("_s"))
    whole = sized.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("_s").alias("mass"))).scalar()
    n, mass = whole.getField("n"), whole.getField("mass")
    spare = F.lit(total) - F.lit(floor) * n
    even = F.floor(spare / n)
    exact = F.when(mass > 0, spare * F.col("_s") / mass).otherwise(even)
    parts = sized.select(name, exact.alias("_exact"), F.floor(exact).alias("_whole"))
    parts = parts.withColumn("_left", F.col("_exact") - F.col("_whole"))
    ranked = row_numbers(parts, [F.desc("_left"), F.col(name)], "_i")
    short = spare - ranked.agg(F.sum("_whole")).scalar()
    extra = F.when(F.col("_i") < short, 1).otherwise(0)
    problem = F.raise_error(F.lit(f"a floor of {floor} per category does not fit in {total}"))
    got = F.when(spare < 0, problem.cast("long")).otherwise(F.col("_whole") + extra + floor)
    return ranked.select(name, got.cast("long").alias("allocated"))


def apportion_by_spread(
    df: DataFrame, cell: str, value: str, total: int, floor: int = 2
) -> DataFrame:
    """Replicates per cell in proportion to its sample spread."""
    spread = df.groupBy(cell).agg(F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("_spread"))
    return apportion(spread, cell, "_spread", total, floor)


def selection_class(df: DataFrame, group: str, index: str, n_views: int, band: str | None = None, bands: DataFrame | None = None) -> DataFrame:
    """How a set of view indices was chosen: whole, band, undeclared band, prefix or hand-picked.

    ``bands`` (band, low, high) declares the ranges of each named band, several rows if it has several. A set is a band if one
    that its rows name is declared and its ranges cover every index; a name that is not declared is a problem of its own
    unless the set is whole; indices outside the ranges make it what it is without the name.
    """
    if band is None:
        seen = df.select(group, index).distinct().withColumns({"_known": F.lit(False), "_named": F.lit(False), "_in": F.lit(False)})
    else:
        named = df.select(group, index, F.col(band).alias("_band")).distinct()
        ranges = bands.groupBy(F.col("band").alias("_band")).agg(F.collect_list(F.struct("low", "high")).alias("_ranges"))
        met = named.join(ranges, "_band", "left")
        inside = F.exists("_ranges", lambda r: (F.col(index) >= r["low"]) & (F.col(index) <= r["high"]))
        seen = met.select(
            group, index, (F.col("_band").isNull() | F.col("_ranges").isNotNull()).alias("_known"), F.col("_band").isNotNull().alias("_named"),
            F.coalesce(inside, F.lit(False)).alias("_in"),
        )
    n, low, high = F.count_distinct(index), F.min(index), F.max(index)
    run = (low == 0) & (high + 1 == n)
    word = F.when(run & (n == n_views), "whole")
    if band is not None:
        word = word.when(~F.min("_known"), "undeclared band").when(F.max("_named") & F.min("_in"), "band")
    word = word.when(run, "prefix").otherwise("hand-picked")
    return seen.groupBy(group).agg(n.alias("n_indices"), word.alias("selection"))


def selection_problems(selected: DataFrame, group: str) -> DataFrame:
    """(group, problem) of the sets that are neither whole nor a declared band."""
    reason = (
        F.when(F.col("selection") == "undeclared band", "its band is not declared, so it carries no reason")
        .when(F.col("selection") == "prefix", "a prefix leaves out what comes late in the sequence").otherwise("chosen by hand")
    )
    return selected.where("selection not in ('whole', 'band')").select(group, reason.alias("problem"))
