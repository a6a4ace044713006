"""Integrity checks. Facts are reduced to distinct keys or counts before anything is joined."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgauge.functions.missing import is_missing, nan_as_null

CHECK_SCHEMA = "name string, state string, detail string, fatal boolean"

# Run precisions that never produce corpus data.
QUANTISED = ("nf4", "int8", "int4", "q4_k_m", "gguf")


# -- schema and values ------------------------------------------------------------------------

def schema_problems(name: str, got: T.StructType, want: T.StructType) -> list[str]:
    """Missing, unexpected and mistyped columns."""
    have, need = {f.name: f.dataType for f in got}, {f.name: f.dataType for f in want}
    return (
        [f"{name}: missing column {c}" for c in need if c not in have]
        + [f"{name}: unexpected column {c}" for c in have if c not in need]
        + [
            f"{name}: column {c} has type {have[c].simpleString()}, expected {t.simpleString()}"
            for c, t in need.items()
            if c in have and have[c] != t
        ]
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing): one pass over the table, whatever its width. Payload bytes are not read
    for more than their presence."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "missing")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, duplicates."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.count(F.lit(1))
    return per_key.agg(rows.alias("n_rows"), kept.alias("n_keys"), (rows - kept).alias("duplicates"))


def few_values(long: DataFrame, attribute: str, value: str, minimum: int = 10, error: float | None = None) -> DataFrame:
    """Distinct values per attribute, with the attributes that collapsed below ``minimum``. With an ``error`` (a relative
    standard deviation) the number is an estimate from a sketch: values are not shuffled, and a number near ``minimum`` may be off."""
    v = nan_as_null(long, value)
    if error is not None:
        about = long.groupBy(attribute).agg(F.approx_count_distinct(v, error).alias("n_values"))
        return about.withColumn("collapsed", F.col("n_values") < minimum)
    seen = long.select(attribute, v.alias("_v")).distinct()
    n = F.count("_v")
    return seen.groupBy(attribute).agg(n.alias("n_values"), (n < minimum).alias("collapsed"))


def value_range(df: DataFrame, columns: Sequence[str], low: float, high: float) -> DataFrame:
    """Per column: non-finite values, values outside [low, high], minimum and maximum."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
        inside = finite & (v >= low) & (v <= high)
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(~F.coalesce(finite, F.lit(False))).alias("not_finite"),
                F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside"),
                F.min(F.when(finite, v)).alias("low"),
                F.max(F.when(finite, v)).alias("high"),
            ).alias(c)
        )
    return df.agg(*aggs).select(F.inline(F.array(*columns)))


# -- keys --------------------------------------------------------------------------------------

def distinct_keys(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]).distinct()


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    on = F.lit(True)
    for i, n in enumerate(names):
        same = left[n].eqNullSafe(right[n])
        on = same if i == 0 else on & same
    return on


def orphans(
    child: DataFrame, child_key: Sequence[str], parent: DataFrame, parent_key: Sequence[str]
) -> DataFrame:
    """Distinct child keys with no parent. A NULL key counts as one value."""
    names = [f"key_{i}" for i in range(len(child_key))]
    mine = distinct_keys(child, child_key, names).alias("c")
    theirs = distinct_keys(parent, parent_key, names).alias("p")
    on = None
    for n in names:
        same = F.col(f"c.{n}").eqNullSafe(F.col(f"p.{n}"))
        on = same if on is None else on & same
    return mine.join(theirs, on, "left_anti")


def foreign_keys(
    tables: Mapping[str, DataFrame], edges: Iterable[tuple[str, str, str, str]]
) -> DataFrame:
    """(edge, missing): distinct child values absent from the parent, for every edge.

    All edges share one shuffle, and each table is read once: its keys are unfolded under the edges they
    belong to, reduced to distinct (edge, key) before they travel, and counted where only the child has them.
    """
    edges = list(edges)
    integral = lambda t, k: isinstance(tables[t].schema[k].dataType, T.IntegralType)
    cells: dict[str, list[Column]] = {}
    for i, (child, ckey, parent, pkey) in enumerate(edges):
        whole = integral(child, ckey) and integral(parent, pkey)  # each edge in the type of its own keys
        for table, key, mine in ((child, ckey, True), (parent, pkey, False)):
            number = F.col(key) if whole else F.lit(None)
            text = F.lit(None) if whole else F.col(key)
            cells.setdefault(table, []).append(F.struct(
                F.lit(i).alias("i"), number.cast("bigint").alias("k"), text.cast("string").alias("s"),
                F.lit(mine).alias("c"), F.lit(not mine).alias("p"),
            ))
    sides = [tables[table].select(F.inline(F.array(*of_table))) for table, of_table in cells.items()]
    keys = union_all(sides).groupBy("i", "k", "s").agg(F.bool_or("c").alias("c"), F.bool_or("p").alias("p"))
    per = keys.groupBy("i").agg(F.count_if(F.col("c") & ~F.col("p")).alias("missing"))
    names = F.array(*[F.lit(f"{c}.{ck} -> {p}.{pk}") for c, ck, p, pk in edges])
    # an edge whose two tables are both empty still gets its row
    every = tables[edges[0][0]].sparkSession.range(1).select(F.posexplode(names).alias("i", "edge"))
    return every.join(per, "i", "left").select("edge", F.coalesce("missing", F.lit(0)).alias("missing"))


def key_set_difference(
    left: DataFrame, left_key: Sequence[str], right: DataFrame, right_key: Sequence[str]
) -> DataFrame:
    """One row: keys only on the left, only on the right, on both. NULL keys count as one value."""
    names = [f"key_{i}" for i in range(len(left_key))]
    sides = distinct_keys(left, left_key, names).withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
    other = distinct_keys(right, right_key, names).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    both = sides.unionByName(other).groupBy(*names).agg(F.max("_l").alias("l"), F.max("_r").alias("r"))
    return both.agg(
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("in_both"),
    )


def shared_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Keys that occur in two pools that must be disjoint."""
    return distinct_keys(left, [left_key], ["key"]).intersect(distinct_keys(right, [right_key], ["key"]))


def vocabulary(
    df: DataFrame, column: str, vocab: DataFrame, axis: str | None = None
) -> DataFrame:
    """(axis, value, n) outside ``vocab(axis, value)``. An axis with no entries is not checked."""
    ax = F.col(axis) if axis else F.lit("")
    counted = df.groupBy(ax.alias("axis"), F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = vocab.select("axis", "value").distinct()
    checked = counted.join(known.select("axis").distinct(), "axis", "left_semi").alias("c")
    k = known.alias("k")
    same = (F.col("c.axis") == F.col("k.axis")) & F.col("c.value").eqNullSafe(F.col("k.value"))
    return checked.join(k, same, "left_anti")


def parent_agreement(
    child: DataFrame, child_key: str, child_value: str,
    parent: DataFrame, parent_key: str, parent_value: str,
) -> DataFrame:
    """(key, child value, parent value, n) where a child disagrees with, or has no, parent."""
    mine = child.groupBy(F.col(child_key).alias("key"), F.col(child_value).alias("child_value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    theirs = parent.select(F.col(parent_key).alias("key"), F.col(parent_value).alias("parent_value"))
    both = mine.join(theirs.distinct(), "key", "left")
    return both.where(~F.col("child_value").eqNullSafe(F.col("parent_value")))


def contamination(df: DataFrame, subject: str, split: str) -> DataFrame:
    """(subject, n_splits) of the subjects that sit in more than one split."""
    pairs = df.select(subject, split).where(F.col(split).isNotNull()).distinct()
    per = pairs.groupBy(subject).agg(F.count(F.lit(1)).alias("n_splits"))
    return per.where("n_splits > 1")


def eligibility(
    rows: DataFrame, run_key: str, runs: DataFrame, run_id: str, precision: str,
    quantised: Sequence[str] = QUANTISED,
) -> DataFrame:
    """(status, n): eligible, ineligible (quantised run) or unknown (no such run)."""
    per_run = rows.groupBy(F.col(run_key).alias("run")).agg(F.count(F.lit(1)).alias("n"))
    known = runs.select(F.col(run_id).alias("run"), F.lower(precision).alias("p")).distinct()
    status = (
        F.when(F.col("p").isNull(), "unknown")
        .when(F.col("p").isin(*quantised), "ineligible")
        .otherwise("eligible")
    )
    return per_run.join(known, "run", "left").groupBy(status.alias("status")).agg(F.sum("n").alias("n"))


# -- power and roll-up ----------------------------------------------------------------------------

def detection_floor(used: Column, total: Column) -> Column:
    """Smallest defect prevalence, in ppm, that a run over ``used`` of ``total`` rows can catch."""
    full = F.lit(1e6) / F.greatest(total, F.lit(1))
    return F.when(used >= total, full).otherwise(F.lit(3e6) / F.greatest(used, F.lit(1)))


def check(source: DataFrame, name: str, ok: Column, detail: Column, fatal: bool = True) -> DataFrame:
    """One check row from a one-row aggregate. A NULL verdict (no data) fails, it is not skipped."""
    bad = "FAIL" if fatal else "WARN"
    state = F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(bad)
    return source.select(
        F.lit(name).alias("name"), state.alias("state"),
        detail.cast("string").alias("detail"), F.lit(fatal).alias("fatal"),
    )


def check_each(source: DataFrame, checks: Sequence[tuple[str, Column, Column]], fatal: bool = True) -> DataFrame:
    """Several check rows (name, ok, detail) from one one-row aggregate, computed once."""
    bad = "FAIL" if fatal else "WARN"
    rows = [
        F.struct(
            F.lit(name).alias("name"), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(bad).alias("state"),
            detail.cast("string").alias("detail"), F.lit(fatal).alias("fatal"),
        )
        for name, ok, detail in checks
    ]
    return source.select(F.inline(F.array(*rows)))


def stated(spark: SparkSession, name: str, problems: Sequence[str], fatal: bool = True) -> DataFrame:
    """One check row from facts known without reading rows (a schema, a listing)."""
    state = "PASS" if not problems else ("FAIL" if fatal else "WARN")
    return spark.range(1).select(
        F.lit(name).alias("name"), F.lit(state).alias("state"),
        F.lit("; ".join(problems)).alias("detail"), F.lit(fatal).alias("fatal"),
    )


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def roll_up(checks: DataFrame) -> DataFrame:
    """Counts per state and in total, and how many of them block."""
    return checks.groupingSets([[F.col("state")], []], F.col("state")).agg(
        F.coalesce(F.col("state"), F.lit("ALL")).alias("outcome"),
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("state") == "FAIL") & F.col("fatal")).alias("blocking"),
    ).select("outcome", "n", "blocking")
