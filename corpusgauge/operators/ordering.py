"""Ordered computations that never put one group, or the whole table, into one task.

A window partitioned only by its group sends that group to one task, and a window without a
partition sends everything to one. Here rows are first range-partitioned by (group, order), so a
large group spreads over many chunks. Each chunk is then scanned on its own, and what earlier (or
later) chunks contribute is a small table with at most two rows per chunk: only the first and the
last group of a chunk can reach across its edges. That table alone is broadcast.

The order given must be total (end in a unique column): equal keys share a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.session import cut

Order = Sequence[Column | str]
_HELPERS = ("_at", "_chunk", "_g")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_order(df: DataFrame, order: Order, group: Sequence[str] = ()) -> DataFrame:
    """Range-partitioned and sorted rows with ``_chunk``, ``_at`` (global sequence) and ``_g``."""
    keys = [F.col(g) for g in group] + [_col(o) for o in order]
    # monotonically_increasing_id is (partition << 33) + position, which is exactly the order
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = cut(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    whole = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    return kept.withColumn("_chunk", F.shiftright("_at", 33)).withColumn("_g", whole)


def _edges(tagged: DataFrame) -> DataFrame:
    """The groups that start or end a chunk: at most two rows per chunk."""
    ends = tagged.groupBy("_chunk").agg(F.min("_at").alias("a"), F.max("_at").alias("b"))
    at = ends.select(F.explode(F.array("a", "b")).alias("_at"))
    return tagged.join(F.broadcast(at), "_at", "left_semi").select("_g").distinct()


def _chunk_summary(tagged: DataFrame, summary: Column, group: Sequence[str]) -> DataFrame:
    """``summary`` per (chunk, group), for groups that may reach across a chunk edge. Without a
    group every chunk reaches."""
    reaching = tagged.join(F.broadcast(_edges(tagged)), "_g", "left_semi") if group else tagged
    return reaching.groupBy("_chunk", "_g").agg(summary.alias("_summary"))


def _attach(tagged: DataFrame, carry: DataFrame, group: Sequence[str]) -> DataFrame:
    if group:
        return tagged.join(F.broadcast(carry), ["_chunk", "_g"], "left")
    return tagged.join(F.broadcast(carry.drop("_g")), "_chunk", "left")


def running_total(
    df: DataFrame, order: Order, value: Column, into: str, group: Sequence[str] = (),
    tagged: DataFrame | None = None, keep_tags: bool = False,
) -> DataFrame:
    """Inclusive running sum of ``value`` within ``group`` in ``order``.

    ``tagged`` is an earlier ``in_order`` result (with columns added) to be reused.
    """
    tagged = in_order(df, order, group) if tagged is None else tagged
    earlier = Window.partitionBy("_g").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = _chunk_summary(tagged, F.sum(value), group).select(
        "_chunk", "_g", F.sum("_summary").over(earlier).alias("_carry")
    )
    here = Window.partitionBy("_chunk", "_g").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = tagged.withColumn(into, F.sum(value).over(here))
    done = _attach(local, carry, group).withColumn(into, F.col(into) + F.coalesce("_carry", F.lit(0)))
    return done.drop("_carry") if keep_tags else done.drop(*_HELPERS, "_carry")


def running_totals(tagged: DataFrame, values: dict[str, Column], group: Sequence[str]) -> DataFrame:
    """Several inclusive running sums over one ``in_order`` result, whose helper columns stay."""
    reaching = tagged.join(F.broadcast(_edges(tagged)), "_g", "left_semi") if group else tagged
    earlier = Window.partitionBy("_g").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = reaching.groupBy("_chunk", "_g").agg(*[F.sum(v).alias(k) for k, v in values.items()])
    carry = sums.select("_chunk", "_g", *[F.sum(k).over(earlier).alias(f"_carry_{k}") for k in values])
    here = Window.partitionBy("_chunk", "_g").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    done = _attach(tagged.withColumns({k: F.sum(v).over(here) for k, v in values.items()}), carry, group)
    done = done.withColumns({k: F.col(k) + F.coalesce(f"_carry_{k}", F.lit(0)) for k in values})
    return done.drop(*[f"_carry_{k}" for k in values])


def row_numbers(
    df: DataFrame, order: Order, into: str, group: Sequence[str] = (), size: str | None = None
) -> DataFrame:
    """0-based row number within ``group``, and the group's ``size`` if a name for it is given."""
    tagged = in_order(df, order, group)
    if group:
        one = F.lit(1).cast("long")
        numbered = running_total(df, order, one, into, group, tagged, keep_tags=True)
        numbered = numbered.withColumn(into, F.col(into) - 1)
        if size is not None:
            numbered = numbered.join(tagged.groupBy("_g").agg(F.count(F.lit(1)).alias(size)), "_g")
        return numbered.drop(*_HELPERS)
    # one row per chunk, so this window is as small as the number of partitions
    sizes = tagged.groupBy("_chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_carry"))
    position = F.col("_at") - F.shiftleft(F.col("_chunk"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_chunk")
        .withColumn(into, position + F.col("_carry"))
        .drop(*_HELPERS, "_carry")
    )


def neighbour(
    df: DataFrame,
    order: Order,
    value: Column,
    into: str,
    group: Sequence[str] = (),
    ahead: bool = True,
    tagged: DataFrame | None = None,
    keep_tags: bool = False,
) -> DataFrame:
    """``value`` of the next (``ahead``) or previous row of the group; NULL past its end."""
    tagged = in_order(df, order, group) if tagged is None else tagged
    boxed = F.struct(value.alias("v"))  # boxed: a NULL value differs from having no neighbour
    edge_value = (F.min_by if ahead else F.max_by)(boxed, F.col("_at"))
    across = Window.partitionBy("_g").orderBy("_chunk")
    step = F.lead if ahead else F.lag
    carry = _chunk_summary(tagged, edge_value, group).select(
        "_chunk", "_g", step("_summary").over(across).alias("_carry")
    )
    here = Window.partitionBy("_chunk", "_g").orderBy("_at")
    local = tagged.withColumn(into, step(boxed).over(here))
    done = _attach(local, carry, group).withColumn(into, F.coalesce(into, "_carry").getField("v"))
    return done.drop("_carry") if keep_tags else done.drop(*_HELPERS, "_carry")


def ring_next(df: DataFrame, order: Order, value: Column, into: str) -> DataFrame:
    """Next value in order; the last row takes the first."""
    tagged = in_order(df, order)
    first = tagged.agg(F.min_by(value, F.col("_at"))).scalar()
    last = tagged.agg(F.max("_at")).scalar()
    stepped = neighbour(df, order, value, into, tagged=tagged, keep_tags=True)
    return stepped.withColumn(
        into, F.when(F.col("_at") == last, first).otherwise(F.col(into))
    ).drop(*_HELPERS)


def first_at_or_after(
    df: DataFrame, order: Order, value: Column, into: str, group: Sequence[str] = ()
) -> DataFrame:
    """First non-NULL ``value`` at this row or later in the group; past the end, the last one."""
    tagged = in_order(df, order, group)
    present = F.when(value.isNotNull(), F.col("_at"))
    firsts = _chunk_summary(tagged, F.min_by(value, present), group)
    # read backwards: a frame that grows from its start is scanned once, one that shrinks is not
    later = Window.partitionBy("_g").orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(
        "_chunk", "_g", F.last("_summary", ignorenulls=True).over(later).alias("_carry")
    )
    here = Window.partitionBy("_chunk", "_g").orderBy(F.desc("_at")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = tagged.withColumn(into, F.last(value, ignorenulls=True).over(here))
    ahead = _attach(local, carry, group).withColumn(into, F.coalesce(into, "_carry"))
    last = tagged.groupBy("_g").agg(F.max_by(value, present).alias("_last"))
    return (
        ahead.join(last, "_g", "left")
        .withColumn(into, F.coalesce(into, "_last"))
        .drop(*_HELPERS, "_carry", "_last")
    )


ACCURACY = 2_000
"""Of a group's values, about 1 in so many is looked at closely for each percentile."""


def exact_percentiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles with linear interpolation: columns ``group``, ``p``, ``n``, ``q``. NULL and NaN are not values.

    Rank selection in two passes. A sketch, merged from all tasks, gives two values between which each wanted rank must
    lie, by the sketch's own error bound. The second pass only counts what is below, and counts the
    distinct values between them; nothing else is shuffled or sorted. The ranks are then found among those few.
    """
    group = list(group)
    one = [] if group else [F.lit(0).alias("_one")]
    keys = group or ["_one"]
    v = F.col(value).cast("double")
    base = cut(df.select(*group, *one, F.nanvl(v, F.lit(None).cast("double")).alias("_v")).where("_v is not null"), "values")
    near = 4.0 / ACCURACY  # twice the sketch's error on either side
    points = [min(1.0, max(0.0, p + side)) for p in probs for side in (-near, near)]
    sketch = base.groupBy(*keys).agg(F.percentile_approx("_v", points, ACCURACY).alias("_at"), F.count(F.lit(1)).alias("n"))
    at = lambda i: F.get("_at", F.lit(i))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), at(2 * i).alias("lo"), at(2 * i + 1).alias("hi")) for i, p in enumerate(probs)])
    sketch = sketch.select(*keys, "n", wanted.alias("_t"))
    each = base.join(sketch, keys).select(*keys, "n", "_v", F.explode("_t").alias("t"))
    side = F.when(F.col("_v") < F.col("t.lo"), -1).when(F.col("_v") > F.col("t.hi"), 1).otherwise(0)
    placed = each.select(*keys, F.col("t.p").alias("p"), "n", side.alias("_side"), F.when(side == 0, F.col("_v")).alias("_key"), "_v")
    # one row for all values below, one for all above, one for each distinct value between
    counted = placed.groupBy(*keys, "p", "n", "_side", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    upto = Window.partitionBy(*keys, "p").orderBy("_side", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_rank", F.col("p") * (F.col("n") - 1))
    holds = lambda k: (k >= F.col("_upto") - F.col("_n")) & (k < F.col("_upto"))
    # a rank just outside the two values is the last one below or the first one above
    beyond = F.raise_error(F.lit("the sketch missed a rank")).cast("double")
    found = lambda k: F.max(F.when(holds(k), F.when(F.col("_side") == 0, F.col("_key"))
                                   .when((F.col("_side") < 0) & (k == F.col("_upto") - 1), F.col("_most"))
                                   .when((F.col("_side") > 0) & (k == F.col("_upto") - F.col("_n")), F.col("_least")).otherwise(beyond)))
    share = F.max(F.col("_rank") - F.floor("_rank"))
    out = summed.groupBy(*keys, "p").agg(
        F.max("n").alias("n"), found(F.floor("_rank")).alias("_low"), found(F.ceil("_rank")).alias("_high"), share.alias("_share")
    ).select(*keys, "p", "n", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("q"))
    return out if group else out.drop("_one")
