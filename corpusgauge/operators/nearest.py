"""Nearest neighbours in any dimension: exact by a partition of the space, or approximate by projections.

Sources form about sqrt(N) cells around as many of them as pivots. Neighbouring cells are packed into bundles of a block's size, and a
larger cell is cut into blocks of that size by a hash of the source id, so neither a dense cell nor a pile of copies is held by one task.
A target's vector travels once to each bundle, however many of its cells it must look into: where nothing can be ruled
out, as among random vectors of many dimensions, that is once for each BLOCK of sources, not once for each cell. A target first looks into one
block of its own cell, which bounds its distance well, and then only into the cells that the triangle inequality
cannot rule out by that bound. Blocks meet targets as a stream: a task holds one block and the targets pass by, each leaving its best
source there. Blocks that very many targets visit are read by several tasks. Pairs are never emitted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators.ordering import exact_percentiles
from corpusgauge.session import cut

MOST_CELLS = 4096
"""Bound on the pivots that the tasks get, whatever the number of sources; cells grow beyond it and are cut into more blocks."""
BLOCK = 16384
"""Sources that one task holds at a time."""
VISITS = 1 << 18
"""Targets of one block that one task takes."""
_SLICE = 1 << 22  # numbers held at once while distances are formed
_ROW = "key long, block long, salt long, kind int, id long, vec array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0))


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances, with the error of the expanded square taken off where they serve as bounds (see ``_SLACK``)."""
    d2 = (v**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * v @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


_SLACK = 1e-6  # relative to the vectors' lengths: far above the rounding of the expanded square's root


def _scale(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return _SLACK * (np.sqrt((v**2).sum(axis=1)) + np.sqrt((pivots**2).sum(axis=1)).max())


def _assigned(pivots: np.ndarray):
    """Task: vectors to their cell, the distance to its pivot, and a bound on the rounding."""

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("vec"))
                gap = _to_pivots(v, pivots)
                cell = gap.argmin(axis=1)
                yield pa.record_batch({
                    "id": batch.column("id"), "vec": batch.column("vec"), "cell": cell.astype(np.int64),
                    "far": gap[np.arange(len(v)), cell] + _scale(v, pivots),
                })

    return task


def _bundles(pivots: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bundle of each cell, and the number of blocks of each bundle. Cells around the same of a few pivots come one after another."""
    few = _to_pivots(pivots, pivots[:: max(1, math.isqrt(len(pivots)))]).argmin(axis=1)
    bundle, blocks, held = np.zeros(len(pivots), np.int64), [0], 0
    for cell in np.argsort(few, kind="stable").tolist():
        n = int(sizes[cell])
        if blocks[-1] and held + n > BLOCK:
            blocks.append(0)
            held = 0
        held += n
        bundle[cell] = len(blocks) - 1
        blocks[-1] = -(-held // BLOCK)
    return bundle, np.array(blocks)


def _surviving(pivots: np.ndarray, reach: np.ndarray, bundle: np.ndarray, blocks: np.ndarray):
    """Task: each target with every block of the bundles that may hold a source nearer than ``bound``."""
    starts = np.flatnonzero(np.diff(np.sort(bundle), prepend=-1))
    by_bundle = np.argsort(bundle, kind="stable")

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("vec"))
            gap, scale, bound = _to_pivots(v, pivots), _scale(v, pivots), batch.column("bound").to_numpy()
            if len(pivots) > 1:  # pivots are sources, and one of two is another row than the target
                bound = np.minimum(bound, np.partition(gap, 1, axis=1)[:, 1] + scale)
            least = gap - reach - scale[:, None]
            may = least <= bound[:, None]  # false for a cell without sources, whose reach is -inf
            at, key = np.nonzero(np.logical_or.reduceat(may[:, by_bundle], starts, axis=1))
            each = blocks[key]
            at, key = np.repeat(at, each), np.repeat(key, each)
            block = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
            for i in range(0, len(at), 8192):  # a target's vector comes once for each block it visits
                part = pa.array(at[i : i + 8192])
                yield pa.record_batch({
                    "id": batch.column("id").take(part), "vec": batch.column("vec").take(part),
                    "key": key[i : i + 8192].astype(np.int64), "block": block[i : i + 8192].astype(np.int64),
                })

    return task


def _search(skip_same: bool):
    """Task: sorted rows (the sources of a block, then its targets) to the best source of each target."""

    def best(s_id, s, t_id, t):
        step = max(1, _SLICE // max(1, len(s)))
        squares = (s**2).sum(axis=1)
        for i in range(0, len(t), step):
            ids, v = t_id[i : i + step], t[i : i + step]
            own = (v**2).sum(axis=1)
            d2 = own[:, None] + squares - 2 * v @ s.T
            if skip_same:
                d2[ids[:, None] == s_id[None, :]] = np.inf
            # the expanded square chooses; those it cannot tell apart are measured as they are
            near = d2 <= (d2.min(axis=1) + 1e-9 * (own + squares.max()))[:, None]
            near &= np.isfinite(d2)
            at, of = np.nonzero(near)
            exact = ((v[at] - s[of]) ** 2).sum(axis=1)
            by = np.lexsort((s_id[of], exact, at))
            at, of, exact = at[by], of[by], exact[by]
            first = np.ones(len(at), bool)
            first[1:] = at[1:] != at[:-1]
            if first.any():
                yield pa.record_batch({"t_id": ids[at[first]], "s_id": s_id[of[first]], "d2": exact[first]})

    def task(batches):
        key, held_id, held = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, ids = batch.column("kind").to_numpy(), batch.column("id").to_numpy()
            keys = np.stack([batch.column(c).to_numpy() for c in ("key", "block", "salt")], axis=1)
            v = _matrix(batch.column("vec"))
            new = np.ones(len(ids), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (kind[1:] != kind[:-1])
            edge = np.append(np.flatnonzero(new), len(ids))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                now = tuple(keys[a].tolist())
                if now != key:
                    key, held_id, held = now, [], []
                if kind[a] == 0:
                    held_id.append(ids[a:b])
                    held.append(v[a:b])
                elif held:
                    if len(held) > 1:
                        held_id, held = [np.concatenate(held_id)], [np.concatenate(held)]
                    yield from best(held_id[0], held[0], ids[a:b], v[a:b])

    return task


def _met(sources: DataFrame, targets: DataFrame, skip_same: bool) -> DataFrame:
    """(t_id, s_id, d2): the best source of each target in each (key, block) it visits. Both sides: ``key``, ``block``, ``id``, ``vec``."""
    visits = targets.groupBy("key", "block").agg(F.ceil(F.count(F.lit(1)) / VISITS).alias("salts"))
    s = sources.join(visits, ["key", "block"]).select("key", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "id", "vec")
    t = targets.join(visits, ["key", "block"]).select("key", "block", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), F.lit(1).alias("kind"), "id", "vec")
    rows = s.union(t).repartition("key", "block", "salt").sortWithinPartitions("key", "block", "salt", "kind")
    return rows.mapInArrow(_search(skip_same), "t_id long, s_id long, d2 double")


def _vectors(df: DataFrame, id_: str, vec: str | Column) -> DataFrame:
    value = (F.col(vec) if isinstance(vec, str) else vec).cast("array<double>")
    return df.select(F.col(id_).cast("long").alias("id"), value.alias("vec")).where("vec is not null and not exists(vec, x -> x is null or isnan(x))")


def _nearest_of(found: DataFrame) -> DataFrame:
    return found.groupBy("t_id").agg(F.min_by("s_id", F.struct("d2", "s_id")).alias("s_id"), F.min("d2").alias("d2"))


def nearest(
    targets: DataFrame, target_id: str, target_vec: str | Column,
    sources: DataFrame, source_id: str, source_vec: str | Column, skip_same: bool = False,
) -> DataFrame:
    """(t_id, s_id, d2): the closest source of every target by squared distance, ties by id.

    Ids are integers. ``skip_same`` leaves a row itself out when a table is matched to itself. Vectors that are NULL or hold a
    NULL or NaN are no sources and find none. Without any source, every target comes with NULLs.
    """
    s, t = _vectors(sources, source_id, source_vec), _vectors(targets, target_id, target_vec)
    n = s.count()
    if not n:
        return t.select(F.col("id").alias("t_id"), F.lit(None).cast("long").alias("s_id"), F.lit(None).cast("double").alias("d2"))
    # at most MOST_CELLS vectors and summary rows reach the driver, whatever the tables' sizes
    chosen = s.orderBy(F.xxhash64("id"), "id").limit(min(MOST_CELLS, math.isqrt(n) + 1)).collect()
    pivots = np.unique(np.array([r.vec for r in chosen]), axis=0)
    schema = "id long, vec array<double>, cell long, far double"
    placed = cut(s.mapInArrow(_assigned(pivots), schema), "sources")
    reach, sizes = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        reach[r.cell], sizes[r.cell] = r.far, r.n
    bundle, blocks = _bundles(pivots, sizes)
    rows = [(i, int(bundle[i]), int(blocks[bundle[i]])) for i in np.flatnonzero(sizes).tolist()]
    cells = F.broadcast(s.sparkSession.createDataFrame(rows, "cell long, key long, blocks long"))  # MOST_CELLS rows
    in_block = lambda df, seed: df.join(cells, "cell").select("key", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).alias("block"), "id", "vec")
    keyed, home = in_block(placed, 0), in_block(t.mapInArrow(_assigned(pivots), schema), 1)
    first = cut(_nearest_of(_met(keyed, home, skip_same)), "bounds")
    bound = F.coalesce(F.sqrt("d2") * (1 + 1e-9), F.lit(float("inf")))  # a lone row of its block has no bound yet
    asked = t.join(first.select(F.col("t_id").alias("id"), "d2"), "id", "left").select("id", "vec", bound.alias("bound"))
    visits = asked.mapInArrow(_surviving(pivots, reach, bundle, blocks), "id long, vec array<double>, key long, block long")
    return _nearest_of(_met(keyed, visits.select("key", "block", "id", "vec"), skip_same))


def nearest_by_projection(
    targets: DataFrame, target_id: str, target_vec: str | Column, sources: DataFrame, source_id: str, source_vec: str | Column,
    skip_same: bool = False, tables: int = 24, directions: int = 4, width: float | None = None, seed: int = 11,
) -> DataFrame:
    """(t_id, s_id, d2) of the closest source among those that share a bucket with the target: approximate, and some targets find none.

    Each of ``tables`` keys is the place of a vector on ``directions`` random lines, in steps of ``width`` (by default twice the spread of the
    sources along a line over their number of lines). More tables find more, more directions and narrower steps compare less. Every candidate
    of a bucket is measured: buckets of any size are cut into blocks as the cells of ``nearest`` are, none is capped.
    """
    s, t = _vectors(sources, source_id, source_vec), _vectors(targets, target_id, target_vec)
    one = s.select("vec").first()
    if one is None:
        return nearest(targets, target_id, target_vec, sources, source_id, source_vec, skip_same)
    lines = np.random.Generator(np.random.PCG64(seed)).normal(size=(tables * directions, len(one.vec)))
    lines /= np.sqrt((lines**2).sum(axis=1))[:, None]
    if width is None:
        spread = s.select(F.aggregate(F.zip_with("vec", F.array(*[F.lit(float(x)) for x in lines[0]]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b).alias("p"))
        width = 2.0 * (spread.agg(F.stddev_pop("p")).first()[0] or 1.0)
    shift = np.random.Generator(np.random.PCG64(seed + 1)).uniform(0, width, tables * directions)

    def keys(batches):
        for batch in batches:
            if batch.num_rows:
                step = np.floor((_matrix(batch.column("vec")) @ lines.T + shift) / width).astype(np.int64).reshape(batch.num_rows, tables, directions)
                key = np.broadcast_to(np.arange(tables, dtype=np.uint64), step.shape[:2]).copy()
                for k in range(directions):
                    key = (key ^ step[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                at = pa.array(np.repeat(np.arange(batch.num_rows), tables))
                yield pa.record_batch({"id": batch.column("id").take(at), "vec": batch.column("vec").take(at), "key": key.ravel().view(np.int64)})

    schema = "id long, vec array<double>, key long"
    s, t = cut(s.mapInArrow(keys, schema), "sources"), t.mapInArrow(keys, schema)
    sizes = s.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    s = s.join(sizes, "key").select("key", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "vec")
    t = t.join(sizes, "key").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "id", "vec")
    return _nearest_of(_met(s, t, skip_same))


def with_attributes(matches: DataFrame, sources: DataFrame, source_id: str) -> DataFrame:
    """The matched source's other columns beside each target."""
    return matches.join(sources.withColumnRenamed(source_id, "s_id"), "s_id", "left")


def proximity(matches: DataFrame, targets: DataFrame, target_id: str, group: str, extent: DataFrame) -> DataFrame:
    """(group, n, percent): median nearest distance as a percentage of ``extent(group, extent)``."""
    placed = matches.join(targets.select(F.col(target_id).alias("t_id"), group), "t_id")
    placed = placed.withColumn("_d", F.sqrt("d2"))
    q = exact_percentiles(placed, "_d", [0.5], [group]).join(extent, group)
    size = F.greatest(F.col("extent"), F.lit(1e-9))
    return q.select(group, "n", (F.col("q") * 100 / size).alias("percent"))


FAN = 4
"""Squares of the next finer level along each side of a square."""
LEAF = 3
"""Levels that a leaf of the pyramid spans: FAN ** LEAF cells along each side, whose cells are one row."""
STRIP = 32
"""Cells of a column that share one number, as bits."""


def _pyramid(mask: DataFrame, group: str, levels: int) -> DataFrame:
    """(level, group, sx, sy, below): every occupied square of side FAN ** level above the leaves, and which of its parts are occupied, as bits."""
    each = mask.select(group, "_cx", "_cy", F.explode(F.sequence(F.lit(LEAF + 1), F.lit(levels))).alias("level"))
    side = F.pow(F.lit(FAN), F.col("level") - 1).cast("long")
    part_x, part_y = F.floor(F.col("_cx") / side), F.floor(F.col("_cy") / side)
    within = lambda p: p - F.floor(p / FAN) * FAN
    bit = F.call_function("shiftleft", F.lit(1), (within(part_x) * FAN + within(part_y)).cast("int"))
    placed = each.select("level", group, F.floor(part_x / FAN).alias("sx"), F.floor(part_y / FAN).alias("sy"), bit.alias("bit"))
    return placed.groupBy("level", group, "sx", "sy").agg(F.bit_or("bit").alias("below"))


def _leaves(mask: DataFrame, group: str) -> DataFrame:
    """(group, sx, sy, strips): the occupied strips (column, rows) of every leaf; repeated cells count once."""
    side = FAN**LEAF
    strip = F.floor(F.col("_cy") / STRIP)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_cy") - strip * STRIP).cast("int"))
    strips = mask.groupBy(group, F.col("_cx").alias("cx"), (strip * STRIP).alias("cy")).agg(F.bit_or(bit).alias("bits"))
    rows = F.filter(F.sequence(F.lit(0), F.lit(STRIP - 1)), lambda i: F.getbit("bits", i) == 1)
    filled = F.struct(F.col("cx").cast("double").alias("cx"), F.transform(rows, lambda i: (F.col("cy") + i).cast("double")).alias("rows"))
    placed = strips.select(group, F.floor(F.col("cx") / side).alias("sx"), F.floor(F.col("cy") / side).alias("sy"), filled.alias("strip"))
    return placed.groupBy(group, "sx", "sy").agg(F.collect_list("strip").alias("strips"))


def _nearest_square(a: Column, b: Column) -> Column:
    """Squared distance from (a, b) to the nearest cell of ``strips``. Columns farther than the best so far are passed over."""
    def nearer(best, s):
        aside = (a - s["cx"]) * (a - s["cx"])
        return F.when(aside >= best, best).otherwise(F.least(best, aside + F.array_min(F.transform(s["rows"], lambda r: (b - r) * (b - r)))))

    return F.aggregate("strips", F.lit(float("inf")), nearer)


def lattice_distance(points: DataFrame, cells: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """(group, x, y, n, distance): exact distance from each distinct point to the nearest mask cell of its
    group. NULL for a group without mask cells, and for a point with a NULL, NaN or infinite coordinate.

    The occupied squares of each group form a pyramid whose sides shrink by FAN from level to level, down to leaves of
    FAN ** LEAF cells a side. A point goes down it with the squares that may hold its nearest cell: every occupied square holds a cell
    no farther than its far corner, and those that begin beyond the least of these bounds are left out. Rounds grow with the logarithm
    of the extent, and a point meets a few squares in each, not the cells of its group. Masks of one leaf take no round: a point meets
    its group's leaf and is done.
    """
    keys = [group, x, y]
    spots = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    whole = lambda c: F.floor(F.col(c).cast("double")).cast("long")
    mask = cells.select(group, whole(x).alias("_cx"), whole(y).alias("_cy")).where("_cx is not null and _cy is not null")
    low = mask.agg(F.min("_cx"), F.max("_cx"), F.min("_cy"), F.max("_cy")).first()
    if low[0] is None:
        return spots.withColumn("distance", F.lit(None).cast("double"))
    x0, y0 = low[0], low[2]
    levels = LEAF
    while FAN**levels <= max(low[1] - x0, low[3] - y0):
        levels += 1
    mask = mask.withColumns({"_cx": F.col("_cx") - x0, "_cy": F.col("_cy") - y0})
    px, py = F.col(x).cast("double") - x0, F.col(y).cast("double") - y0
    finite = lambda c: F.abs(c) < float("inf")  # noqa: E731  (false for NaN, NULL for NULL)
    placeable = finite(F.col(x).cast("double")) & finite(F.col(y).cast("double"))
    leaves = _leaves(mask, group)
    if levels == LEAF:
        met = spots.join(leaves.select(F.col(group).alias("_group"), "strips"), F.col(group) == F.col("_group"), "left")
        return met.select(*keys, "n", F.when(placeable, F.sqrt(_nearest_square(px, py))).alias("distance"))
    squares = cut(_pyramid(mask.distinct(), group, levels), "squares")
    asked = spots.where(placeable)
    # one spot: a number that stands for it, so the rounds carry no group columns twice
    asked = cut(asked.select(*keys, px.alias("_px"), py.alias("_py"), F.monotonically_increasing_id().alias("_spot")), "spots")
    top = F.array(F.struct(F.lit(0).cast("long").alias("sx"), F.lit(0).cast("long").alias("sy")))
    far = F.lit(float("inf"))
    left = asked.select("_spot", F.col(group).alias("_group"), "_px", "_py", far.alias("_bound"), top.alias("_open"))
    a, b = F.col("_px"), F.col("_py")
    bits = F.filter(F.sequence(F.lit(0), F.lit(FAN * FAN - 1)), lambda i: F.getbit(F.col("below"), i) == 1)
    for level in range(levels, LEAF, -1):
        side = FAN ** (level - 1)  # of the parts
        here = squares.where(F.col("level") == level).select(F.col(group).alias("_group"), "sx", "sy", "below")
        near = left.select("_spot", "_group", "_px", "_py", "_bound", F.inline("_open"))
        met = near.join(here, ["_group", "sx", "sy"])
        column = lambda i: F.col("sx") * FAN + F.floor(i / FAN)
        row = lambda i: F.col("sy") * FAN + i % FAN
        gap = lambda p, c: F.greatest(c * side - p, p - (c * side + (side - 1)), F.lit(0.0))  # noqa: E731, B023
        reach = lambda p, c: F.greatest(F.abs(p - c * side), F.abs(p - (c * side + (side - 1))))  # noqa: E731, B023
        low = lambda i: gap(a, column(i)) ** 2 + gap(b, row(i)) ** 2  # noqa: E731, B023
        high = lambda i: reach(a, column(i)) ** 2 + reach(b, row(i)) ** 2  # noqa: E731, B023
        # parts of one square are pruned by the bound so far and by their own, those of all squares of the spot by the least
        judged = met.select("_spot", "_group", "_px", "_py", F.least("_bound", F.array_min(F.transform(bits, high))).alias("_bound"), F.transform(
            bits, lambda i: F.struct(low(i).alias("lo"), column(i).alias("sx"), row(i).alias("sy"))).alias("_parts"))  # noqa: B023
        kept = judged.withColumn("_parts", F.filter("_parts", lambda s: s["lo"] <= F.col("_bound")))
        whole = kept.groupBy("_spot").agg(F.first("_group").alias("_group"), F.first("_px").alias("_px"), F.first("_py").alias("_py"),
                                          F.min("_bound").alias("_bound"), F.flatten(F.collect_list("_parts")).alias("_parts"))
        opened = F.transform(F.filter("_parts", lambda s: s["lo"] <= F.col("_bound")), lambda s: F.struct(s["sx"].alias("sx"), s["sy"].alias("sy")))
        left = whole.select("_spot", "_group", "_px", "_py", "_bound", opened.alias("_open"))
        if level % 4 == 0:
            left = cut(left, "spots")  # many levels do not make one plan
    last = left.select("_spot", "_group", "_px", "_py", F.inline("_open")).join(leaves.withColumnRenamed(group, "_group"), ["_group", "sx", "sy"])
    found = last.select("_spot", _nearest_square(a, b).alias("_d2")).groupBy("_spot").agg(F.sqrt(F.min("_d2")).alias("distance"))
    known = asked.join(found, "_spot").select(*[F.col(k).alias(f"_{k}") for k in keys], "distance")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return spots.join(known, same, "left").drop(*[f"_{k}" for k in keys])
