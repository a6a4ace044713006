"""Meshes, masks, pixels and trees as tables of vertices, faces, cells and parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions import geometry
from corpusgauge.functions.vectors import cross, inner, minus
from corpusgauge.operators.linked import AT_ONCE, list_sums
from corpusgauge.operators.ordering import in_order, neighbour, running_totals
from corpusgauge.session import cut, dealt


def visibility(
    vertices: DataFrame, keypoints: DataFrame, render: str, px: str, py: str, depth: str,
    width: int, height: int, tolerance: float = 0.02, empty_is_visible: bool = True,
) -> DataFrame:
    """Keypoints with ``visibility``: 2 visible, 1 behind a nearer vertex of its pixel, 0 outside.

    In-frame pixels without a vertex read as visible, or as outside with ``empty_is_visible=False``.
    """
    inside = lambda: (
        (F.col(px) >= 0) & (F.col(px) < width) & (F.col(py) >= 0) & (F.col(py) < height) & (F.col(depth) > 0)
    )
    cell = [F.floor(px).alias("_x"), F.floor(py).alias("_y")]
    buffer = vertices.where(inside()).groupBy(render, *cell).agg(F.min(depth).alias("_near"))
    placed = keypoints.withColumn("_x", F.floor(px)).withColumn("_y", F.floor(py))
    seen = placed.join(buffer, [render, "_x", "_y"], "left")
    empty = geometry.VISIBLE if empty_is_visible else geometry.OUT_OF_FRAME
    state = (
        F.when(~inside(), geometry.OUT_OF_FRAME).when(F.col("_near").isNull(), empty)
        .when(F.col(depth) <= F.col("_near") + tolerance, geometry.VISIBLE).otherwise(geometry.OCCLUDED)
    )
    return seen.withColumn("visibility", state.cast("byte")).drop("_x", "_y", "_near")


def iou(left: DataFrame, right: DataFrame, group: str, cell: Sequence[str], groups: DataFrame) -> DataFrame:
    """(group, shared, either, iou) of two masks' cells. An empty union scores 0."""
    sides = left.select(group, *cell, F.lit(1).alias("_s")).unionByName(right.select(group, *cell, F.lit(2).alias("_s")))
    cells = dealt(sides, sides.count(), group, *cell).groupBy(group, *cell).agg(F.bit_or("_s").alias("_k"))
    per = cells.groupBy(group).agg(F.count_if(F.col("_k") == 3).alias("shared"), F.count(F.lit(1)).alias("either"))
    every = groups.select(group).distinct().join(per, group, "left").fillna({"shared": 0, "either": 0})
    ratio = F.when(F.col("either") > 0, F.col("shared") / F.nullif("either", F.lit(0))).otherwise(0.0)
    return every.withColumn("iou", ratio)


def masked_metrics(
    cells: DataFrame, group: Sequence[str], covered: str, depth: tuple[str, str],
    normal: tuple[Sequence[str], Sequence[str]],
) -> DataFrame:
    """Depth L1, normal L1 and mean cosine over covered cells; a group with none scores 0, 0, 1."""
    a, b = ([F.col(c).cast("double") for c in side] for side in normal)
    on = F.col(covered)
    length = lambda v: F.sqrt(inner(v, v)) + 1e-9
    cosine = F.least(F.greatest(inner(a, b) / (length(a) * length(b)), F.lit(-1.0)), F.lit(1.0))
    normal_gap = sum((F.abs(x - y) for x, y in zip(a, b)), F.lit(0.0)) / len(a)
    gap = F.abs(F.col(depth[0]).cast("double") - F.col(depth[1]).cast("double"))
    mean = lambda c, default: F.coalesce(F.avg(F.when(on, c)), F.lit(default))
    return cells.groupBy(*group).agg(
        F.count_if(on).alias("n_covered"), mean(gap, 0.0).alias("depth_l1"),
        mean(normal_gap, 0.0).alias("normal_l1"), mean(cosine, 1.0).alias("normal_dot"),
    )


def bounding_boxes(
    vertices: DataFrame, mesh: str, xyz: Sequence[str], margin: float = 1.2, symmetric: float = 0.05
) -> DataFrame:
    """Per mesh: extents, up axis (the longest; the first of equals), whether it beats the next by
    ``margin``, and left/right asymmetry."""
    ends = [f(c).alias(f"{n}_{c}") for c in xyz for n, f in (("lo", F.min), ("hi", F.max))]
    box = vertices.groupBy(mesh).agg(F.count(F.lit(1)).alias("n_vertices"), *ends)
    sizes = F.array(*[F.col(f"hi_{c}") - F.col(f"lo_{c}") for c in xyz])
    box = box.withColumn("extent", sizes)
    ranked = F.sort_array("extent", asc=False)
    offset = F.abs(F.col(f"lo_{xyz[0]}") + F.col(f"hi_{xyz[0]}"))
    return box.select(
        mesh, "n_vertices", *[F.get("extent", F.lit(i)).alias(f"extent_{c}") for i, c in enumerate(xyz)],
        (F.array_position("extent", F.array_max("extent")) - 1).cast("int").alias("up_axis"),
        (F.get(ranked, F.lit(0)) >= margin * F.get(ranked, F.lit(1))).alias("clear_up"),
        offset.alias("asymmetry"), (offset < symmetric).alias("symmetric"),
    )


def corners(faces: DataFrame, face: Sequence[str], vertices: DataFrame, vertex: str, xyz: Sequence[str]) -> DataFrame:
    """Faces with the coordinates of their three corners as a0..a2, b0..b2, c0..c2."""
    out = faces
    for name, corner in zip("abc", face):
        at = vertices.select(F.col(vertex).alias(corner), *[F.col(c).alias(f"{name}{i}") for i, c in enumerate(xyz)])
        out = out.join(at, corner)
    return out


def _corner(name: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{name}{i}") for i in range(3))


FACES = 1 << 18
"""Faces that one task gathers, and rows that meet one copy of a vertex."""


def signed_volume(
    faces: DataFrame, mesh: str, face: Sequence[str], vertices: DataFrame, vertex: str, xyz: Sequence[str]
) -> DataFrame:
    """Sum of corner triple products over six: negative means the surface is mirrored.

    Equal faces are counted first; then the corners of a face meet their vertices in one join, as rows, and not in three. Tasks are as
    many as the faces ask for, so the memory of one does not grow with them, and a vertex of very many faces is copied."""
    parts = max(1, -(-faces.count() // FACES))
    unique = faces.repartition(parts, mesh, *face).groupBy(mesh, *face).agg(F.count(F.lit(1)).alias("_w"))
    used = faces.select(F.explode(F.array(*face)).alias("_at")).groupBy("_at").agg(F.ceil(F.count(F.lit(1)) / FACES).alias("_salts"))
    busy = F.broadcast(used.where("_salts > 1"))  # at most three rows for each FACES faces
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    each = unique.select(mesh, *face, "_w", F.posexplode(F.array(*face)).alias("_slot", "_at")).join(busy, "_at", "left")
    each = each.withColumn("_salt", F.pmod(F.xxhash64(mesh, *face), salts)).drop("_salts")
    known = vertices.select(F.col(vertex).alias("_at"), *[F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate(xyz)]).join(busy, "_at", "left")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
    placed = each.join(known, ["_at", "_salt"]).repartition(parts, mesh, *face)
    at = lambda slot, i: F.max(F.when(F.col("_slot") == slot, F.col(f"_p{i}"))).alias(f"{'abc'[slot]}{i}")
    whole = placed.groupBy(mesh, *face, "_w").agg(F.count(F.lit(1)).alias("_n"), *[at(s, i) for s in range(3) for i in range(3)]).where("_n = 3")
    six = inner(_corner("a"), cross(_corner("b"), _corner("c"))) * F.col("_w")
    return whole.groupBy(mesh).agg(F.sum("_w").alias("n_faces"), (F.sum(six) / 6.0).alias("signed_volume"))


def edge_pairs(faces: DataFrame, mesh: str, face: Sequence[str]) -> DataFrame:
    """(mesh, n_edges, open_edges, flipped_edges, crowded_edges): in a closed surface of one orientation two faces meet in every edge and run
    through it in opposite directions. An edge of one face is open, one that two faces run through in the same
    direction is flipped, and one of three or more faces is crowded."""
    ends = [(face[0], face[1]), (face[1], face[2]), (face[2], face[0])]
    each = faces.select(mesh, F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends])).alias("e")).select(mesh, "e.*")
    edges = each.where("u <> v").select(mesh, (F.col("u") < F.col("v")).alias("_rises"), F.least("u", "v").alias("_lo"), F.greatest("u", "v").alias("_hi"))
    parts = max(1, -(-3 * faces.count() // FACES))  # as many tasks as the edges ask for
    met = edges.repartition(parts, mesh, "_lo", "_hi").groupBy(mesh, "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_rises").alias("_up")
    )
    return met.groupBy(mesh).agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if(F.col("_n") == 1).alias("open_edges"),
        F.count_if((F.col("_n") == 2) & (F.col("_up") != 1)).alias("flipped_edges"), F.count_if(F.col("_n") > 2).alias("crowded_edges"),
    )


def side_split(joints: DataFrame, mesh: str, name: str, xyz: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(mesh, right_dot, left_dot, sides_split): mean place along ``right`` of the joints named ``.R`` and of those named ``.L``. The sides
    are split if the right ones lie on the positive and the left ones on the negative side; false if a side has no joint."""
    along = sum((F.col(c) * F.col(r) for c, r in zip(xyz, right, strict=True)), F.lit(0.0))
    mean = lambda end: F.avg(F.when(F.col(name).endswith(end), along))
    sides = joints.groupBy(mesh).agg(mean(".R").alias("right_dot"), mean(".L").alias("left_dot"))
    return sides.withColumn("sides_split", F.coalesce((F.col("right_dot") > 0) & (F.col("left_dot") < 0), F.lit(False)))


def handedness(sides: DataFrame, mesh: str, volumes: DataFrame, edges: DataFrame, bases: DataFrame | None = None, basis: Sequence[str] = ()) -> DataFrame:
    """One verdict row per mesh of any input: the three witnesses against a mirrored or turned surface, and ``problem``, the first that speaks
    against it (NULL: right-handed). A mirrored body keeps its sides, as ``right`` mirrors with it; its volume and
    its bases change sign. ``bases``: (mesh, nine numbers, row by row). A mesh without faces or bases lacks that witness
    and is judged by the others; one without joints on both sides is a problem."""
    out = sides.join(volumes, mesh, "full_outer").join(edges, mesh, "full_outer")
    if bases is not None:
        rows = [tuple(F.col(c) for c in basis[i : i + 3]) for i in (0, 3, 6)]
        turned = bases.groupBy(mesh).agg(F.count_if(determinant(rows) < 0).alias("negative_bases"))
        out = out.join(turned, mesh, "full_outer")
    else:
        out = out.withColumn("negative_bases", F.lit(None).cast("long"))
    problem = (
        F.when(~F.coalesce("sides_split", F.lit(False)), "sides are not split")
        .when(F.col("signed_volume") <= 0, "volume is not positive").when(F.col("negative_bases") > 0, "bases are mirrored")
        .when(F.col("flipped_edges") > 0, "faces are flipped")
    )
    return out.withColumn("problem", problem).withColumn("handed", F.col("problem").isNull())


def determinant(m: Sequence[Sequence[Column]]) -> Column:
    """Of a 3x3 basis: negative means a reflection."""
    return inner(tuple(m[0]), cross(tuple(m[1]), tuple(m[2])))


def vertex_normals(
    faces: DataFrame, face: Sequence[str], vertices: DataFrame, vertex: str, xyz: Sequence[str],
    default: Sequence[float] = (0.0, 0.0, 1.0),
) -> DataFrame:
    """Area-weighted normals summed onto vertices. A vertex in no face, or whose normals cancel,
    takes ``default``. Equal faces are counted once and weighted, before anything is joined."""
    unique = faces.groupBy(*face).agg(F.count(F.lit(1)).alias("_w"))
    placed = corners(unique, face, vertices, vertex, xyz)
    a, b, c = (_corner(n) for n in "abc")
    n = cross(minus(b, a), minus(c, a))
    weighted = placed.select(*face, *[(v * F.col("_w")).alias(f"_n{i}") for i, v in enumerate(n)])
    each = weighted.select(F.explode(F.array(*face)).alias(vertex), "_n0", "_n1", "_n2")
    summed = each.groupBy(vertex).agg(*[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(3)])
    length = F.sqrt(sum((F.col(f"_n{i}") ** 2 for i in range(3)), F.lit(0.0)))
    every = vertices.select(vertex).join(summed, vertex, "left").withColumn("_len", length)
    unit = [
        F.when(F.col("_len") > 1e-12, F.col(f"_n{i}") / F.col("_len")).otherwise(default[i]).alias(f"n{c}")
        for i, c in enumerate("xyz")
    ]
    return every.select(vertex, F.col("_len").isNull().alias("in_no_face"), *unit)


def fan(polygons: DataFrame, key: Sequence[str], corners_: str) -> DataFrame:
    """(key, tri, a, b, c): triangles sharing the polygon's first corner."""
    n = F.size(corners_)
    steps = F.when(n >= 3, F.sequence(F.lit(1), n - 2))
    each = polygons.select(*key, F.col(corners_).alias("_c"), F.explode(steps).alias("tri"))
    return each.select(
        *key, "tri", F.get("_c", F.lit(0)).alias("a"), F.get("_c", F.col("tri")).alias("b"),
        F.get("_c", F.col("tri") + 1).alias("c"),
    )


def sparse(df: DataFrame, shape: str, value: Column, eps: float) -> DataFrame:
    """(shape, n_kept, largest) of the entries whose size exceeds ``eps``."""
    big = df.where(F.abs(value) > eps)
    return big.groupBy(shape).agg(F.count(F.lit(1)).alias("n_kept"), F.max(F.abs(value)).alias("largest"))


def weight_sums(df: DataFrame, key: str, item: str, weight: str, tolerance: float = 1e-4) -> DataFrame:
    """(key, total, ok, dominant): weights must sum to 1; the heaviest item wins, ties by item."""
    total = F.sum(weight)
    return df.groupBy(key).agg(
        total.alias("total"), (F.abs(total - 1.0) <= tolerance).alias("ok"),
        F.max_by(item, F.struct(F.col(weight), -F.col(item))).alias("dominant"),
    )


# -- trees -----------------------------------------------------------------------------------------

def tree_paths(nodes: DataFrame, node: str, parent: str, name: str, root: int = -1) -> tuple[DataFrame, DataFrame]:
    """((node, path, depth), problems). A parent must come before its child and must exist.

    Every round doubles the distance each node has climbed, so a tree of depth d takes log2(d) rounds.
    """
    known = nodes.select(F.col(node).alias(parent), F.lit(True).alias("_known")).distinct()
    judged = nodes.join(known, parent, "left").withColumn(
        "problem",
        F.when(F.col(parent) == root, None).when(F.col(parent) >= F.col(node), "parent does not come before child")
        .when(F.col("_known").isNull(), "parent does not exist"),
    )
    problems = judged.where("problem is not null").select(node, parent, "problem")
    climb = cut(judged.where("problem is null").select(
        F.col(node).alias("node"), F.col(parent).alias("up"), F.col(name).cast("string").alias("path"), F.lit(1).alias("depth")
    ))
    while not climb.where(F.col("up") != root).isEmpty():
        above = climb.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"),
                             F.col("depth").alias("_depth"))
        joined = climb.join(above, "up", "left")
        moved = F.col("_up").isNotNull()
        lost = (F.col("up") != root) & ~moved  # an ancestor was itself a problem: stop there
        climb = cut(joined.select(
            "node", F.when(moved, F.col("_up")).when(lost, F.lit(root)).otherwise(F.col("up")).alias("up"),
            F.when(moved, F.concat("_path", F.lit("/"), "path")).otherwise(F.col("path")).alias("path"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        ))
    return climb.select(F.col("node").alias(node), "path", "depth"), problems


def subtree_ranges(nodes: DataFrame, node: str, parent: str, root: int = -1, at_once: int = AT_ONCE) -> DataFrame:
    """(node, first, last): nodes numbered in pre-order from 0, so that a node and everything below it hold the
    numbers ``first`` to ``last``. A parent that is no node counts as a root.

    The walk around the tree, down to a node and up from it, is one linked list for each root; ranking it takes
    rounds in the logarithm of its length and rows in proportion to the nodes, whatever the depth. A parent must
    come before its child, so there are no rings; one that does not raises. Node ids are whole numbers, 0 or more, and unique.
    """
    out_of_order = F.raise_error(F.lit("a parent must come before its child")).cast("long")
    known = nodes.select(F.col(node).cast("long").alias("_up"), F.lit(True).alias("_known"))
    flat = nodes.select(F.col(node).cast("long").alias("node"), F.col(parent).cast("long").alias("_up"))
    flat = flat.withColumn("_up", F.when((F.col("_up") == root) | (F.col("_up") < F.col("node")), F.col("_up")).otherwise(out_of_order))
    top = F.lit(None).cast("long")
    tree = cut(flat.join(known, "_up", "left").select("node", F.when(F.col("_known") & (F.col("_up") != root), F.col("_up")).otherwise(top).alias("up")), "tree")
    # roots are children of one node above them, so all trees are one list: its arcs are 0 and 1, those of a node follow
    enter, leave = (lambda c: F.col(c) * 2 + 2), (lambda c: F.col(c) * 2 + 3)
    below = tree.select("node", F.coalesce("up", F.lit(-1).cast("long")).alias("up"))
    first = below.groupBy("up").agg(F.min("node").alias("child"))
    after = neighbour(below, ["node"], F.col("node"), "after", ["up"])
    tied = after.join(first.withColumnRenamed("up", "node"), "node", "left")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    arcs = tied.select(F.explode(F.array(
        F.struct(enter("node").alias("id"), F.coalesce(enter("child"), leave("node")).alias("next"), one.alias("n")),
        F.struct(leave("node").alias("id"), F.coalesce(enter("after"), leave("up")).alias("next"), none.alias("n")),
    )).alias("a")).select("a.*")
    ends = first.where("up = -1").select(F.explode(F.array(
        F.struct(none.alias("id"), enter("child").alias("next"), none.alias("n")), F.struct(one.alias("id"), top.alias("next"), none.alias("n")),
    )).alias("a")).select("a.*")
    sums = list_sums(arcs.union(ends), ["n"], at_once=at_once).where("id > 1")
    at = lambda up: F.max(F.when(F.col("id") % 2 == up, F.col("n")))
    ranges = sums.groupBy((F.shiftright("id", 1) - 1).alias(node)).agg(at(0).alias("first"), (at(1) - 1).alias("last"))
    return ranges


def weighted_centroids(
    weights: DataFrame, group: str, weight: str, xyz: Sequence[str], nodes: DataFrame, node: str, parent: str,
    fewest: float = 1e-6, root: int = -1,
) -> DataFrame:
    """(node, source, centroid...): a node's own weighted centroid, else that of it and everything below it,
    else a problem.

    The total of a subtree is the difference of two running sums over the nodes in pre-order. The sums are kept as decimals
    of 12 places, so the difference is exact and does not depend on what lies outside the subtree."""
    exact = "decimal(38,12)"
    names = ["w", *xyz]
    own = weights.groupBy(F.col(group).alias(node)).agg(
        F.sum(weight).cast(exact).alias("_w"), *[F.sum(F.col(c) * F.col(weight)).cast(exact).alias(f"_{c}") for c in xyz]
    )
    placed = subtree_ranges(nodes, node, parent, root).join(own, node, "left")
    placed = cut(placed.select(node, "first", "last", *[F.coalesce(f"_{c}", F.lit(0).cast(exact)).alias(f"_{c}") for c in names]), "placed")
    tagged = in_order(placed.select("first", *[f"_{c}" for c in names]), ["first"])
    upto = running_totals(tagged, {f"_to_{c}": F.col(f"_{c}") for c in names}, []).select(F.col("first").alias("_at"), *[f"_to_{c}" for c in names])
    upto = cut(upto, "sums")
    through = placed.join(upto.withColumnRenamed("_at", "last"), "last")
    before = upto.select((F.col("_at") + 1).alias("first"), *[F.col(f"_to_{c}").alias(f"_before_{c}") for c in names])
    each = through.join(before, "first", "left")
    total = {c: (F.col(f"_to_{c}") - F.coalesce(f"_before_{c}", F.lit(0).cast(exact))).cast("double") for c in names}
    mine = {c: F.col(f"_{c}").cast("double") for c in names}
    has_own, has_any = mine["w"] >= fewest, total["w"] >= fewest
    source = F.when(has_own, "own").when(has_any, "descendants").otherwise("problem")
    at = lambda c: F.when(has_own, mine[c] / F.nullif(mine["w"], F.lit(0.0))).when(has_any, total[c] / F.nullif(total["w"], F.lit(0.0)))
    return each.select(node, source.alias("source"), *[at(c).alias(c) for c in xyz])
