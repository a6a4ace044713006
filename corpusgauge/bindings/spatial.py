"""Geometry over the given tables: parts are vertices, order lines are faces, cells or points."""

from pyspark.sql import functions as F

from corpusgauge.bindings.registry import query
from corpusgauge.functions import geometry, vectors
from corpusgauge.operators import generate, nearest, spatial


@query("""with p as (select a.vec_id t_id, b.vec_id s_id, b.label, list_distance(a.embedding::double[], b.embedding::double[]) d from embeddings a join embeddings b on a.vec_id <> b.vec_id)
 select t_id, min_by(s_id, (d, s_id)) s_id, round(min(d) * min(d), 5) d2, min_by(label, (d, s_id)) label from p group by 1""")
def knn1(t):
    e = t.embeddings
    found = nearest.nearest(e, "vec_id", "embedding", e, "vec_id", "embedding", skip_same=True)
    with_label = nearest.with_attributes(found, e.select("vec_id", "label"), "vec_id")
    return with_label.select("t_id", "s_id", F.round("d2", 5).alias("d2"), "label")


@query("""with e as (select vec_id, embedding::double[] v from embeddings), t as (select vec_id id, 'matched' pair, list_transform(v, lambda x: x + 0.0001) v from e
  union all select vec_id + 1000000000, 'mispaired', list_transform(v, lambda x: x * 2 + 3) from e),
 d as (select id, pair, min(list_distance(t.v, e.v)) d from t, e group by 1, 2), x as (select max(r) extent from (select max(v[i]) - min(v[i]) r from e, unnest(range(1, 65)) u(i) group by i))
 select pair, count(*) n, round(quantile_cont(d, 0.5) * 100 / (select extent from x), 4) percent, case when pair = 'matched' then quantile_cont(d, 0.5) * 100 / (select extent from x) <= 1 else quantile_cont(d, 0.5) * 100 / (select extent from x) > 3 end ok from d group by 1""")
def proximity_audit(t):
    e = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    near = e.select(F.col("vec_id").alias("id"), F.lit("matched").alias("pair"), F.transform("v", lambda x: x + 0.0001).alias("v"))
    far = e.select((F.col("vec_id") + 1000000000).alias("id"), F.lit("mispaired").alias("pair"), F.transform("v", lambda x: x * 2 + 3).alias("v"))
    targets = near.unionByName(far)
    sides = e.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg((F.max("x") - F.min("x")).alias("side"))
    size = sides.agg(F.max("side").alias("extent"))
    size = generate.with_rows(size, [("matched",), ("mispaired",)], "pair")
    p = nearest.proximity(nearest.nearest(targets, "id", "v", e, "vec_id", "v"), targets, "id", "pair", size)
    ok = F.when(F.col("pair") == "matched", F.col("percent") <= 1).otherwise(F.col("percent") > 3)
    return p.select("pair", "n", F.round("percent", 4).alias("percent"), ok.alias("ok"))


@query("""select a.vec_id, round(list_sum(list_transform(list_zip(a.embedding::double[], b.embedding::double[]), lambda p: p[1] * p[2])) /
  ((sqrt(list_sum(list_transform(a.embedding::double[], lambda x: x * x))) + 1e-9) * (sqrt(list_sum(list_transform(b.embedding::double[], lambda x: x * x))) + 1e-9)), 6) cosine
 from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def cosine(t):
    a = t.embeddings.select("vec_id", "embedding")
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(vectors.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query("""with m as (select distinct l_suppkey s, l_quantity::int x, (round(l_discount * 100))::int y from lineitem where l_returnflag <> 'R'),
 p as (select l_suppkey s, l_quantity * 1.5 + 0.5 x, l_tax * 2500 y, count(*) n from lineitem where l_returnflag <> 'A' group by 1, 2, 3)
 select p.s l_suppkey, p.x, round(p.y, 4) y, p.n, round(min(sqrt((p.x - m.x) ** 2 + (p.y - m.y) ** 2)), 5) distance
 from p left join m on m.s = p.s group by p.s, p.x, p.y, p.n""")
def mask_distance(t):
    y = F.round(F.col("l_discount") * 100)
    cells = t.lineitem.where("l_returnflag <> 'R'").select("l_suppkey", F.col("l_quantity").alias("x"), y.alias("y"))
    points = t.lineitem.where("l_returnflag <> 'A'").select("l_suppkey", (F.col("l_quantity") * 1.5 + 0.5).alias("x"), (F.col("l_tax") * 2500).alias("y"))
    d = nearest.lattice_distance(points, cells, "l_suppkey", "x", "y")
    return d.withColumn("distance", F.round("distance", 5)).withColumn("y", F.round("y", 4))


@query("""with a as (select l_suppkey s, l_quantity + 0.5 px, round(l_discount * 100) + 0.5 py, l_extendedprice / 1000 d, l_returnflag f from lineitem),
 b as (select s, floor(px) x, floor(py) y, min(d) near from a where f <> 'A' and px < 40 and py < 9 and d > 0 group by 1, 2, 3)
 select a.s l_suppkey, px, py, d as depth, (case when not (px < 40 and py < 9 and d > 0) then 0 when near is null then 2 when d <= near + 0.02 then 2 else 1 end)::int visibility
 from a left join b on a.s = b.s and floor(px) = x and floor(py) = y where f = 'A'""")
def zbuffer_vis(t):
    p = t.lineitem.select("l_suppkey", (F.col("l_quantity") + 0.5).alias("px"), (F.round(F.col("l_discount") * 100) + 0.5).alias("py"),
                          (F.col("l_extendedprice") / 1000).alias("depth"), "l_returnflag")
    surface, keys = p.where("l_returnflag <> 'A'"), p.where("l_returnflag = 'A'").drop("l_returnflag")
    out = spatial.visibility(surface, keys, "l_suppkey", "px", "py", "depth", 40, 9)
    return out.withColumn("visibility", F.col("visibility").cast("int"))


@query("""with c as (select l_suppkey s, l_quantity x, l_discount y, bool_or(l_returnflag <> 'R') a, bool_or(l_returnflag <> 'A') r from lineitem group by 1, 2, 3),
 g as (select s_suppkey from supplier union all select -1)
 select s_suppkey l_suppkey, count(*) filter (where a and r) shared, count(a) either, round(case when count(a) > 0 then count(*) filter (where a and r) / count(a) else 0 end, 6) iou from g left join c on s = s_suppkey group by 1""")
def iou(t):
    side = lambda other: t.lineitem.where(F.col("l_returnflag") != other)
    unseen = t.spark.range(1).select(F.lit(-1).cast("long").alias("l_suppkey"))
    renders = t.supplier.select(F.col("s_suppkey").alias("l_suppkey")).union(unseen)
    out = spatial.iou(side("R"), side("A"), "l_suppkey", ["l_quantity", "l_discount"], renders)
    return out.withColumn("iou", F.round("iou", 6))


@query("""with c as (select vec_id, embedding[i]::double a, embedding[i % 64 + 1]::double b, embedding[(i + 1) % 64 + 1]::double c, embedding[(i + 2) % 64 + 1]::double d, embedding[i] > 0 and label <> 9 m from embeddings, unnest(range(1, 65)) u(i)),
 k as (select *, abs(a - b) dl, (abs(a - b) + abs(b - c) + abs(c - d)) / 3 nl, greatest(-1, least(1, (a * b + b * c + c * d) / ((sqrt(a*a + b*b + c*c) + 1e-9) * (sqrt(b*b + c*c + d*d) + 1e-9)))) nd from c)
 select vec_id, count(*) filter (where m) n_covered, round(coalesce(avg(dl) filter (where m), 0), 6) depth_l1, round(coalesce(avg(nl) filter (where m), 0), 6) normal_l1, round(coalesce(avg(nd) filter (where m), 1), 6) normal_dot from k group by 1""")
def masked_l1(t):
    at = lambda k: F.get("embedding", F.pmod(F.col("i") + k, F.lit(64))).cast("double")
    each = t.embeddings.select("vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    cells = each.select("vec_id", ((at(0) > 0) & (F.col("label") != 9)).alias("m"), *[at(k).alias(n) for k, n in enumerate("abcd")])
    out = spatial.masked_metrics(cells, ["vec_id"], "m", ("a", "b"), (["a", "b", "c"], ["b", "c", "d"]))
    return out.select("vec_id", "n_covered", *[F.round(c, 6).alias(c) for c in ("depth_l1", "normal_l1", "normal_dot")])


@query("""with b as (select l_orderkey, count(*) n, min(l_quantity - 25) lx, max(l_quantity - 25) hx, max(l_discount * 300) - min(l_discount * 300) ey, max(l_tax * 400) - min(l_tax * 400) ez from lineitem group by 1),
 e as (select *, [hx - lx, ey, ez] x from b)
 select l_orderkey, n n_vertices, round(x[1], 4) extent_x, round(x[2], 4) extent_y, round(x[3], 4) extent_z, (case when x[1] >= x[2] and x[1] >= x[3] then 0 when x[2] >= x[3] then 1 else 2 end)::int up_axis,
 list_reverse_sort(x)[1] >= 1.2 * list_reverse_sort(x)[2] clear_up, abs(lx + hx) asymmetry, abs(lx + hx) < 0.05 as "symmetric" from e""")
def bbox_audit(t):
    v = t.lineitem.select("l_orderkey", (F.col("l_quantity") - 25).alias("x"), (F.col("l_discount") * 300).alias("y"), (F.col("l_tax") * 400).alias("z"))
    out = spatial.bounding_boxes(v, "l_orderkey", ["x", "y", "z"])
    for c in ("extent_x", "extent_y", "extent_z"):
        out = out.withColumn(c, F.round(c, 4))
    return out


VERTS = "v as (select p_partkey k, p_size::double x, length(p_name)::double y, length(p_type || p_brand)::double z from part)"


def vertices(t):
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), F.length("p_name").cast("double").alias("y"),
                         F.length(F.concat("p_type", "p_brand")).cast("double").alias("z"))


FACE = ["l_partkey", "l_suppkey", "l_linenumber"]
XYZ = ["x", "y", "z"]


@query(f"""with {VERTS} select l_orderkey, count(*) n_faces, round(sum(a.x * (b.y * c.z - b.z * c.y) + a.y * (b.z * c.x - b.x * c.z) + a.z * (b.x * c.y - b.y * c.x)) / 6, 4) signed_volume
 from lineitem join v a on a.k = l_partkey join v b on b.k = l_suppkey join v c on c.k = l_linenumber group by 1""")
def signed_volume(t):
    faces = t.lineitem.select("l_orderkey", *FACE)
    out = spatial.signed_volume(faces, "l_orderkey", FACE, vertices(t), "p_partkey", XYZ)
    return out.withColumn("signed_volume", F.round("signed_volume", 4))


@query(f"""with {VERTS}, f as (select l_orderkey m, l_partkey a, l_suppkey b, l_linenumber c, l_returnflag r, l_discount - 0.05 d, l_tax - 0.04 e from lineitem),
 vol as (select m, count(*) n_faces, sum(a.x * (b.y * c.z - b.z * c.y) + a.y * (b.z * c.x - b.x * c.z) + a.z * (b.x * c.y - b.y * c.x)) / 6 v
   from f join v a on a.k = f.a join v b on b.k = f.b join v c on c.k = f.c group by 1),
 e as (select m, a u, b w from f union all select m, b, c from f union all select m, c, a from f),
 p as (select m, least(u, w) lo, greatest(u, w) hi, count(*) n, count(*) filter (where u < w) up from e where u <> w group by all),
 ed as (select m, count(*) n_edges, count(*) filter (where n = 1) open_edges, count(*) filter (where n = 2 and up <> 1) flipped_edges, count(*) filter (where n > 2) crowded_edges from p group by 1),
 s as (select f.m, avg(v.x - 25) filter (where r = 'R') right_dot, avg(v.x - 25) filter (where r = 'A') left_dot from f join v on v.k = f.a group by 1),
 ba as (select m, count(*) filter (where d * e * (d + e) - 0.000008 < 0) negative_bases from f group by 1),
 j as (select *, coalesce(right_dot > 0 and left_dot < 0, false) sides_split from s full join vol using (m) full join ed using (m) full join ba using (m))
 select m l_orderkey, round(right_dot, 5) right_dot, round(left_dot, 5) left_dot, sides_split, round(v, 4) signed_volume, n_edges, open_edges, flipped_edges, crowded_edges, negative_bases,
  case when not sides_split then 'sides are not split' when v <= 0 then 'volume is not positive' when negative_bases > 0 then 'bases are mirrored' when flipped_edges > 0 then 'faces are flipped' end problem from j""")
def handedness(t):
    """Orders as bodies: lines are faces, the parts of returned and accepted lines are the joints of the two sides."""
    faces = t.lineitem.select("l_orderkey", *FACE)
    side = F.when(F.col("l_returnflag") == "R", "joint.R").when(F.col("l_returnflag") == "A", "joint.L").otherwise("joint")
    joints = t.lineitem.select("l_orderkey", side.alias("name"), "l_partkey").join(vertices(t), F.col("l_partkey") == F.col("p_partkey"))
    joints = joints.select("l_orderkey", "name", (F.col("x") - 25).alias("x"), "y", "z", F.lit(1.0).alias("rx"), F.lit(0.0).alias("ry"), F.lit(0.0).alias("rz"))
    d, e = F.col("l_discount") - 0.05, F.col("l_tax") - 0.04
    cells = [d, F.lit(0.02), F.lit(0.0), F.lit(0.0), e, F.lit(0.02), F.lit(-0.02), F.lit(0.0), d + e]
    names = [f"b{i}" for i in range(9)]
    bases = t.lineitem.select("l_orderkey", *[c.alias(n) for c, n in zip(cells, names, strict=True)])
    volumes = spatial.signed_volume(faces, "l_orderkey", FACE, vertices(t), "p_partkey", XYZ)
    out = spatial.handedness(spatial.side_split(joints, "l_orderkey", "name", XYZ, ["rx", "ry", "rz"]), "l_orderkey", volumes, spatial.edge_pairs(faces, "l_orderkey", FACE), bases, names)
    return out.select("l_orderkey", F.round("right_dot", 5).alias("right_dot"), F.round("left_dot", 5).alias("left_dot"), "sides_split",
                      F.round("signed_volume", 4).alias("signed_volume"), "n_edges", "open_edges", "flipped_edges", "crowded_edges", "negative_bases", "problem")


@query(f"""with {VERTS}, n as (select l_partkey i, l_suppkey j, l_linenumber k, (b.y-a.y)*(c.z-a.z) - (b.z-a.z)*(c.y-a.y) nx, (b.z-a.z)*(c.x-a.x) - (b.x-a.x)*(c.z-a.z) ny, (b.x-a.x)*(c.y-a.y) - (b.y-a.y)*(c.x-a.x) nz
   from lineitem join v a on a.k = l_partkey join v b on b.k = l_suppkey join v c on c.k = l_linenumber),
 s as (select w, sum(nx) nx, sum(ny) ny, sum(nz) nz from (select i w, nx, ny, nz from n union all select j, nx, ny, nz from n union all select k, nx, ny, nz from n) group by 1),
 u as (select p_partkey, nx, ny, nz, sqrt(nx*nx + ny*ny + nz*nz) l from part left join s on w = p_partkey)
 select p_partkey, l is null in_no_face, round(case when l > 1e-12 then nx / l else 0 end, 6) nx, round(case when l > 1e-12 then ny / l else 0 end, 6) ny, round(case when l > 1e-12 then nz / l else 1 end, 6) nz from u""")
def scatter_add(t):
    out = spatial.vertex_normals(t.lineitem.select(*FACE), FACE, vertices(t), "p_partkey", XYZ)
    return out.select("p_partkey", "in_no_face", *[F.round(c, 6).alias(c) for c in ("nx", "ny", "nz")])


@query("""select p_partkey, i::int tri, p_partkey a, p_partkey + i b, p_partkey + i + 1 c from part, unnest(range(1, p_size % 4 + 2)) u(i)""")
def fan_triangles(t):
    n = F.pmod("p_size", F.lit(4)) + 2
    poly = t.part.select("p_partkey", F.transform(F.sequence(F.lit(0), n), lambda i: F.col("p_partkey") + i).alias("corners"))
    return spatial.fan(poly, ["p_partkey"], "corners")


@query("""select label, count(*) n_kept, round(max(abs(v)), 6) largest from (select label, unnest(embedding)::double v from embeddings) where abs(v) > 0.1 group by 1""")
def sparse_nnz(t):
    each = t.embeddings.select("label", F.explode("embedding").alias("v"))
    return spatial.sparse(each, "label", F.col("v").cast("double"), 0.1).withColumn("largest", F.round("largest", 6))


@query("""with s as (select l_orderkey, sum(l_quantity) total, min(l_linestatus) st from lineitem group by 1), w as (select l_orderkey, l_partkey, case when st = 'F' then l_quantity / total else l_quantity / (total + 1) end w from lineitem join s using (l_orderkey))
 select l_orderkey, round(sum(w), 6) total, abs(sum(w) - 1) <= 1e-4 ok, max_by(l_partkey, (w, -l_partkey)) dominant from w group by 1""")
def weights_sum(t):
    per = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("s"), F.min("l_linestatus").alias("st"))
    share = F.col("l_quantity") / F.when(F.col("st") == "F", F.col("s")).otherwise(F.col("s") + 1)
    w = t.lineitem.join(per, "l_orderkey").select("l_orderkey", "l_partkey", share.alias("w"))
    return spatial.weight_sums(w, "l_orderkey", "l_partkey", "w").withColumn("total", F.round("total", 6))


@query("""with w as (select s_nationkey n, s_suppkey::double x, s_name, sum(l_quantity) w from lineitem join supplier on l_suppkey = s_suppkey group by all),
 o as (select n, sum(w) w, sum(x * w) x from w group by 1), nodes as (select r_regionkey id from region union all select n_nationkey + 5 from nation),
 own as (select id, coalesce(w, 0) w, coalesce(x, 0) x from nodes left join o on id = n + 5),
 below as (select n_regionkey id, sum(w) w, sum(x) x from nation join o on n = n_nationkey group by 1)
 select own.id, case when own.w >= 1e-6 then 'own' when own.w + coalesce(b.w, 0) >= 1e-6 then 'descendants' else 'problem' end source,
 round(case when own.w >= 1e-6 then own.x / own.w when own.w + coalesce(b.w, 0) >= 1e-6 then (own.x + b.x) / (own.w + b.w) end, 5) x from own left join below b on b.id = own.id""")
def weighted_centroid(t):
    per = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("w"))
    w = per.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("s_nationkey") + 5).alias("id"), "w", F.col("s_suppkey").cast("double").alias("x"))
    nodes = t.region.select(F.col("r_regionkey").alias("id"), F.lit(-1).alias("up")).union(
        t.nation.select(F.col("n_nationkey") + 5, F.col("n_regionkey")))
    return spatial.weighted_centroids(w, "id", "w", ["x"], nodes, "id", "up").withColumn("x", F.round("x", 5))


@query("""with recursive n as (select p_partkey k, case when p_partkey = 0 then -1 else (p_partkey - 1) // 4 end up from part),
 a as (select k, k as top from n union all select a.k, n.up from a join n on n.k = a.top where n.up >= 0),
 o as (select l_partkey k, sum(l_quantity) w, sum(l_suppkey::double * l_quantity) x from lineitem where l_partkey % 3 = 0 or l_partkey > 40 group by 1),
 t as (select top k, sum(w) w, sum(x) x from a join o using (k) group by 1)
 select n.k p_partkey, case when coalesce(o.w, 0) >= 1e-6 then 'own' when coalesce(t.w, 0) >= 1e-6 then 'descendants' else 'problem' end source,
 round(case when coalesce(o.w, 0) >= 1e-6 then o.x / o.w else t.x / t.w end, 5) x from n left join o using (k) left join t using (k)""")
def subtree_centroid(t):
    """Parts as a tree of four children a node; the weights of two thirds of the upper parts are missing."""
    w = t.lineitem.where("l_partkey % 3 = 0 or l_partkey > 40").select("l_partkey", F.col("l_quantity").alias("w"), F.col("l_suppkey").cast("double").alias("x"))
    up = F.when(F.col("p_partkey") == 0, F.lit(-1).cast("long")).otherwise(F.floor((F.col("p_partkey") - 1) / 4))
    nodes = t.part.select("p_partkey", up.alias("up"))
    return spatial.weighted_centroids(w, "l_partkey", "w", ["x"], nodes, "p_partkey", "up").withColumn("x", F.round("x", 5))


@query("""with recursive n as (select p_partkey k, case when p_partkey = 0 then -1 else (p_partkey - 1) // 4 end up, p_name nm from part),
 w as (select k, nm path, 1 depth from n where up = -1 union all select n.k, w.path || '/' || n.nm, w.depth + 1 from n join w on n.up = w.k)
 select k p_partkey, path, depth from w""")
def tree_paths(t):
    up = F.when(F.col("p_partkey") == 0, F.lit(-1).cast("long")).otherwise(F.floor((F.col("p_partkey") - 1) / 4))
    paths, _ = spatial.tree_paths(t.part.select("p_partkey", up.alias("up"), "p_name"), "p_partkey", "up", "p_name")
    return paths


@query("""with c as (select radians(unnest([0, 45, 90, 135, 180, 225, 270, 315])) yaw), e as (select yaw, sqrt(3) / 2 / sin(radians(20)) * cos(radians(30)) * cos(yaw) ex, sqrt(3) / 2 / sin(radians(20)) * cos(radians(30)) * sin(yaw) ey, sqrt(3) / 2 / sin(radians(20)) * sin(radians(30)) ez from c),
 p as (select p_partkey, p_size / 50.0::double - 0.5 x, length(p_name) / 20.0::double - 0.5 y, length(p_brand) / 10.0::double - 0.5 z from part),
 f as (select *, sqrt(ex*ex + ey*ey + ez*ez) r, sqrt(ex*ex + ey*ey) h from p, e),
 g as (select *, ((-ey / r) * (x - ex) - (-ex / r) * (y - ey)) / (h / r) rt, ((-ex / r) * (x - ex) + (-ey / r) * (y - ey) + (-ez / r) * (z - ez)) dp from f),
 u as (select *, ((-ex / h) * (ez / r)) * (x - ex) + ((-ey / h) * (ez / r)) * (y - ey) + (h / r) * (z - ez) up from g),
 q as (select *, (1 / tan(radians(20)) * 480 / 640 * rt / dp * 0.5 + 0.5) * 640 px, (0.5 - 1 / tan(radians(20)) * up / dp * 0.5) * 480 py from u)
 select p_partkey, round(degrees(yaw))::int azimuth, round(px, 3) px, round(py, 3) py, round(dp, 5) depth, px >= 0 and px < 640 and py >= 0 and py < 480 and dp > 0 in_frame from q""")
def project_points(t):
    p = t.part.select("p_partkey", (F.col("p_size") / 50.0 - 0.5).alias("x"), (F.length("p_name") / 20.0 - 0.5).alias("y"), (F.length("p_brand") / 10.0 - 0.5).alias("z"))
    each = generate.with_rows(p, [(a,) for a in geometry.GRID_AZIMUTHS], "azimuth")
    eye = geometry.camera_eye(F.radians(F.col("azimuth").cast("double")), F.radians(F.lit(30.0)), geometry.camera_radius(40.0))
    right, up, depth = geometry.camera_frame((F.col("x"), F.col("y"), F.col("z")), eye)
    px, py, seen = geometry.project(right, up, depth, 40.0, 640, 480)
    return each.select("p_partkey", "azimuth", F.round(px, 3).alias("px"), F.round(py, 3).alias("py"), F.round(depth, 5).alias("depth"), seen.alias("in_frame"))


@query("""select s_suppkey, ((e - 1) * 24 + (d - 1) * 8 + a - 1)::int camera, (a - 1) * 45.0::double azimuth, ([-30, 0, 30, 60])[e]::double elevation, ([0.6, 1.0, 1.8])[d]::double distance,
 round(sqrt(3) / 2 / sin(radians(20)) * ([0.6, 1.0, 1.8])[d]::double, 6) radius, round(cos(radians((a - 1) * 45)) * cos(radians(([-30, 0, 30, 60])[e])) * sqrt(3) / 2 / sin(radians(20)) * ([0.6, 1.0, 1.8])[d]::double, 5) + 0 x,
 round(sin(radians((a - 1) * 45)) * cos(radians(([-30, 0, 30, 60])[e])) * sqrt(3) / 2 / sin(radians(20)) * ([0.6, 1.0, 1.8])[d]::double, 5) + 0 y, round(sin(radians(([-30, 0, 30, 60])[e])) * sqrt(3) / 2 / sin(radians(20)) * ([0.6, 1.0, 1.8])[d]::double, 5) + 0 z
 from supplier, unnest(range(1, 5)) x(e), unnest(range(1, 4)) y(d), unnest(range(1, 9)) z(a)""")
def camera_grid(t):
    g = generate.grid_cameras(t.supplier, "s_suppkey")
    return g.select("s_suppkey", "camera", "azimuth", "elevation", "distance", F.round("radius", 6).alias("radius"),
                    *[(F.round(c, 5) + 0.0).alias(c) for c in XYZ])


@query("""with s as (select s_suppkey, s_nationkey + 8 n from supplier), e as (select s_suppkey, n, i, i / n u0, list_sum(list_transform(range(0, 12), lambda b: ((i >> b) & 1) * power(0.5, b + 1))) v from s, unnest(range(0, n)) r(i)),
 w as (select *, v * 2 * pi() yaw, acos(1 - 2 * case when u0 < 0.25 then 2 * u0 else u0 * 2 / 3 + 1.0::double / 3 end) - pi() / 2 pitch from e)
 select s_suppkey, i::int view_index, round(degrees(yaw), 5) yaw, round(degrees(pitch), 5) pitch, round(cos(yaw) * cos(pitch) * sqrt(3) / 2 / sin(radians(20)), 5) + 0 x, round(sin(yaw) * cos(pitch) * sqrt(3) / 2 / sin(radians(20)), 5) + 0 y,
 round(sin(pitch) * sqrt(3) / 2 / sin(radians(20)), 5) + 0 z from w""")
def sphere_sequence(t):
    s = generate.sphere_cameras(t.supplier.select("s_suppkey", (F.col("s_nationkey") + 8).alias("n")), "s_suppkey", "n")
    return s.select("s_suppkey", "view_index", *[(F.round(c, 5) + 0.0).alias(c) for c in ("yaw", "pitch", *XYZ)])


ORDERS = ("yxz", "zxy", "xyz")
STEPS = {
    "x": "x, cos(rx) * y - sin(rx) * z y, sin(rx) * y + cos(rx) * z z", "y": "cos(ry) * x + sin(ry) * z x, y, cos(ry) * z - sin(ry) * x z",
    "z": "cos(rz) * x - sin(rz) * y x, sin(rz) * x + cos(rz) * y y, z",
}


def turned_sql(order: str) -> str:
    """The rows of ``p`` that declare ``order``, turned about its last axis first."""
    sql = f"select * from p where o = '{order}'"
    for axis in reversed(order):
        sql = f"select l_orderkey, l_partkey, l_linenumber, rx, ry, rz, {STEPS[axis]} from ({sql})"
    return sql


@query(f"""with p as (select l_orderkey, l_partkey, l_linenumber, list_extract(['yxz', 'zxy', 'xyz'], (l_linenumber % 3)::int + 1) o, l_quantity / 100 x, -(l_tax * 100) / 100 y, l_discount * 100 / 100 z,
  radians(l_quantity / 2) rx, radians(l_quantity) ry, radians(l_linenumber * 10.0::double) rz from lineitem)
 select l_orderkey, l_partkey, l_linenumber, round(x, 6) + 0 x, round(y, 6) + 0 y, round(z, 6) + 0 z from ({' union all '.join(map(turned_sql, ORDERS))})""")
def axis_convert(t):
    moved = geometry.y_up_cm_to_z_up_m(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100)
    angles = (F.col("l_quantity") / 2, F.col("l_quantity"), F.col("l_linenumber") * 10.0)
    order = F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("l_linenumber") % 3 + 1).cast("int"))
    turned = geometry.rotate_by(moved, angles, order)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", *[(F.round(c, 6) + 0.0).alias(n) for c, n in zip(turned, XYZ)])
