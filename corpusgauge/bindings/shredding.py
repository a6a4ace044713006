"""Shredding, reshaping and nesting over the given tables."""

from pyspark.sql import functions as F

from corpusgauge.bindings.registry import query
from corpusgauge.operators import shred

MEASURES = ["l_quantity", "l_discount", "l_tax"]
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("""with l as (select o_custkey c, l_returnflag f, l_linenumber % 2 = 1 boxed, l_quantity::int q, floor(l_extendedprice / 4)::int a from lineitem join orders on o_orderkey = l_orderkey),
 i as (select o_custkey c, count(*) n_images from orders group by 1)
 select i.c::varchar split, n_images, count(f) n_annotations, coalesce(sum(a), 0)::double area, count(*) filter (where f = 'R') crowds, count(*) filter (where boxed) boxes,
 coalesce(sum(q) filter (where boxed), 0)::double box_x, 2 * count(*) filter (where f <> 'N') polygons, 6 * count(*) filter (where f <> 'N') points, 2 * count(f) keypoints
 from i left join l on i.c = l.c group by 1, 2""")
def shred_json(t):
    """Each customer's orders and lines are written out as one annotation file and shredded."""
    from corpusgauge.schemas import ANNOTATION_DDL, struct
    from corpusgauge.session import cut, dealt

    q = F.col("l_quantity").cast("int")
    lines = t.lineitem.select("l_orderkey", F.struct(
        F.col("l_orderkey").alias("id"), F.col("l_orderkey").alias("image_id"), F.col("l_suppkey").alias("category_id"),
        (F.col("l_extendedprice") / 4).cast("int").alias("area"), F.when(F.col("l_returnflag") == "R", 1).alias("iscrowd"),
        F.when(F.col("l_linenumber") % 2 == 1, F.array(q, q, q, q)).otherwise(F.array(q, q)).alias("bbox"),
        F.array(q, q, F.lit(2), q, q, F.lit(1), q).alias("keypoints"),
        F.when(F.col("l_returnflag") == "N", '{"counts": [3]}').otherwise("[[1.5, 2, 3, 4], [], [7, 8]]").alias("segmentation"),
    ).alias("a"))
    n = t.lineitem.count()
    of_order = dealt(lines, n, "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("a").alias("notes"))
    orders = t.orders.select("o_custkey", "o_orderkey", F.struct(F.col("o_orderkey").alias("id"), F.lit("f").alias("file_name")).alias("image"))
    docs = dealt(orders.join(of_order, "o_orderkey", "left"), n, "o_custkey").groupBy("o_custkey").agg(
        F.collect_list("image").alias("images"), F.flatten(F.collect_list("notes")).alias("annotations"))
    text = F.to_json(F.struct("images", "annotations"))
    read = docs.select(F.col("o_custkey").cast("string").alias("split"), F.from_json(text, struct(ANNOTATION_DDL)).alias("d"))
    flat = shred.annotation_document(cut(read.select("split", "d.*"), "documents"))  # parsed once
    owner = flat["annotations"].select("ann_id", "split").distinct()
    images = flat["images"].groupBy("split").agg(F.count(F.lit(1)).alias("n_images"))
    notes = flat["annotations"].groupBy("split").agg(F.count(F.lit(1)).alias("n_annotations"), F.sum("area").alias("area"), F.sum("iscrowd").alias("crowds"))
    # what hangs on an annotation is counted for it before its split is looked up, so all kinds share one join
    none = F.lit(0)
    mark = lambda name, x, points: flat[name].select("ann_id", F.lit(name).alias("kind"), x.alias("x"), points.alias("points"))
    marks = mark("boxes", F.col("x"), none).union(mark("polygons", none, F.size("points"))).union(mark("keypoints", none, none))
    found = lambda name: F.count_if(F.col("kind") == name).alias(name)
    each = marks.groupBy("ann_id").agg(found("boxes"), F.sum("x").alias("box_x"), found("polygons"), F.sum("points").alias("points"), found("keypoints"))
    sums = ["boxes", "box_x", "polygons", "points", "keypoints"]
    hung = each.join(owner, "ann_id").groupBy("split").agg(*[F.sum(c).alias(c) for c in sums])
    wide = images.join(notes, "split", "left").join(hung, "split", "left")
    return wide.fillna(0)


LICENSES = [("CC Attribution", False), ("CC0 Public Domain", False), ("CC Attribution-ShareAlike", True)]


@query("""with lic as (select * from (values (0, 'CC Attribution', 1), (1, 'CC Attribution-ShareAlike', 3), (2, 'CC0 Public Domain', 2)) v(license_id, name, k)),
 f as (select l_partkey k, l_orderkey o, l_linenumber n, case l_linenumber % 3 when 0 then 2048 when 1 then 1024 else 0 end r, 'm/' || l_partkey || '/' || l_orderkey || case l_linenumber % 3 when 0 then '_2048' when 1 then '_1024' else '' end || '.glb' p from lineitem),
 b as (select k, count(*) n_files, first(p order by r desc, o, n) best_path, max(r) best_resolution from f group by 1)
 select p_partkey::varchar model_id, p_name || ' "{' || p_brand || '}," \\' as name, license_id::int license_id, p_size::bigint vertex_count, p_partkey % 2 = 0 is_rigged, coalesce(n_files, 0) n_files, best_path, best_resolution::int best_resolution,
  len(string_split(p_type, ' '))::bigint n_categories, case when p_size % 5 = 0 then 0 else 2 end::bigint n_tags
 from part join lic on k = p_partkey % 4 left join b on b.k = p_partkey where p_size > 3""")
def shred_map(t):
    """Parts, with their lines as files, are written as JSON maps, read back by byte ranges and catalogued."""
    from corpusgauge.plans import model_catalogue
    from corpusgauge.session import dealt, scratch
    from corpusgauge.sources.jsonmap import write_json_map

    side = F.when(F.col("l_linenumber") % 3 == 0, "_2048").when(F.col("l_linenumber") % 3 == 1, "_1024").otherwise("")
    path = F.concat(F.lit("m/"), "l_partkey", F.lit("/"), "l_orderkey", side, F.lit(".glb"))
    lines = dealt(t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber"), t.lineitem.count(), "l_partkey")
    files = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", path.alias("path")))).alias("f"))
    licence = F.element_at(F.array(F.lit("Editorial"), F.lit(LICENSES[0][0]), F.lit(LICENSES[1][0]), F.lit(LICENSES[2][0])), (F.col("p_partkey") % 4 + 1).cast("int"))
    record = F.to_json(F.struct(
        F.concat("p_name", F.lit(' "{'), "p_brand", F.lit('}," \\')).alias("name"), F.col("p_brand").alias("user"), licence.alias("license"),
        F.col("p_size").alias("vertexCount"), (F.col("p_partkey") % 2 == 0).alias("isRigged"), F.transform("f", lambda x: x["path"]).alias("glb_paths"),
        F.split("p_type", " ").alias("categories"), F.when(F.col("p_size") % 5 != 0, F.array("p_brand", "p_type")).alias("tags")))
    spark, place = t.spark, scratch(t.spark, "model-map")
    write_json_map(t.part.join(files, "p_partkey", "left").withColumn("record", record), "p_partkey", "record", place)
    listed = scratch(spark, "model-ids")
    t.part.where("p_size > 3").select(F.col("p_partkey").cast("string")).write.text(listed)
    found = model_catalogue.read_catalogue(spark, place, LICENSES, ids_path=listed)
    n = lambda name, column: found[name].groupBy("model_id").agg(F.count(F.lit(1)).alias(column))
    best = found["best"].select("model_id", F.col("path").alias("best_path"), F.col("resolution").alias("best_resolution"))
    wide = found["models"].select("model_id", "name", "license_id", "vertex_count", "is_rigged").join(n("files", "n_files"), "model_id", "left")
    wide = wide.join(best, "model_id", "left").join(n("categories", "n_categories"), "model_id", "left").join(n("tags", "n_tags"), "model_id", "left")
    return wide.fillna(0, ["n_files", "n_categories", "n_tags"])


@query("""with k as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, max(l_quantity) l_quantity, max(l_discount) l_discount, max(l_tax) l_tax from lineitem group by 1, 2, 3, 4)
 select l_orderkey, l_partkey, l_suppkey, l_linenumber, name metric_name, v metric_value from k, unnest([{'name': 'l_quantity', 'v': l_quantity}, {'name': 'l_discount', 'v': l_discount}, {'name': 'l_tax', 'v': l_tax}]) u(s), lateral (select s.name, s.v)""")
def melt_scores(t):
    unique = t.lineitem.groupBy(*LINE).agg(*[F.max(m).alias(m) for m in MEASURES])
    return shred.melt(unique, LINE, MEASURES)


@query("""select l_orderkey, l_partkey, l_suppkey, l_linenumber, max(l_quantity) l_quantity, coalesce(max(l_discount) filter (where l_discount > 0), 0) l_discount, max(l_tax) l_tax
 from lineitem group by 1, 2, 3, 4""")
def pivot_long(t):
    long = shred.melt(t.lineitem, LINE, MEASURES)
    sparse = long.where("metric_name <> 'l_discount' or metric_value > 0")
    return shred.with_default(shred.pivot(sparse, LINE, "metric_name", "metric_value", MEASURES), ["l_discount"])


@query("""with s as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity from lineitem),
 c as (select l_orderkey, l_linenumber, string_agg(l_partkey::varchar || ':' || l_quantity::int, ',' order by l_partkey, l_suppkey, l_extendedprice, l_quantity) scores from s group by 1, 2)
 select o_orderkey l_orderkey, l_linenumber, coalesce(scores, '') scores from orders left join c on o_orderkey = l_orderkey""")
def nest_candidates(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    nested = shred.nest(lines, "l_orderkey", ["l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"], ["l_partkey", "l_quantity"])
    roots = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    full = shred.with_empty_roots(roots, nested, "l_orderkey")
    score = lambda s: F.concat(s["l_partkey"], F.lit(":"), s["l_quantity"].cast("int"))
    return full.select("l_orderkey", "l_linenumber", F.array_join(F.transform("scores", score), ",").alias("scores"))


@query("""select stub, rank, count(*) n from (select 'first' stub, l_linenumber rank from lineitem where l_linestatus = 'O' union all
 select 'second', l_linenumber from lineitem where l_linestatus = 'F') group by all""")
def union_stubs(t):
    part = lambda s: t.lineitem.where(F.col("l_linestatus") == s).select(F.col("l_linenumber").alias("rank"))
    both = shred.concatenate({"first": part("O"), "second": part("F")})
    return both.groupBy("stub", "rank").agg(F.count(F.lit(1)).alias("n"))


@query("""with w as (select doc_id, string_split(text, ' ') v from documents)
 select doc_id, (i - 1)::int idx, v[3 * i - 2] x, v[3 * i - 1] y, v[3 * i] v from w, unnest(range(1, len(v) // 3 + 1)) u(i)""")
def shred_arrays(t):
    words = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    return shred.triples(words, ["doc_id"], "words")


@query("""select tag, count(*) n, count(distinct page_id) pages from (select page_id, unnest(string_split(lower(regexp_replace(url, '[^A-Za-z0-9]+', '/', 'g')), '/')) tag from pages) where tag <> '' group by 1""")
def explode_tags(t):
    parts = F.split(F.lower(F.regexp_replace("url", "[^A-Za-z0-9]+", "/")), "/")
    each = shred.tags(t.pages, ["page_id"], F.filter(parts, lambda p: p != ""))
    per_page = each.groupBy("tag", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return per_page.groupBy("tag").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))
