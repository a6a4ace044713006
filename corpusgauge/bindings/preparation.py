"""Filters, projections, gates, sharding and reference checks over the given tables."""

from pyspark.sql import functions as F

from corpusgauge.bindings.audits import BAD_ORDERS, bad_orders, bent
from corpusgauge.bindings.registry import query
from corpusgauge.functions import text as tx
from corpusgauge.operators import prepare, resolve

ALLOWED = ("src0", "src2", "src3", "src5", "src7", "src11")
IN = "('src0', 'src2', 'src3', 'src5', 'src7', 'src11')"


def n_rows():
    return F.count(F.lit(1)).alias("n")


@query(f"select doc_id, source, lang, source in ('src2', 'src3') share_alike from documents where source in {IN}")
def license_filter(t):
    share = [(s, s in ("src2", "src3")) for s in ALLOWED]
    licences = prepare.literal_rows(t.spark, share, "source share_alike")
    kept = t.documents.select("doc_id", "source", "lang").join(F.broadcast(licences), "source")
    return kept.select("doc_id", "source", "lang", "share_alike")


@query(f"""select coalesce(nullif(source, 'src1'), '') as value, count(*) n,
 case when source in {IN} then 'KEEP' else 'drop' end mark from documents group by all""")
def license_hist(t):
    d = t.documents.withColumn("source", F.nullif("source", F.lit("src1")))
    return prepare.histogram(d, "source", ALLOWED).orderBy(F.desc("n"), "value")


@query("""select o_orderkey, o_custkey, c.n n_children, c.b best from orders
 join (select l_orderkey k, count(*) n, max(coalesce(l_quantity, 0)) b from lineitem group by 1) c on k = o_orderkey
 where b >= 40""")
def keep_by_child_max(t):
    kept = prepare.keep_by_child(t.orders, "o_orderkey", t.lineitem, "l_orderkey", "l_quantity", 40)
    return kept.select("o_orderkey", "o_custkey", "n_children", "best")


@query(f"""with {BAD_ORDERS}, h as (select c_custkey from customer where c_acctbal < 0),
 d as (select case when o_totalprice is null or o_orderpriority is null then 'null'
   when o_custkey in (select c_custkey from h) then 'holdout' when o_orderstatus = 'P' then 'share_alike' else 'keep' end disposition
   from bad_orders)
 select disposition, count(*) n, (select count(*) from d) = (select count(*) from bad_orders) as closed from d group by 1""")
def disposition(t):
    o = bad_orders(t)
    held = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    held = held.distinct().withColumn("_held", F.lit(True))
    marked = o.join(held, "o_custkey", "left").select(prepare.first_match([
        ("null", F.col("o_totalprice").isNull() | F.col("o_orderpriority").isNull()),
        ("holdout", F.col("_held")),
        ("share_alike", F.col("o_orderstatus") == "P"),
    ], "keep").alias("disposition"))
    counted = marked.groupBy("disposition").agg(n_rows())
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("closed", total == o.agg(n_rows()).scalar())


@query("""select p_partkey, p_name, p_size from part where p_size >= 25
 and p_partkey in (select l_partkey from lineitem where l_returnflag = 'R') order by p_partkey limit 50""")
def allowlist_topn(t):
    allowed = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct()
    kept = t.part.where("p_size >= 25").join(allowed, "p_partkey", "left_semi")
    return kept.orderBy("p_partkey").limit(50).select("p_partkey", "p_name", "p_size")


@query("""select doc_id, case when source = 'src0' then 'the source itself' when quality is null then 'no sidecar'
 when quality = 0 then 'empty phrase' when lang <> 'en' then 'missing controls' end skip_reason
 from documents left join labels using (doc_id)""")
def skip_reasons(t):
    d = t.documents.select("doc_id", "source", "lang").join(t.labels, "doc_id", "left")
    reason = prepare.first_match([
        ("the source itself", F.col("source") == "src0"),
        ("no sidecar", F.col("quality").isNull()),
        ("empty phrase", F.col("quality") == 0),
        ("missing controls", F.col("lang") != "en"),
    ])
    return d.select("doc_id", reason.alias("skip_reason"))


@query("""select doc_id, coalesce(nullif(trim(a), ''), nullif(trim(b), ''), nullif(trim(source), '')) phrase
 from (select doc_id, source, case when doc_id % 3 = 0 then '  ' else ' ' || lang || ' ' end a,
  case when doc_id % 6 = 0 then null else n_chars::varchar end b from documents)""")
def first_nonblank(t):
    d = t.documents.select(
        "doc_id", "source",
        F.when(F.pmod("doc_id", F.lit(3)) == 0, "  ").otherwise(F.concat(F.lit(" "), "lang", F.lit(" "))).alias("a"),
        F.when(F.pmod("doc_id", F.lit(6)) != 0, F.col("n_chars").cast("string")).alias("b"),
    )
    return d.select("doc_id", tx.first_nonblank(F.col("a"), F.col("b"), F.col("source")).alias("phrase"))


@query("""select page_id, case when starts_with(h, '<!DOCTYPE') then 'ok' else 'not the declared type' end state
 from (select page_id, case when page_id % 17 = 0 then 'GIF89a' || html else html end h from pages)""")
def magic_bytes(t):
    p = bent(t.pages, "html", "page_id", 17, F.concat(F.lit("GIF89a"), "html"))
    ok = F.startswith(F.encode("html", "UTF-8"), F.lit(b"<!DOCTYPE"))
    return p.select("page_id", F.when(ok, "ok").otherwise("not the declared type").alias("state"))


STAGED = """staged as (select page_id, case page_id % 7 when 0 then url || '/VAL2017/a.png' when 1 then url || '/run-NF4/b.bin'
 when 2 then 'C:\\data\\c' || page_id || '.png' when 3 then '/home/me/d' || page_id || '.png' when 4 then 'renders/e' || page_id || '.png'
 when 5 then 'renders/f' || page_id || '.safetensors' else 'cards/g.json' end path, octet_length(encode(html)) size from pages)"""


def staged(t):
    k, pid = F.pmod("page_id", F.lit(7)), F.col("page_id").cast("string")
    path = (
        F.when(k == 0, F.concat("url", F.lit("/VAL2017/a.png")))
        .when(k == 1, F.concat("url", F.lit("/run-NF4/b.bin")))
        .when(k == 2, F.concat(F.lit("C:\\data\\c"), pid, F.lit(".png")))
        .when(k == 3, F.concat(F.lit("/home/me/d"), pid, F.lit(".png")))
        .when(k == 4, F.concat(F.lit("renders/e"), pid, F.lit(".png")))
        .when(k == 5, F.concat(F.lit("renders/f"), pid, F.lit(".safetensors")))
        .otherwise("cards/g.json")
    )
    return t.pages.select("page_id", path.alias("path"), F.octet_length("html").alias("size"))


@query(f"""with {STAGED}, m(marker) as (values ('val2017'), ('coco-ood'), ('rf-detr-keypoint-data'), ('nf4'), ('int4'), ('int8'))
 select page_id, min(marker) marker from staged, m where contains(lower(path), marker) group by 1""")
def forbidden_markers(t):
    s = staged(t).withColumn("marker", tx.has_marker(F.col("path")))
    return s.where("marker is not null").select("page_id", "marker")


@query(f"with {STAGED} select page_id, regexp_matches(path, '^/|^\\\\|:|/users/|/home/', 'i') absolute from staged")
def absolute_paths(t):
    return staged(t).select("page_id", tx.is_absolute(F.col("path")).alias("absolute"))


@query(f"""with {STAGED} select case when ends_with(lower(path), '.png') then 'image' when ends_with(lower(path), '.safetensors')
 then 'weights' when ends_with(lower(path), '.json') then 'record' else 'other' end class, count(*) n, sum(size)::bigint bytes from staged group by 1""")
def file_classes(t):
    ends = lambda s: F.endswith(F.lower("path"), F.lit(s))
    kind = prepare.first_match(
        [("image", ends(".png")), ("weights", ends(".safetensors")), ("record", ends(".json"))], "other"
    )
    return staged(t).groupBy(kind.alias("class")).agg(n_rows(), F.sum("size").alias("bytes"))


@query("""select p_partkey, case when contains(lower(p_name), 'ring') then 'jewellery' when contains(lower(p_name), 'bolt') then 'fastener'
 when contains(lower(p_name), 'red') then 'colour' end category from part""")
def rule_lookup(t):
    rules = [("ring", "jewellery"), ("bolt", "fastener"), ("red", "colour")]
    return t.part.select("p_partkey", prepare.category_by_substring(F.col("p_name"), rules).alias("category"))


@query("""with l as (select doc_id, source, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) line_no from documents)
 select doc_id, line_no from l where regexp_matches(line, ' (la|is|der) ') and not starts_with(ltrim(line), '#')
 and not regexp_matches(line, 'MIT|Apache') and source not in ('src4', 'src9')""")
def line_lint(t):
    scanned = t.documents.where(~F.col("source").isin("src4", "src9"))
    return prepare.line_findings(scanned, "doc_id", "text", " (la|is|der) ", "MIT|Apache")


@query("""select doc_id, count(*) n from (select doc_id, trim(split_part(unnest(string_split(text, chr(10))), '#', 1)) line from documents)
 where line <> '' group by 1""")
def lines_config(t):
    return prepare.config_lines(t.documents, ["doc_id"], "text").groupBy("doc_id").agg(n_rows())


@query(f"""with {BAD_ORDERS}, w as (select o_orderkey, o_totalprice::varchar is not null p, o_totalprice, o_orderpriority,
  case when o_orderkey % 4 = 0 then o_orderstatus end s from bad_orders)
 select o_orderkey, case when s is not null then s when o_orderpriority is not null then o_orderpriority else 'customer' end "value",
  case when s is not null then 'status' when o_orderpriority is not null then 'priority' else 'customer' end witness,
  concat_ws(',', case when s is null then 'status' end, case when o_orderpriority is null then 'priority' end) absent from w""")
def fallback_named(t):
    o = bad_orders(t)
    status = F.when(F.pmod("o_orderkey", F.lit(4)) == 0, F.col("o_orderstatus"))
    value, name, absent = tx.first_named(
        {"status": status, "priority": F.col("o_orderpriority"), "customer": F.lit("customer")}
    )
    return o.select("o_orderkey", value.alias("value"), name.alias("witness"), F.array_join(absent, ",").alias("absent"))


@query("""select 'order/' || l_orderkey row_key, 'edit' candidate_axis, l_linenumber::int "rank", 'part/' || l_partkey candidate_asset,
 'png' candidate_asset_kind, lower(l_returnflag) candidate_kind from lineitem""")
def schema_port(t):
    return t.lineitem.select(
        F.concat(F.lit("order/"), "l_orderkey").alias("row_key"), F.lit("edit").alias("candidate_axis"),
        F.col("l_linenumber").cast("int").alias("rank"), F.concat(F.lit("part/"), "l_partkey").alias("candidate_asset"),
        F.lit("png").alias("candidate_asset_kind"), F.lower("l_returnflag").alias("candidate_kind"),
    )


@query(f"""with {STAGED} select page_id, 'renders/' || regexp_extract(path, '([^/\\\\]*)$', 1) || ';' || 'renders/z.png' paths from staged""")
def rewrite_paths(t):
    both = staged(t).withColumn("paths", F.array("path", F.lit("a/b\\z.png")))
    moved = F.transform("paths", lambda p: resolve.served_path(p))
    return both.select("page_id", F.array_join(moved, ";").alias("paths"))


@query(r"""select doc_id, md5(regexp_replace(text || ' not found in C:\Users\me\d' || doc_id || '.png or /Users/me/x.txt at all',
 '(?i)(?:[A-Za-z]:[\\/]|/c/Users/|/Users/)(?:[^\s"''/\\]*[/\\])*([^\s"''/\\]*)', '\1', 'g')) digest from documents""")
def scrub_strings(t):
    noted = F.concat("text", F.lit(" not found in C:\\Users\\me\\d"), "doc_id", F.lit(".png or /Users/me/x.txt at all"))
    boxed = t.documents.select("doc_id", F.struct(F.array(noted).alias("notes")).alias("record"))
    clean = tx.scrub_column(F.col("record"), boxed.schema["record"].dataType)
    return boxed.select("doc_id", F.md5(clean.getField("notes")[0]).alias("digest"))


@query("""select p_partkey, regexp_replace(regexp_replace(trim(replace('<sks> ' || p_name || ' view ' || lower(p_type) || '-level shot wide', '<sks>', '')), '[ \\t\\r\\n]+', '-', 'g'),
 '(^|-)(view|shot)-', '\\1\\2_', 'g') slug,
 regexp_replace(regexp_replace(lower(p_name || ': ' || p_brand || '!'), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') stem from part""")
def slug(t):
    prompt = F.concat(F.lit("<sks> "), "p_name", F.lit(" view "), F.lower("p_type"), F.lit("-level shot wide"))
    title = F.concat("p_name", F.lit(": "), "p_brand", F.lit("!"))
    return t.part.select("p_partkey", tx.phrase_slug(prompt, "<sks>").alias("slug"), tx.file_stem(title).alias("stem"))


@query("""select p_partkey, regexp_replace(lower(p_brand || '_' || p_name), '[^\\p{L}\\p{N}]', '', 'g') plain from part""")
def name_norm(t):
    return t.part.select("p_partkey", tx.plain_name(F.concat("p_brand", F.lit("_"), "p_name")).alias("plain"))


@query("""with a as (select distinct p_name n from part), b as (select distinct replace(replace(upper(p_name), ' ', '_'), 'RING', 'HOOP') n from part),
 ka as (select regexp_replace(lower(n), '[^a-z0-9]', '', 'g') k, min(n) n from a group by 1), kb as (select regexp_replace(lower(n), '[^a-z0-9]', '', 'g') k, min(n) n from b group by 1)
 select case when kb.k is null then 'only_left' else 'only_right' end side, coalesce(ka.n, kb.n) as name from ka full join kb using (k) where ka.k is null or kb.k is null""")
def vocab_diff(t):
    other = F.replace(F.replace(F.upper("p_name"), F.lit(" "), F.lit("_")), F.lit("RING"), F.lit("HOOP"))
    return resolve.name_difference(t.part, "p_name", t.part.select(other.alias("n")), "n")


@query(f"""with {BAD_ORDERS} select o_orderkey, case when o_orderpriority is null then 'kept=' || o_orderstatus || ';rank=error' else
 'kept=' || o_orderstatus || ';rank=' || o_orderpriority end entries from bad_orders""")
def map_upsert(t):
    old = F.create_map(F.lit("rank"), F.lit("stale"), F.lit("kept"), F.col("o_orderstatus"))
    new = prepare.upsert_entry(old, F.lit("rank"), F.coalesce("o_orderpriority", F.lit("error")))
    pairs = F.array_sort(F.transform(F.map_entries(new), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return bad_orders(t).select("o_orderkey", F.array_join(pairs, ";").alias("entries"))


@query("""with r as (select o_orderkey, o_custkey, 'rev' || (o_orderkey % 11)::varchar rev, 'no ' || lower(o_orderstatus) neg, (o_orderkey % 3)::int + 1 n, lower(o_orderpriority) p from orders where o_orderkey % 13 <> 5),
 x as (select *, i, case when i % 2 = 1 then 'restyle as ' else 'recolour as ' end || p prompt from r, unnest(range(1, n + 1)) u(i)),
 p as (select text, (row_number() over (order by text) - 1)::int id from (select prompt text from x union select neg from x))
 select o_orderkey, 'edit_' || i "name", (dense_rank() over (order by o_orderkey, x.prompt) - 1)::int edit_run_id, a.id prompt_id, b.id negative_prompt_id, rev revision,
 (o_orderkey % 5 + 20)::int steps, o_orderkey * 10 + i seed, o_custkey render_id from x join p a on a.text = x.prompt join p b on b.text = x.neg""")
def run_to_relations(t):
    from corpusgauge.operators.shred import run_relations

    n = (F.pmod("o_orderkey", F.lit(3)) + 1).cast("int")
    numbers = F.sequence(F.lit(1), n)
    file_of = lambda i: F.concat(F.col("o_orderkey").cast("string"), F.lit("_"), i.cast("string"), F.lit(".png"))
    output = lambda i: F.struct(
        file_of(i).alias("file"), (F.col("o_orderkey") * 10 + i).alias("seed"),
        F.concat(F.when(i % 2 == 1, "restyle as ").otherwise("recolour as "), F.lower("o_orderpriority")).alias("prompt"))
    revision = F.when(F.pmod("o_orderkey", F.lit(13)) != 5, F.concat(F.lit("rev"), F.pmod("o_orderkey", F.lit(11))))
    record = F.to_json(F.struct(
        F.struct(F.lit("base").alias("repo_id"), revision.alias("revision")).alias("edit_models"),
        F.struct(
            F.lit("bf16").alias("precision"), (F.pmod("o_orderkey", F.lit(5)) + 20).alias("steps"), F.lit(4.5).alias("text_guidance_scale"),
            F.concat(F.lit("no "), F.lower("o_orderstatus")).alias("negative_prompt"),
        ).alias("edit_runs"),
        F.map_from_arrays(F.transform(numbers, lambda i: F.concat(F.lit("edit_"), i.cast("string"))), F.transform(numbers, output)).alias("outputs"),
    ))
    images = t.orders.select(F.col("o_custkey").alias("render_id"), F.inline(F.transform(numbers, lambda i: F.struct(
        file_of(i).alias("file"), F.encode(file_of(i), "UTF-8").alias("image")))))
    made = run_relations(t.orders.select(F.col("o_orderkey").alias("run_key"), record.alias("record")), "run_key", "record", images)
    runs = made["edit_runs"].join(made["edit_models"].hint("merge"), "edit_model_id")
    return (
        made["run_outputs"].join(made["edited_renders"].hint("merge"), ["edit_id", "edit_run_id"]).join(runs.hint("merge"), "edit_run_id")
        .select(F.col("run_key").alias("o_orderkey"), "name", "edit_run_id", "prompt_id", "negative_prompt_id", "revision",
                F.col("steps").cast("int").alias("steps"), "seed", "render_id")
    )


@query("""with h as (select doc_id from labels where toxic = 1) select count(*) n_in, count(*) filter (where doc_id in (select doc_id from h)) leaked_before,
 count(*) filter (where doc_id not in (select doc_id from h)) n_kept, 0 leaked_after from documents""")
def holdout_gate(t):
    return prepare.holdout_gate(t.documents.select("doc_id"), "doc_id", t.labels.where("toxic = 1"), "doc_id").report


@query("""select c_custkey, case when (row_number() over (order by c_mktsegment, c_custkey) - 1) % 8 = 0 then 'val' else 'train' end split from customer""")
def stride_split(t):
    return prepare.stride_split(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment", "c_custkey"], 0.12).select("c_custkey", "split")


@query("""select event_id, user_id from (select *, row_number() over (partition by user_id order by ts, event_id) - 1 i from events) where i % 4 = 0""")
def stride_sample(t):
    return prepare.stride_sample(t.events.select("event_id", "ts", "user_id"), ["ts", "event_id"], 4, ["user_id"]).select("event_id", "user_id")


@query("select c_custkey from (select c_custkey from customer order by sha256('seed7' || c_custkey::varchar), c_custkey limit 100)")
def hash_sample(t):
    return prepare.hash_sample(t.customer.select("c_custkey"), "c_custkey", 100, "seed7")


@query("""select floor((upto - b) / 65536)::bigint shard, count(*) n, sum(b)::bigint bytes from (
 select octet_length(encode(text)) b, sum(octet_length(encode(text))) over (order by doc_id) upto from documents) group by 1""")
def shard_by_bytes(t):
    packed = prepare.shard_by_bytes(t.documents.select("doc_id", "text"), ["doc_id"], F.col("text"), 65536)
    return packed.groupBy("shard").agg(n_rows(), F.sum("_bytes").alias("bytes"))


DIRS = """d as (select page_id, regexp_replace(split_part(split_part(regexp_replace(url, '^[a-z]+://', ''), '?', 1), '#', 1), '/[^/]*$', '') dir from pages)"""


def page_dirs(t):
    bare = F.regexp_replace("url", "^[a-z]+://", "")
    path = F.substring_index(F.substring_index(bare, "?", 1), "#", 1)
    return t.pages.select("page_id", F.regexp_replace(path, "/[^/]*$", "").alias("dir"))


@query(f"""with {DIRS}, m as (select distinct dir a from d where ends_with(dir, '/en') or ends_with(dir, '/es') union select distinct split_part(dir, '/', 1) from d where contains(dir, 'blog')),
 up as (select distinct dir, array_to_string(string_split(dir, '/')[1:i], '/') a, i from (select distinct dir from d), unnest(range(1, 1 + len(string_split(dir, '/')))) u(i)),
 o as (select dir, max_by(a, i) owner from up where a in (select a from m) group by 1)
 select page_id, d.dir, coalesce(owner, d.dir) owner from d left join o using (dir)""")
def nearest_ancestor(t):
    d = page_dirs(t)
    ends = F.endswith("dir", F.lit("/en")) | F.endswith("dir", F.lit("/es"))
    hosts = d.where(F.contains("dir", F.lit("blog"))).select(F.substring_index("dir", "/", 1).alias("m"))
    markers = d.where(ends).select(F.col("dir").alias("m")).union(hosts)
    return prepare.nearest_owner(d, "dir", markers, "m").select("page_id", "dir", "owner")


@query("""with c as (select event_type, count(*) n from events group by 1),
 s as (select event_type as name, n + case event_type when 'click' then 4 else 0 end stated, case when event_type in ('click', 'view') then 5.0 end tol from c
   union all select 'gone_' || event_type, n * 1.04, null from c union all select 'lost_' || event_type, n, null from c union all select 'hole_' || event_type, n, null from c)
 select name, stated::double stated, round(coalesce(tol, greatest(abs(stated) * 0.05, 0.01))::double, 6) tol,
  case when starts_with(name, 'gone_') then case when contains(name, 'error') then 'DRIFTED' else 'CACHED' end when starts_with(name, 'lost_') then 'ERROR' when starts_with(name, 'hole_') then 'UNVERIFIED' else 'ok' end state,
  name = 'view' superseded from s""")
def claim_check(t):
    c = t.events.groupBy("event_type").agg(n_rows())
    name = lambda p: F.concat(F.lit(p), "event_type").alias("name")
    n = F.col("n")
    tag = lambda nm, v, tol: F.concat(F.lit("... <!--claim:"), nm, F.lit("="), v, tol, F.lit("--> of them"))
    off = F.when(F.col("event_type") == "click", n + 4).otherwise(n)
    tol = F.when(F.col("event_type").isin("click", "view"), F.lit(" tol=5.0")).otherwise("")
    page = c.select(F.concat_ws("\n", tag(name(""), off, tol), tag(name("gone_"), F.round(n * 1.04, 2), F.lit("")),
                                tag(name("lost_"), n, F.lit("")), tag(name("hole_"), n, F.lit(""))).alias("text"))
    measured = c.select(name(""), n.cast("double").alias("value"), F.lit(True).alias("reachable"))
    for prefix in ("gone_", "lost_"):
        measured = measured.union(c.select(name(prefix), F.lit(None).cast("double"), F.lit(False)))
    cache = c.select(name("gone_"), (n * F.when(F.col("event_type") == "error", 2.0).otherwise(1.0)).alias("cached"))
    cache = cache.union(c.where("event_type = 'view'").select(name(""), F.lit(1.0)))
    out = resolve.check_claims(resolve.claims(page, "text"), measured, cache)
    return out.withColumn("tol", F.round("tol", 6))


@query(f"""with {STAGED}, r as (select path p from staged union all select case when page_id % 7 = 3 then 'shared/home/e' else 'renders/e' end || page_id || '.png' from staged union all select 'out/' || page_id || '.png' from staged where page_id % 5 <> 0
  union all select 'renders/f' || page_id || '.safetensors' from staged where page_id % 5 = 0),
 s as (select distinct path p from staged)
 select p path, count(*) n, case when p like '/%' or p like '%:%' then 'absolute' when p in (select p from s) then 'served' else 'missing' end state from r group by 1""")
def resolve_refs(t):
    s, pid = staged(t), F.col("page_id").cast("string")
    five = F.pmod("page_id", F.lit(5)) == 0
    out = F.when(five, F.concat(F.lit("renders/f"), pid, F.lit(".safetensors"))).otherwise(F.concat(F.lit("out/"), pid, F.lit(".png")))
    folder = F.when(F.pmod("page_id", F.lit(7)) == 3, "shared/home/e").otherwise("renders/e")  # a home folder's name inside a relative path
    records = s.select(F.array("path", F.concat(folder, pid, F.lit(".png"))).alias("inputs"), out.alias("output"))
    return resolve.resolve_references(resolve.references(records, "inputs", "output"), s, "path")


@query("""with l as (select doc_id, case when doc_id % 71 = 0 then null else sha256(text) end h from documents),
 r as (select case when doc_id % 67 = 0 then -doc_id - 1 else doc_id end doc_id, case when doc_id % 61 = 0 then sha256(text || 'x') else sha256(text) end h from documents)
 select doc_id, case when r.doc_id is null then 'only_left' when l.doc_id is null then 'only_right' when l.h is null or r.h is null then 'uncomparable'
  when l.h = r.h then 'equal' else 'differing' end state from l full join r using (doc_id)""")
def manifest_diff(t):
    d = t.documents.select("doc_id", "text")
    left = bent(d.select("doc_id", F.sha2("text", 256).alias("h")), "h", "doc_id", 71, F.lit(None).cast("string"))
    changed = bent(d, "text", "doc_id", 61, F.concat("text", F.lit("x")))
    right = bent(changed.select("doc_id", F.sha2("text", 256).alias("h")), "doc_id", "doc_id", 67, -F.col("doc_id") - 1)
    return resolve.compare_manifests(left, right, "doc_id", "h")


@query("select doc_id from documents where doc_id % 61 = 0")
def sha_verify(t):
    stored = F.sha2(F.when(F.pmod("doc_id", F.lit(61)) == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256)
    d = t.documents.select("doc_id", "text", stored.alias("stored"))
    return resolve.changed_payloads(d, F.col("text"), "stored").select("doc_id")


@query("""select r_name, n_name, count(*) n from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
 join region on n_regionkey = r_regionkey group by all""")
def lineage(t):
    from corpusgauge.operators.compare import lineage_counts

    return lineage_counts(t.lineitem, [
        ("l_suppkey", t.supplier, "s_suppkey", "s_nationkey"), ("s_nationkey", t.nation, "n_nationkey", "n_regionkey"),
        ("n_regionkey", t.region, "r_regionkey", "r_name"),
    ], ["r_name", "n_name"])


@query("""select o_orderkey, case when o_orderstatus = 'F' then printf('Show the same subject from %s. Change only the camera.', lower(o_orderpriority))
 else printf('Show the same subject from %s. Change only the camera.', lower(o_orderpriority)) || ' Match image 2 and image 3.' end instruction from orders""")
def template(t):
    base = F.format_string("Show the same subject from %s. Change only the camera.", F.lower("o_orderpriority"))
    more = F.concat(base, F.lit(" Match image 2 and image 3."))
    return t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", base).otherwise(more).alias("instruction"))


@query("""select o_orderkey, (case o_orderkey % 4 when 0 then o_custkey when 1 then o_custkey % 1000 when 2 then null else null end)::int answer from orders""")
def parse_answer(t):
    k, c = F.pmod("o_orderkey", F.lit(4)), F.col("o_custkey")
    reply = (
        F.when(k == 0, F.concat(F.lit("I rate 12. <channel|> "), c, F.lit(". because")))
        .when(k == 1, F.concat(F.lit("between 7 and 2019 I say "), F.pmod(c, F.lit(1000)), F.lit(" points")))
        .when(k == 2, F.concat(F.lit("<channel|> none of "), c)).otherwise("no number here")
    )
    return t.orders.select("o_orderkey", tx.judge_answer(reply).alias("answer"))


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_shipdate < timestamp '1999-01-01')")
def resume_todo(t):
    committed = t.lineitem.where("l_shipdate < timestamp '1999-01-01'").select(F.col("l_orderkey").alias("o_orderkey"))
    return prepare.unfinished(t.orders, "o_orderkey", committed).select("o_orderkey", "o_custkey")


@query("""select conv_id, turn, printf('%02d:%02d:%02d.%03d', s // 3600000, s % 3600000 // 60000, s % 60000 // 1000, s % 1000) || ' --> ' ||
 printf('%02d:%02d:%02d.%03d', e // 3600000, e % 3600000 // 60000, e % 60000 // 1000, e % 1000) || chr(10) || text || chr(10) cue
 from (select *, turn * 2500 + conv_id s, turn * 2500 + conv_id + 2500 e from conversations) where text <> ''""")
def cue_text(t):
    from corpusgauge.sources.sinks import cues

    start = F.col("turn") * 2.5 + F.col("conv_id") / 1000
    c = t.conversations.select("conv_id", "turn", start.alias("s"), (start + 2.5).alias("e"), "text")
    return cues(c, "s", "e", "text").select("conv_id", "turn", "cue")
