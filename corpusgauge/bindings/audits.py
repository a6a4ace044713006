"""Audit queries. The given tables are clean, so each query first plants defects in the values of
whole tables (no row is dropped), then counts them."""

from pyspark.sql import functions as F

from corpusgauge.bindings.registry import query
from corpusgauge.functions.ids import hash_split, sha_id
from corpusgauge.operators import audit
from corpusgauge.operators.prepare import literal_rows
from corpusgauge.sources.catalog import catalog

# -- planted defects, in both dialects ---------------------------------------------------------


def bent(df, column, key, period, to):
    """``column`` replaced by ``to`` where ``key`` is a multiple of ``period``."""
    hit = F.pmod(F.col(key), F.lit(period)) == 0
    return df.withColumn(column, F.when(hit, to).otherwise(F.col(column)))


def bad_orders(t):
    o = bent(t.orders, "o_custkey", "o_orderkey", 97, -F.col("o_custkey") - 1)
    o = bent(o, "o_totalprice", "o_orderkey", 89, F.lit(None).cast("double"))
    return bent(o, "o_orderpriority", "o_orderkey", 83, F.lit(None).cast("string"))


BAD_ORDERS = """bad_orders as (select o_orderkey,
  case when o_orderkey % 97 = 0 then -o_custkey - 1 else o_custkey end o_custkey, o_orderstatus,
  case when o_orderkey % 89 = 0 then null else o_totalprice end o_totalprice, o_orderdate,
  case when o_orderkey % 83 = 0 then null else o_orderpriority end o_orderpriority from orders)"""


def bad_lines(t):
    l = bent(t.lineitem, "l_partkey", "l_orderkey", 101, -F.col("l_partkey") - 1)
    l = bent(l, "l_suppkey", "l_orderkey", 103, F.lit(None).cast("long"))
    l = bent(l, "l_discount", "l_orderkey", 107, F.lit(float("nan")))
    return bent(l, "l_returnflag", "l_orderkey", 109, F.lit("X"))


BAD_LINES = """bad_lines as (select l_orderkey,
  case when l_orderkey % 101 = 0 then -l_partkey - 1 else l_partkey end l_partkey,
  case when l_orderkey % 103 = 0 then null else l_suppkey end l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, case when l_orderkey % 107 = 0 then 'nan'::double else l_discount end l_discount,
  l_tax, case when l_orderkey % 109 = 0 then 'X' else l_returnflag end l_returnflag, l_linestatus
  from lineitem)"""

EDGES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


def star(t):
    names = "region nation customer supplier part documents labels".split()
    return {**{n: getattr(t, n) for n in names}, "orders": bad_orders(t), "lineitem": bad_lines(t)}


def _edge_sql(child, ckey, parent, pkey):
    source = {"orders": "bad_orders", "lineitem": "bad_lines"}.get(child, child)
    return f"""select '{child}.{ckey} -> {parent}.{pkey}' edge, count(*) missing from (
      select distinct {ckey} k from {source}) c
      where not exists (select 1 from {parent} p where p.{pkey} is not distinct from c.k)"""


FK_SQL = " union all ".join(_edge_sql(*e) for e in EDGES)


# -- queries --------------------------------------------------------------------------------------

@query("""select 'nation' as relation, 3 as declared_columns, (select count(*) from nation) as n_rows, true as present
 union all select 'orders', 6, (select count(*) from orders), true
 union all select 'lineitem', 11, (select count(*) from lineitem), true
 union all select 'documents', 5, (select count(*) from documents), true
 union all select 'absent_relation', 2, 0, false""")
def src_catalog(t):
    want = {n: getattr(t, n).schema for n in ("nation", "orders", "lineitem", "documents")}
    want["absent_relation"] = "id long, name string"
    return catalog(t.spark, t.folder, want).summary()


@query(f"with {BAD_ORDERS} select col as \"column\", n as missing from (" + " union all ".join(
    f"select '{c}' col, count(*) filter (where {c} is null) n from bad_orders" for c in
    "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()) + ")")
def null_audit(t):
    return audit.null_counts(bad_orders(t))


@query("""with d as (select o_custkey k, o_orderdate dt from orders)
 select count(*) n_rows, count(distinct (k, dt)) n_keys, count(*) - count(distinct (k, dt)) duplicates from d""")
def dup_keys(t):
    return audit.duplicates(t.orders, ["o_custkey", "o_orderdate"])


@query(f"with {BAD_ORDERS}, {BAD_LINES} {FK_SQL}")
def fk_audit(t):
    return audit.foreign_keys(star(t), EDGES)


@query(f"""with {BAD_LINES} select distinct l_partkey as key_0 from bad_lines
 where l_partkey not in (select p_partkey from part)""")
def orphans(t):
    return audit.orphans(bad_lines(t), ["l_partkey"], t.part, ["p_partkey"])


@query(f"""with {BAD_LINES} select distinct a.l_orderkey key_0, a.l_partkey key_1, a.l_linenumber key_2
 from bad_lines a where not exists (select 1 from lineitem b where b.l_orderkey = a.l_orderkey
 and b.l_partkey = a.l_partkey and b.l_linenumber = a.l_linenumber)""")
def composite_orphans(t):
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    return audit.orphans(bad_lines(t), keys, t.lineitem, keys)


@query("""with a as (select distinct o_orderkey k from orders), b as (select distinct l_orderkey k from lineitem)
 select (select count(*) from a where k not in (select k from b)) only_left,
 (select count(*) from b where k not in (select k from a)) only_right,
 (select count(*) from a where k in (select k from b)) in_both""")
def key_set_equal(t):
    return audit.key_set_difference(t.orders, ["o_orderkey"], t.lineitem, ["l_orderkey"])


@query("""with a as (select distinct doc_id k from documents), b as (select distinct doc_id k from labels)
 select 'difference' op, count(*) n from (select k from a except select k from b)
 union all select 'intersection', count(*) from (select k from a intersect select k from b)
 union all select 'union', count(*) from (select k from a union select k from b)""")
def set_ops(t):
    a, b = t.documents.select("doc_id"), t.labels.select("doc_id")
    parts = {"difference": a.subtract(b),
             "intersection": a.intersect(b), "union": a.union(b).distinct()}
    return audit.union_all(
        d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
        for op, d in parts.items()
    )


@query(f"""with {BAD_LINES}, v(axis, value) as (values ('O', 'N'), ('F', 'A'), ('F', 'R'))
 select l_linestatus axis, l_returnflag as value, count(*) n from bad_lines
 where l_linestatus in (select axis from v) and (l_linestatus, l_returnflag) not in (select axis, value from v)
 group by all""")
def vocab_audit(t):
    known = literal_rows(t.spark, [("O", "N"), ("F", "A"), ("F", "R")], "axis value")
    return audit.vocabulary(bad_lines(t), "l_returnflag", known, axis="l_linestatus")


@query(f"""with {BAD_ORDERS},
 c as (select c_custkey k, case when ('0x' || substr(sha256(c_custkey::varchar), 1, 15))::bigint % 10000 < 200 then 'val' else 'train' end s from customer),
 o as (select o_custkey k, case when o_orderkey % 59 = 0 then 'val' else
   case when ('0x' || substr(sha256(abs(o_custkey)::varchar), 1, 15))::bigint % 10000 < 200 then 'val' else 'train' end end s from bad_orders)
 select o.k as key, o.s child_value, c.s parent_value, count(*) n from o left join c using (k)
 where o.s is distinct from c.s group by all""")
def parent_agree(t):
    customers = t.customer.withColumn("split", hash_split(sha_id(F.col("c_custkey")), 0.02))
    scenes = bad_orders(t).withColumn("split", hash_split(sha_id(F.abs("o_custkey")), 0.02))
    scenes = bent(scenes, "split", "o_orderkey", 59, F.lit("val"))
    return audit.parent_agreement(scenes, "o_custkey", "split", customers, "c_custkey", "split")


@query("""with c as (select c_nationkey, case when c_custkey % 331 = 0 then 'val' else 'train' end s from customer)
 select c_nationkey, count(distinct s) n_splits from c group by 1 having count(distinct s) > 1""")
def contamination(t):
    split = F.when(F.pmod("c_custkey", F.lit(331)) == 0, "val").otherwise("train")
    return audit.contamination(t.customer.withColumn("split", split), "c_nationkey", "split")


@query("""select count(*) n, count(*) filter (where s = 'val') n_val,
 round(count(*) filter (where s = 'val') / count(*), 6) share,
 count(*) filter (where s = 'val') > 0 and count(*) filter (where s = 'val') < 0.2 * count(*) as ok
 from (select case when ('0x' || substr(sha256(c_custkey::varchar), 1, 15))::bigint % 10000 < 200 then 'val' else 'train' end s from customer)""")
def split_share(t):
    split = hash_split(sha_id(F.col("c_custkey")), 0.02)
    val = F.count_if(F.col("s") == "val")
    n = F.count(F.lit(1))
    return t.customer.select(split.alias("s")).agg(
        n.alias("n"), val.alias("n_val"), F.round(val / n, 6).alias("share"),
        ((val > 0) & (val < 0.2 * n)).alias("ok"),
    )


@query("""select k.c_custkey, h % 10000 as bucket, case when h % 10000 < 200 then 'val' when h % 10000 < 300 then 'test' else 'train' end split
 from (select c_custkey, ('0x' || substr(sha256(c_custkey::varchar), 1, 15))::bigint h from customer) k""", name="hash_split")
def hash_split_rows(t):
    key = sha_id(F.col("c_custkey"))
    return t.customer.select(
        "c_custkey", F.pmod(key, F.lit(10000)).alias("bucket"), hash_split(key, 0.02, 0.01).alias("split")
    )


@query("""with a as (select doc_id k from documents),
 b as (select case when quality = 0 then doc_id else -doc_id - 1 end k from labels)
 select distinct k as key from a where k in (select k from b)""")
def pool_disjoint(t):
    moved = F.when(F.col("quality") == 0, F.col("doc_id")).otherwise(-F.col("doc_id") - 1)
    return audit.shared_keys(t.documents, "doc_id", t.labels.select(moved.alias("edit_id")), "edit_id")


@query("""with r as (select s_suppkey, list_extract(['bf16', 'nf4', 'int8', 'bf16'], (s_nationkey % 4 + 1)::int) p from supplier),
 e as (select case when l_orderkey % 113 = 0 then -1 else l_suppkey end k from lineitem)
 select case when p is null then 'unknown' when p in ('nf4', 'int8', 'int4', 'q4_k_m', 'gguf') then 'ineligible' else 'eligible' end status,
 count(*)::bigint n from e left join r on e.k = r.s_suppkey group by 1""")
def eligibility(t):
    kinds = F.array(*[F.lit(x) for x in ("bf16", "nf4", "int8", "bf16")])
    runs = t.supplier.withColumn("precision", F.get(kinds, F.pmod("s_nationkey", F.lit(4))))
    edited = bent(t.lineitem, "l_suppkey", "l_orderkey", 113, F.lit(-1))
    return audit.eligibility(edited, "l_suppkey", runs, "s_suppkey", "precision")


LONG_SQL = """long as (select 'l_quantity' attr, l_quantity v from bad_lines union all select 'l_discount', l_discount from bad_lines
 union all select 'l_tax', l_tax from bad_lines union all select 'l_linenumber', l_linenumber from bad_lines)"""


@query(f"""with {BAD_LINES}, {LONG_SQL} select attr, count(distinct case when isnan(v) then null else v end) n_values,
 count(distinct case when isnan(v) then null else v end) < 10 collapsed from long group by 1""")
def collapsed_dims(t):
    wide = bad_lines(t).select("l_quantity", "l_discount", "l_tax", F.col("l_linenumber").cast("double"))
    return audit.few_values(wide.unpivot([], wide.columns, "attr", "v"), "attr", "v")


@query(f"""with {BAD_LINES} select 'l_discount' as "column", count(*) filter (where l_discount is null or isnan(l_discount)) not_finite,
 count(*) filter (where l_discount is null or isnan(l_discount) or l_discount < 0 or l_discount > 0.08) outside,
 min(l_discount) filter (where not isnan(l_discount)) low, max(l_discount) filter (where not isnan(l_discount)) high from bad_lines
 union all select 'l_tax', 0, count(*) filter (where l_tax < 0 or l_tax > 0.08), min(l_tax), max(l_tax) from bad_lines""")
def range_audit(t):
    return audit.value_range(bad_lines(t), ["l_discount", "l_tax"], 0.0, 0.08)


@query("""with n as (select (select count(*) from labels) used, (select count(*) from documents) total)
 select used, total, round(case when used >= total then 1e6 / greatest(total, 1) else 3e6 / greatest(used, 1) end, 4) floor_ppm,
 case when used >= total then 1e6 / greatest(total, 1) else 3e6 / greatest(used, 1) end <= 1000.0 as ok from n""")
def detection_floor(t):
    used = t.labels.agg(F.count(F.lit(1)).alias("used"))
    total = t.documents.agg(F.count(F.lit(1))).scalar()
    n = used.withColumn("total", total)
    floor = audit.detection_floor(F.col("used"), F.col("total"))
    return n.select("used", "total", F.round(floor, 4).alias("floor_ppm"), (floor <= 1000.0).alias("ok"))


@query(f"""with {BAD_ORDERS}, {BAD_LINES}, fk as ({FK_SQL}),
 checks as (
  select 'fk ' || edge as name, missing = 0 ok, true fatal from fk
  union all select 'nulls ' || col, n = 0, true from (
    select 'o_custkey' col, count(*) filter (where o_custkey is null) n from bad_orders
    union all select 'o_totalprice', count(*) filter (where o_totalprice is null) from bad_orders
    union all select 'o_orderpriority', count(*) filter (where o_orderpriority is null) from bad_orders)
  union all select 'unique o_orderkey', count(*) = count(distinct o_orderkey), true from bad_orders
  union all select 'unique order line', count(*) = count(distinct (l_orderkey, l_linenumber)), true from bad_lines
  union all select 'split hygiene', not exists (select 1 from customer group by c_nationkey
      having count(distinct c_custkey % 331 = 0) > 1), true
  union all select 'discount range', count(*) filter (where isnan(l_discount) or l_discount < 0 or l_discount > 1) = 0, false from bad_lines),
 s as (select case when ok then 'PASS' when fatal then 'FAIL' else 'WARN' end state, fatal from checks)
 select coalesce(state, 'ALL') outcome, count(*) n, count(*) filter (where state = 'FAIL' and fatal) blocking
 from s group by grouping sets ((state), ())""")
def check_rollup(t):
    return audit.roll_up(all_checks(t))


def all_checks(t):
    """Every star-schema check as rows; the keys, nulls and ranges of one table share a scan."""
    orders, lines = bad_orders(t), bad_lines(t)
    fk = audit.foreign_keys({**star(t), "orders": orders, "lineitem": lines}, EDGES)
    rows = [
        fk.select(
            F.concat(F.lit("fk "), "edge").alias("name"),
            F.when(F.col("missing") == 0, "PASS").otherwise("FAIL").alias("state"),
            F.col("missing").cast("string").alias("detail"), F.lit(True).alias("fatal"),
        )
    ]
    nulls = audit.null_counts(orders, ["o_custkey", "o_totalprice", "o_orderpriority"])
    rows.append(
        nulls.select(
            F.concat(F.lit("nulls "), "column").alias("name"),
            F.when(F.col("missing") == 0, "PASS").otherwise("FAIL").alias("state"),
            F.col("missing").cast("string").alias("detail"), F.lit(True).alias("fatal"),
        )
    )
    for label, df, key in (("unique o_orderkey", orders, ["o_orderkey"]),
                           ("unique order line", lines, ["l_orderkey", "l_linenumber"])):
        rows.append(audit.check(audit.duplicates(df, key), label, F.col("duplicates") == 0, F.col("duplicates")))
    split = F.when(F.pmod("c_custkey", F.lit(331)) == 0, "val").otherwise("train")
    mixed = audit.contamination(t.customer.withColumn("split", split), "c_nationkey", "split")
    mixed = mixed.agg(F.count(F.lit(1)).alias("n"))
    rows.append(audit.check(mixed, "split hygiene", F.col("n") == 0, F.col("n")))
    spread = audit.value_range(lines, ["l_discount"], 0.0, 1.0)
    rows.append(audit.check(spread, "discount range", F.col("outside") == 0, F.col("outside"), fatal=False))
    return audit.union_all(rows)
