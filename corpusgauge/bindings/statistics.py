"""Distributions, comparisons, rates and allocations over the given tables."""

from pyspark.sql import functions as F

from corpusgauge.bindings.audits import BAD_LINES, bad_lines
from corpusgauge.bindings.registry import query
from corpusgauge.functions import angles
from corpusgauge.operators import compare, ordering, shred, stats
from corpusgauge.operators.prepare import intern, literal_rows

# Everyday sizes in millimetres.
ANCHORS = (("credit card", 0.76), ("penny", 1.52), ("pencil", 7.0), ("AAA battery", 10.5), ("AA battery", 14.5),
           ("nickel", 21.2), ("golf ball", 42.7), ("adult wrist", 57.0), ("soda can", 66.0))
SEGMENTS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]

GROUPED = """g as (select case when c_custkey < 2 then 'rare' else c_mktsegment end grp, o_totalprice v from orders join customer on o_custkey = c_custkey),
 b as (select grp, count(v) n, quantile_cont(v, 0.05) p05, quantile_cont(v, 0.5) p50, quantile_cont(v, 0.95) p95 from g group by 1)"""


def measured_bands(t):
    grp = F.when(F.col("c_custkey") < 2, "rare").otherwise(F.col("c_mktsegment"))
    g = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(grp.alias("grp"), "o_totalprice")
    return stats.bands(g, "grp", "o_totalprice", 100, [*SEGMENTS, "rare", "absent"])


@query(f"""with {GROUPED} select grp, n, round(p05, 4) p05, round(p50, 4) p50, round(p95, 4) p95, case when n > 100 then 'PASS' else 'FAIL' end state from b
 union all select 'absent', 0, null, null, null, 'FAIL'""")
def subgroup_bands(t):
    b = measured_bands(t)
    return b.select("grp", "n", *[F.round(c, 4).alias(c) for c in ("p05", "p50", "p95")], "state")


REFS = [(s, n, v) for s in [*SEGMENTS, "absent"] for n, v in (("low", 20000.0), ("mid", 250000.0), ("high", 499000.0))]


@query(f"""with {GROUPED}, r(grp, name, value) as (values {', '.join(str(r) for r in REFS)})
 select grp, name, value::double as value, coalesce(value between p05 and p95, false) covered from r left join b using (grp)""")
def coverage_bands(t):
    refs = literal_rows(t.spark, REFS, "grp name value")
    return stats.coverage(measured_bands(t), "grp", refs)


@query("""with e as (select l_returnflag, abs(l_extendedprice - l_quantity * 1500) err from lineitem),
 x as (select l_returnflag, tol tolerance, count(err) n, count(*) filter (where err > tol) "over", max(err) worst from e, (values (1000.0::double), (20000.0), (40000.0), (90000.0)) v(tol) group by all),
 r as (select *, "over" / n rate from x)
 select r.*exclude(rate), round(r.rate, 8) rate, case when r.rate = 0 then '0 (none)' when r.rate * 1e6 >= 1 then printf('%.0f ppm', r.rate * 1e6) else printf('%.0f ppb', r.rate * 1e9) end rate_text,
 round(case when r.rate = 0 then 'inf'::double else a.rate / r.rate end, 6) improvement from r join r a on a.l_returnflag = 'A' and a.tolerance = r.tolerance""")
def exceedance(t):
    err = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500)
    lines = t.lineitem.select("l_returnflag", err.alias("err"))
    r = compare.exceedance(lines, ["l_returnflag"], "err", [1000.0, 20000.0, 40000.0, 90000.0])
    base = r.where("l_returnflag = 'A'").select("tolerance", F.col("rate").alias("base"))
    better = F.when(F.col("rate") == 0, F.lit(float("inf"))).otherwise(F.col("base") / F.nullif("rate", F.lit(0.0)))
    return r.join(base, "tolerance").select(
        "l_returnflag", "tolerance", "n", "over", "worst", F.round("rate", 8).alias("rate"),
        compare.rate_text(F.col("rate")).alias("rate_text"), F.round(better, 6).alias("improvement"))


@query("""with c as (select event_type, sum(round(value * 100)::bigint) / 100.0::double s, count(*) n, count(distinct user_id) u from events group by 1)
 select event_type, round(s / n, 6) per_image, round(s / u, 6) per_step, round((s / n) / (select s / n from c where event_type = 'click'), 6) ratio from c""")
def bench_ratio(t):
    per_user = t.events.groupBy("event_type", "user_id").agg(
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("s"), F.count(F.lit(1)).alias("n"))
    c = per_user.groupBy("event_type").agg((F.sum("s") / 100.0).alias("s"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("u"))
    out = compare.against_baseline(c, "event_type", "click", "s", {"per_image": "n", "per_step": "u"})
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("per_image", "per_step", "ratio")])


@query(f"""select p_partkey, a[1] anchor, case when mm / a[2]::double < 1.5 then 'about one ' || a[1] else printf('about %.0f ', mm / a[2]::double) || a[1] || 's stacked' end phrase
 from (select p_partkey, p_size * 1.37 mm, min_by(a, (abs(p_size * 1.37 - a[2]::double), i)) a from part,
 (values {', '.join(f"(['{n}', '{s}'], {i})" for i, (n, s) in enumerate(ANCHORS))}) v(a, i) group by p_partkey, p_size)""")
def nearest_anchor(t):
    mm = F.col("p_size") * 1.37
    size = F.element_at(F.create_map(*[F.lit(x) for pair in ANCHORS for x in pair]), F.col("anchor"))
    p = t.part.select("p_partkey", mm.alias("mm"), compare.nearest_anchor(mm, ANCHORS).alias("anchor"))
    many = F.concat(F.format_string("about %.0f ", F.col("mm") / size), "anchor", F.lit("s stacked"))
    phrase = F.when(F.col("mm") / size < 1.5, F.concat(F.lit("about one "), "anchor")).otherwise(many)
    return p.select("p_partkey", "anchor", phrase.alias("phrase"))


@query(f"""with {BAD_LINES} select l_linenumber "rank", round(avg(l_discount) filter (where not isnan(l_discount)), 6) l_discount, round(avg(l_tax), 6) l_tax from bad_lines group by 1""")
def rank_summary(t):
    s = compare.rank_summary(bad_lines(t), "l_linenumber", ["l_discount", "l_tax"])
    return s.select(F.col("l_linenumber").alias("rank"), F.round("l_discount", 6).alias("l_discount"), F.round("l_tax", 6).alias("l_tax"))


@query("""with c as (select l_partkey, avg(l_discount * (l_linenumber - 1)) filter (where l_linenumber = 1) a, avg(l_discount * (l_linenumber - 1)) filter (where l_linenumber = 5) b from lineitem group by 1)
 select l_partkey, round(a, 6) as identity, round(b, 6) negative, coalesce(a <= 1e-6, false) identity_ok, coalesce(b > a, false) negative_ok from c""")
def controls_gate(t):
    scored = t.lineitem.withColumn("m", F.col("l_discount") * (F.col("l_linenumber") - 1))
    g = compare.control_gate(scored, ["l_partkey"], "l_linenumber", "m", same=1, worst=5)
    return g.withColumn("identity", F.round("identity", 6)).withColumn("negative", F.round("negative", 6))


@query("""select p_partkey, name, case when starts_with(name, 'control_') then p_retailprice < 1000 else p_retailprice >= 1000 end ok
 from (select p_partkey, p_retailprice, case when p_size < 20 then 'control_' || p_name else p_name end name from part)""")
def two_way_floor(t):
    name = F.when(F.col("p_size") < 20, F.concat(F.lit("control_"), "p_name")).otherwise(F.col("p_name"))
    p = t.part.select("p_partkey", name.alias("name"), "p_retailprice")
    return compare.two_way_floor(p, "name", "p_retailprice", 1000.0).select("p_partkey", "name", "ok")


@query("""select event_type, count(v) scored, count(*) filter (where v is null) refused, round(avg(v), 4) mean
 from (select event_type, case when event_id % 9 <> 0 then value end v from events) group by 1""")
def nondetect_stats(t):
    e = t.events.withColumn("v", F.when(F.pmod("event_id", F.lit(9)) != 0, F.col("value")))
    return compare.with_refusals(e, ["event_type"], "v").withColumn("mean", F.round("mean", 4))


@query("""with p as (select vec_id, i - 1 idx, embedding[4*i-3:4*i]::double[] a, list_reverse(embedding)[4*i-3:4*i]::double[] b from embeddings, unnest(range(1, 17)) t(i))
 select vec_id, count(*) n, round(avg(list_distance(a, b)), 5) mean_drift, round(max(list_distance(a, b)), 5) max_drift from p group by 1""")
def point_drift(t):
    at = lambda k: F.get("embedding", k).cast("double")
    i = F.col("idx")
    e = t.embeddings.select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("idx"))
    a = e.select("vec_id", "idx", *[at(4 * i + k).alias(n) for k, n in enumerate("wxyz")])
    b = e.select("vec_id", "idx", *[at(63 - 4 * i - k).alias(n) for k, n in enumerate("wxyz")])
    d = compare.point_drift(a, b, ["vec_id"], "idx", list("wxyz"))
    return d.select("vec_id", "n", F.round("mean_drift", 5).alias("mean_drift"), F.round("max_drift", 5).alias("max_drift"))


@query("""with s as (select l_orderkey k, sum(round(l_extendedprice * 100)::bigint) / 100.0::double a from lineitem group by 1),
 c as (select o_orderpriority g, abs(a - o_totalprice) diff, case when o_totalprice > 1e-6 then a / o_totalprice end ratio from orders join s on k = o_orderkey)
 select g o_orderpriority, count(*) n, round(max(diff), 4) max_diff, round(avg(diff), 4) mean_diff, count(*) filter (where diff > 100000) "over",
 round(quantile_cont(ratio, 0.05), 6) p05, round(quantile_cont(ratio, 0.5), 6) p50, round(quantile_cont(ratio, 0.95), 6) p95, round(quantile_cont(diff, 0.99), 4) p99 from c group by 1""")
def paired_ratio_stats(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / 100.0).alias("a"))
    lines = lines.join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    cells, counts = compare.ratio_stats(lines, t.orders, ["o_orderkey"], "a", "o_totalprice", ["o_orderpriority"], 100000)
    long = shred.melt(cells, ["o_orderpriority"], ["ratio", "diff"])
    q = ordering.exact_percentiles(long, "metric_value", [0.05, 0.5, 0.95, 0.99], ["o_orderpriority", "metric_name"])
    pick = lambda name, p, digits: F.round(F.max(F.when((F.col("metric_name") == name) & (F.col("p") == p), F.col("q"))), digits)
    r = q.groupBy("o_orderpriority").agg(*[pick("ratio", p, 6).alias(n) for p, n in ((0.05, "p05"), (0.5, "p50"), (0.95, "p95"))], pick("diff", 0.99, 4).alias("p99"))
    rounded = counts.withColumn("max_diff", F.round("max_diff", 4)).withColumn("mean_diff", F.round("mean_diff", 4))
    return rounded.join(r, "o_orderpriority")


@query("""select l_orderkey, l_partkey, l_linenumber, l_extendedprice, low, high, round((l_extendedprice - low) / case when high > low then high - low else 1 end, 6) norm
 from (select *, min(l_extendedprice) over (partition by l_orderkey) low, max(l_extendedprice) over (partition by l_orderkey) high from lineitem)""")
def minmax_norm(t):
    n = stats.normalised(t.lineitem, ["l_orderkey"], "l_extendedprice", "norm")
    return n.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "low", "high", F.round("norm", 6).alias("norm"))


@query("""with b as (select l_suppkey, 1 / greatest(max(l_quantity) - min(l_quantity), max(l_linenumber) - min(l_linenumber), max(l_tax) - min(l_tax)) scale,
  (max(l_quantity) + min(l_quantity)) / 2 cq, (max(l_linenumber) + min(l_linenumber)) / 2 cl, (max(l_tax) + min(l_tax)) / 2 ct from lineitem group by 1)
 select l_suppkey, l_orderkey, l_partkey, round((l_quantity - cq) * scale, 6) x, round((l_linenumber - cl) * scale, 6) y, round((l_tax - ct) * scale, 6) z from lineitem join b using (l_suppkey)""")
def unit_cube(t):
    u = stats.unit_cube(t.lineitem, "l_suppkey", ["l_quantity", "l_linenumber", "l_tax"])
    return u.select("l_suppkey", "l_orderkey", "l_partkey", *[F.round(f"unit_{c}", 6).alias(n) for c, n in
                                                             (("l_quantity", "x"), ("l_linenumber", "y"), ("l_tax", "z"))])


@query("""with r as (select l_suppkey, l_extendedprice v, row_number() over (partition by l_suppkey order by l_extendedprice, l_orderkey, l_partkey, l_linenumber) - 1 i, count(*) over (partition by l_suppkey) n from lineitem)
 select l_suppkey, n, round(case when n >= 20 then avg(v) filter (where i >= n - greatest(1, n // 10)) end, 4) top, round(case when n >= 20 then avg(v) filter (where i < greatest(1, n // 10)) end, 4) bottom from r group by 1, 2""")
def tail_means(t):
    m = stats.tail_means(t.lineitem, "l_suppkey", "l_extendedprice", ["l_orderkey", "l_partkey", "l_linenumber"])
    return m.select("l_suppkey", "n", F.round("top", 4).alias("top"), F.round("bottom", 4).alias("bottom"))


@query("""with c as (select l_partkey, round(l_discount, 3) d, round(l_tax, 3) x, round(l_quantity / 500, 3) q, count(*) c from lineitem group by 1, 2, 3, 4), s as (select *, sum(c) over (partition by l_partkey)::bigint n from c),
 f as (select *, n >= 20 and c >= greatest(3, n // 10) ok, d * 0.2126 + x * 0.7152 + q * 0.0722 luma from s)
 select l_partkey, n, max_by(d || '/' || x || '/' || q, (luma, -d, -x, -q)) filter (where ok) lightest, min_by(d || '/' || x || '/' || q, (luma, d, x, q)) filter (where ok) darkest from f group by 1, 2""")
def frequent_extremes(t):
    lines = t.lineitem.withColumn("q", F.col("l_quantity") / 500)
    e = stats.frequent_extremes(lines, "l_partkey", ["l_discount", "l_tax", "q"], stats.LUMA)
    text = lambda c: F.concat(F.col(f"{c}.l_discount"), F.lit("/"), F.col(f"{c}.l_tax"), F.lit("/"), F.col(f"{c}.q")).alias(c)
    return e.select("l_partkey", "n", text("lightest"), text("darkest"))


@query("""with b(i, lo, hi) as (values (0, 0.2, 0.35), (1, 0.35, 0.5), (2, 0.5, 0.65), (3, 0.65, 0.8), (4, 0.8, 0.95)),
 p as (select l_partkey % 500 k, l_quantity / 50 pos, l_discount * 900 v from lineitem),
 m as (select k, i, (lo + hi)::double / 2 mid, count(*) n, quantile_cont(v, 0.5) q from p join b on pos >= lo::double and pos < hi::double group by all having count(*) >= 3)
 select k, count(i) n_bands, round(coalesce(sqrt(avg((q - mid * 90) ** 2)), 'nan'::double), 5) rmse from (select distinct k from p) left join m using (k) group by 1""")
def band_rmse(t):
    p = t.lineitem.select(F.pmod("l_partkey", F.lit(500)).alias("k"), (F.col("l_quantity") / 50).alias("pos"),
                          (F.col("l_discount") * 900).alias("v"))
    return stats.band_rmse(p, "k", "pos", "v", 90.0).withColumn("rmse", F.round("rmse", 5))


@query("""with g as (select * from (values ('O'), ('F'), ('P')) a(o_orderstatus), (values ('1-URGENT'), ('2-HIGH'), ('9-NEVER')) b(o_orderpriority)),
 c as (select o_orderstatus, o_orderpriority, count(*) n from orders group by 1, 2)
 select o_orderstatus, o_orderpriority, coalesce(n, 0) n from g left join c using (o_orderstatus, o_orderpriority) where coalesce(n, 0) < 2""")
def coverage_gaps(t):
    return stats.coverage_gaps(t.orders, [("o_orderstatus", ["O", "F", "P"]), ("o_orderpriority", ["1-URGENT", "2-HIGH", "9-NEVER"])])


@query("""with s as (select c_nationkey k, count(*)::double s from customer group by 1), e as (select k, (1000 - 5 * count(*) over ()) * s / sum(s) over () x, 1000 - 5 * count(*) over () spare from s),
 r as (select *, floor(x) w, row_number() over (order by x - floor(x) desc, k) - 1 i from e)
 select k c_nationkey, (5 + w + case when i < spare - sum(w) over () then 1 else 0 end)::bigint allocated from r""")
def apportion(t):
    per = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("s"))
    return stats.apportion(per, "c_nationkey", "s", 1000, 5)


@query("""with s as (select l_linenumber k, coalesce(stddev_samp(l_quantity), 0) s from lineitem group by 1), e as (select k, (200 - 2 * count(*) over ()) * s / sum(s) over () x, 200 - 2 * count(*) over () spare from s),
 r as (select *, floor(x) w, row_number() over (order by x - floor(x) desc, k) - 1 i from e)
 select k l_linenumber, (2 + w + case when i < spare - sum(w) over () then 1 else 0 end)::bigint allocated from r""")
def allocate_by_spread(t):
    return stats.apportion_by_spread(t.lineitem, "l_linenumber", "l_quantity", 200)


@query("""with d(band, low, high) as (values ('R', 1, 3), ('R', 5, 6), ('N', 0, 4)),
 l as (select l_orderkey, l_linenumber - 1 i, case when l_linestatus = 'F' then l_returnflag end band from lineitem),
 m as (select l_orderkey, i, l.band, l.band is null or l.band in (select band from d) known, exists (select 1 from d where d.band = l.band and i between low and high) inside from l)
 select l_orderkey, count(distinct i) n_indices, case when min(i) = 0 and max(i) + 1 = count(distinct i) and count(distinct i) = 7 then 'whole' when not bool_and(known) then 'undeclared band'
  when bool_or(band is not null) and bool_and(inside) then 'band' when min(i) = 0 and max(i) + 1 = count(distinct i) then 'prefix' else 'hand-picked' end selection from m group by 1""")
def selection_class(t):
    """Line numbers as chosen indices, return flags of finished lines as band names; A is not declared."""
    bands = t.spark.createDataFrame([("R", 1, 3), ("R", 5, 6), ("N", 0, 4)], "band string, low int, high int")
    lines = t.lineitem.select("l_orderkey", (F.col("l_linenumber") - 1).alias("i"), F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("band"))
    return stats.selection_class(lines, "l_orderkey", "i", 7, "band", bands)


# -- order ------------------------------------------------------------------------------------------

@query("""select c_custkey, coalesce(lead(c_name) over (order by c_mktsegment, c_custkey), first(c_name) over (order by c_mktsegment, c_custkey)) next_name from customer""")
def circular_lead(t):
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return ordering.ring_next(c, ["c_mktsegment", "c_custkey"], F.col("c_name"), "next_name").select("c_custkey", "next_name")


@query("""select event_id, coalesce(arg_min(v, i) over w, arg_max(v, i) over (partition by user_id)) nearest from (
  select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) i, case when event_type = 'purchase' then value end v from events)
 window w as (partition by user_id order by i rows between current row and unbounded following)""")
def asof_forward(t):
    sample = F.when(F.col("event_type") == "purchase", F.col("value"))
    e = t.events.select("event_id", "user_id", "ts", sample.alias("v"))
    return ordering.first_at_or_after(e, ["ts", "event_id"], F.col("v"), "nearest", ["user_id"]).select("event_id", "nearest")


@query("""select o_orderkey, i::int frame, round(o_totalprice * case when n = 1 then 0 else i / (n - 1) end, 4) "value" from (select *, (o_orderkey % 6 + 1)::int n from orders), unnest(range(0, n)) u(i)""")
def ramp(t):
    from corpusgauge.operators.generate import ramp as ramp_rows

    o = t.orders.select("o_orderkey", F.lit(0.0).alias("a"), F.col("o_totalprice").alias("b"), (F.pmod("o_orderkey", F.lit(6)) + 1).cast("int").alias("n"))
    return ramp_rows(o, ["o_orderkey"], "a", "b", "n").withColumn("value", F.round("value", 4))


@query("""select p_partkey, dense_rank() over (order by p_name) - 1 text_id from part""")
def intern_text(t):
    ids = intern(t.part, {"p_name": "p_name"})
    return t.part.join(ids, F.col("p_name") == F.col("text")).select("p_partkey", F.col("id").alias("text_id"))


@query("""select distinct p_brand, p_type, dense_rank() over (order by p_brand, p_type) - 1 pair_id from part""")
def intern_pairs(t):
    pairs = t.part.select("p_brand", "p_type").distinct()
    return ordering.row_numbers(pairs, ["p_brand", "p_type"], "pair_id")


@query("""select p_name, count(distinct p_type) n_types from part group by 1 having count(distinct p_type) > 1""")
def multi_owner(t):
    pairs = t.part.select("p_name", "p_type").distinct()
    return pairs.groupBy("p_name").agg(F.count(F.lit(1)).alias("n_types")).where("n_types > 1")


# -- angles and runs ---------------------------------------------------------------------------------

VIEWS = """v as (select l_suppkey, l_linestatus run, l_linenumber, 45.0::double * (l_linenumber - 1) asked, (sum(l_partkey) % 41 - 20)::double off, max(l_quantity) top from lineitem group by all),
 views as (select l_suppkey, run, l_linenumber, asked, (asked * 0.8 + off + 180) - 360 * floor((asked * 0.8 + off + 180) / 360) - 180 recovered, top from v),
 fitted as (select *, abs((recovered - asked + 180) - 360 * floor((recovered - asked + 180) / 360) - 180) err from views where top < 50)"""


def views(t):
    off = (F.pmod(F.sum("l_partkey"), F.lit(41)) - 20).cast("double")
    v = t.lineitem.groupBy("l_suppkey", F.col("l_linestatus").alias("run"), "l_linenumber").agg(off.alias("off"), F.max("l_quantity").alias("top"))
    v = v.withColumn("asked", 45.0 * (F.col("l_linenumber") - 1))
    v = v.withColumn("recovered", angles.wrap(F.col("asked") * 0.8 + F.col("off")))
    return v.withColumn("err", F.abs(angles.wrap(F.col("recovered") - F.col("asked"))))


def fitted(t):
    """A view with no detection has no row."""
    return views(t).where("top < 50")


def unwrap_sql(source):
    return f"""st as (select *, recovered - lag(recovered) over (partition by l_suppkey, run order by asked) d from {source}),
 fx as (select *, case when d is null or abs(d) < 180 then 0 else case when (d + 180) - 360 * floor((d + 180) / 360) - 180 = -180 and d > 0 then 180 else (d + 180) - 360 * floor((d + 180) / 360) - 180 end - d end fix from st),
 un as (select *, recovered + sum(fix) over (partition by l_suppkey, run order by asked) flat from fx),
 sl as (select l_suppkey, run, count(*) n, case when count(*) >= 3 then regr_slope(flat, asked) else 'nan'::double end slope from un group by 1, 2)"""


@query("""select event_id, round((value * 7 - 1000 + 180) - 360 * floor((value * 7 - 1000 + 180) / 360) - 180, 6) wrapped from events""")
def wrap_deg(t):
    return t.events.select("event_id", F.round(angles.wrap(F.col("value") * 7 - 1000), 6).alias("wrapped"))


@query(f"with {VIEWS}, {unwrap_sql('fitted')} select l_suppkey, run, n, round(slope, 6) slope from sl")
def unwrap_slope(t):
    return compare.slope(fitted(t), ["l_suppkey", "run"], ["asked"], "asked", "recovered").withColumn("slope", F.round("slope", 6))


@query(f"""with {VIEWS}, common as (select * from fitted f where exists (select 1 from fitted g where g.l_suppkey = f.l_suppkey and g.asked = f.asked and g.run <> f.run)), {unwrap_sql('common')}
 select l_suppkey, run, n, round(slope, 6) slope from sl""")
def common_slope(t):
    f = fitted(t)
    both = f.groupBy("l_suppkey", "asked").agg(F.count_distinct("run").alias("k")).where("k = 2").drop("k")
    common = f.join(both, ["l_suppkey", "asked"], "left_semi")
    return compare.slope(common, ["l_suppkey", "run"], ["asked"], "asked", "recovered").withColumn("slope", F.round("slope", 6))


@query(f"""with {VIEWS}, b as (select * from fitted where run = 'O'), o as (select * from fitted where run = 'F'), u as (select distinct l_suppkey, asked from views)
 select u.l_suppkey, u.asked, round(b.err, 6) base, round(o.err, 6) other, round(o.err - b.err, 6) delta, case when b.err is not null and o.err is not null then case when o.err < b.err then 'better' when o.err > b.err then 'worse' else 'same' end
  when b.err is not null then 'lost by other' when o.err is not null then 'lost by base' else 'unscored in both' end outcome
 from u left join b using (l_suppkey, asked) left join o using (l_suppkey, asked)""")
def run_compare(t):
    every, f = views(t), fitted(t)
    out = compare.compare_runs(f.where("run = 'O'"), f.where("run = 'F'"), ["l_suppkey", "asked"], "err", every)
    return out.select("l_suppkey", "asked", *[F.round(c, 6).alias(c) for c in ("base", "other", "delta")], "outcome")


@query(f"""with {VIEWS}, {unwrap_sql('fitted')}, w as (select l_suppkey, run, count(*) filter (where err <= 30) as within from fitted group by 1, 2)
 select l_suppkey, run, n, round(slope, 6) slope, within, case when n < 3 then 'undecided' when round(slope, 9) > 0.5 and within >= n * 0.6 then 'follows' else 'does not follow' end verdict from sl join w using (l_suppkey, run)""")
def verdict(t):
    out = compare.verdict(fitted(t), ["l_suppkey", "run"], ["asked"], "asked", "recovered", "err")
    return out.withColumn("slope", F.round("slope", 6))


@query("""select l_orderkey, count(distinct l_linenumber) n, sum(case when l_returnflag = 'A' then 1 else 0 end)::bigint a, sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint r, sum(case when l_returnflag = 'N' then 1 else 0 end)::bigint n_flag,
 a = 1 and r = 1 and n_flag = 1 complete from lineitem group by 1""")
def complete_sets(t):
    flag = lambda f: F.count_if(F.col("l_returnflag") == f)
    done = (flag("A") == 1) & (flag("R") == 1) & (flag("N") == 1)
    return t.lineitem.groupBy("l_orderkey").agg(F.count_distinct("l_linenumber").alias("n"), flag("A").alias("a"), flag("R").alias("r"),
                                                flag("N").alias("n_flag"), done.alias("complete"))


@query("""select l_partkey, min_by(l_orderkey, (abs(l_discount - 0.05) + abs(l_tax - 0.04), l_orderkey)) pick from lineitem group by 1""")
def argmin_pick(t):
    score = F.abs(F.col("l_discount") - 0.05) + F.abs(F.col("l_tax") - 0.04)
    return t.lineitem.groupBy("l_partkey").agg(F.min_by("l_orderkey", F.struct(score, "l_orderkey")).alias("pick"))


@query("""with p as (select page_id, case when contains(url, '_2048') then 2048 when contains(url, '_1024') then 1024 else 0 end res, url, split_part(split_part(url, '://', 2), '/', 1) host from (
  select page_id, case when url like '%=%' then url || '_2048.glb' when url like '%#%' then url || '_1024.glb' else url end url from pages))
 select host, max_by(url, (res, -page_id)) best, max(res) res from p group by 1""")
def best_per_key(t):
    url = F.when(F.contains("url", F.lit("=")), F.concat("url", F.lit("_2048.glb"))).when(
        F.contains("url", F.lit("#")), F.concat("url", F.lit("_1024.glb"))).otherwise(F.col("url"))
    p = t.pages.select("page_id", url.alias("url"))
    res = F.when(F.contains("url", F.lit("_2048")), 2048).when(F.contains("url", F.lit("_1024")), 1024).otherwise(0)
    host = F.substring_index(F.substring_index("url", "://", -1), "/", 1)
    p = p.select("page_id", "url", res.alias("res"), host.alias("host"))
    return p.groupBy("host").agg(F.max_by("url", F.struct("res", -F.col("page_id"))).alias("best"), F.max("res").alias("res"))
