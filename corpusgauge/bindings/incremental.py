"""Files, gates and streams. Each query writes under the shared folder and reads back."""

from pyspark.sql import functions as F

from corpusgauge.bindings.audits import bent
from corpusgauge.bindings.registry import query
from corpusgauge.operators import audit, corrupt, prepare
from corpusgauge.session import scratch
from corpusgauge.sources import sinks
from corpusgauge.streaming import incremental


@query("""select case when (row_number() over (order by doc_id) - 1) % 8 = 0 then 'val' else 'train' end split, doc_id, 'edit' task_type, len(text) n from documents""")
def jsonl_roundtrip(t):
    d = prepare.stride_split(t.documents.select("doc_id", "text"), ["doc_id"], 0.125)
    records = d.select("split", F.lit("edit").alias("task_type"), "doc_id", F.col("text").alias("instruction"))
    path = scratch(t.spark, "records")
    sinks.write_records(records, path)
    back = t.spark.read.schema("task_type string, doc_id long, instruction string, split string").json(path)
    return back.select("split", "doc_id", "task_type", F.length("instruction").cast("long").alias("n"))


@query("""with c as (select conv_id, turn, text, turn * 2500 + conv_id s from conversations where text <> ''),
 l as (select conv_id, s, s + 2500 e, text, printf('%02d:%02d:%02d.%03d', s // 3600000, s % 3600000 // 60000, s % 60000 // 1000, s % 1000) a,
  printf('%02d:%02d:%02d.%03d', (s + 2500) // 3600000, (s + 2500) % 3600000 // 60000, (s + 2500) % 60000 // 1000, (s + 2500) % 1000) b from c)
 select k.conv_id, 'WEBVTT' || chr(10) || chr(10) || coalesce(string_agg(a || ' --> ' || b || chr(10) || text || chr(10) || chr(10), '' order by s, text), '') as text
 from (select distinct conv_id from conversations) k left join l using (conv_id) group by 1""")
def caption_files(t):
    start = F.col("turn") * 2.5 + F.col("conv_id") / 1000
    path = scratch(t.spark, "captions")
    said = t.conversations.select("conv_id", start.alias("s"), (start + 2.5).alias("e"), "text")
    sinks.write_captions(said, "conv_id", "s", "e", "text", path)
    return sinks.read_captions(t.spark, path).select(F.col("conv_id").cast("long").alias("conv_id"), "text")


@query("select o_orderstatus, count(*) n, count(distinct o_orderkey) n_keys, sum(o_custkey)::bigint customers, max(o_orderdate) newest from orders group by 1")
def relation_roundtrip(t):
    path = scratch(t.spark, "relation")
    sinks.write_relation(t.orders, path)
    back = t.spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys"), F.sum("o_custkey").alias("customers"), F.max("o_orderdate").alias("newest"))


@query("""select 'clean' attempt, true written, (select count(*) from orders) n union all select 'contaminated', false, 0""")
def gated_write(t):
    clean = audit.orphans(t.orders, ["o_custkey"], t.customer, ["c_custkey"])
    dirty_orders = bent(t.orders, "o_custkey", "o_orderkey", 97, -F.col("o_custkey") - 1)
    dirty = audit.orphans(dirty_orders, ["o_custkey"], t.customer, ["c_custkey"])
    rows = []
    for attempt, table, problems in (("clean", t.orders, clean), ("contaminated", dirty_orders, dirty)):
        root = scratch(t.spark, "publish")
        try:
            path = sinks.publish({"orders": table}, problems, root)[0]
            n = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
            rows.append(n.select(F.lit(attempt).alias("attempt"), F.lit(True).alias("written"), "n"))
        except sinks.PublishRefused:
            written = incremental.path_exists(t.spark, root)
            rows.append(t.spark.range(1).select(F.lit(attempt).alias("attempt"), F.lit(written).alias("written"), F.lit(0).cast("long").alias("n")))
    return audit.union_all(rows)


@query("""select 'clean' corruption, c.name, 'PASS' state from (values ('nulls'), ('range'), ('unique'), ('spread'), ('subject split'), ('val share')) c(name)
 union all select d.name, c.name, case when d.hits = c.name then 'FAIL' else 'PASS' end from (values ('null value', 'nulls'), ('out of range', 'range'), ('repeated id', 'unique'), ('constant attribute', 'spread'), ('subject across splits', 'subject split'), ('no val rows', 'val share')) d(name, hits),
 (values ('nulls'), ('range'), ('unique'), ('spread'), ('subject split'), ('val share')) c(name)""")
def red_green(t):
    return corrupt.red_green(corrupt.people(t.customer))


@query("select count(*) n_rows, count(distinct o_orderkey) n_keys, true as stable from orders")
def idempotent_append(t):
    path = scratch(t.spark, "append")
    o = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    incremental.append_new(o.join(lines, "o_orderkey", "left_semi"), ["o_orderkey"], path)  # an earlier, partial run
    incremental.append_new(o, ["o_orderkey"], path)
    incremental.append_new(o, ["o_orderkey"], path)
    d = audit.duplicates(t.spark.read.parquet(path), ["o_orderkey"])
    return d.select("n_rows", "n_keys", (F.col("duplicates") == 0).alias("stable"))


@query("""with e as (select event_id, case when event_id % 19 = 0 then null when value < 1 then 'below range' when event_type = 'error' then 'refused type' end p from events)
 select coalesce(case when event_id % 19 = 0 then 'no value' end, p, 'accepted') outcome, count(*) n from e group by 1""")
def stream_gate(t):
    inbox, root = scratch(t.spark, "inbox"), scratch(t.spark, "gate")
    arriving = bent(t.events, "value", "event_id", 19, F.lit(None).cast("double"))
    arriving.write.parquet(f"{inbox}")
    arriving.write.mode("append").parquet(f"{inbox}")  # every shard arrives twice
    stream = incremental.shards(t.spark, inbox, arriving.schema)
    rules = [("no value", F.col("value").isNull()), ("below range", F.col("value") < 1), ("refused type", F.col("event_type") == "error")]
    q = incremental.gate_stream(stream, rules, ["event_id"], root)

    def result():
        good = t.spark.read.parquet(f"{root}/accepted").select("event_id", F.lit("accepted").alias("outcome"))
        bad = t.spark.read.parquet(f"{root}/quarantine").where("problem <> 'already committed'")
        every = good.unionByName(bad.select("event_id", F.col("problem").alias("outcome"))).distinct()
        return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))

    return incremental.finished(q, result)


@query("select event_type, case when event_id % 7 = 0 then 'late' else 'logged' end outcome, count(*) n from events group by all")
def stream_log(t):
    """Events arrive in files by time. Every key comes again in a later file, some with a later time and some without
    one; each seventh key comes only once all others have, and is late. Times are moved apart so that this does not hang on the data."""
    spark, inbox, root = t.spark, scratch(t.spark, "inbox"), scratch(t.spark, "log")
    e = t.events.select("event_id", "ts", "event_type", "value")
    main, slow = e.where("event_id % 7 <> 0"), e.where("event_id % 7 = 0")
    third = F.pmod(F.col("event_id"), F.lit(3))
    for step in range(3):
        main.where(third == step).coalesce(1).write.mode("append").parquet(inbox)
    again = main.withColumn("ts", F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts") + F.expr("interval 4000 days")))
    again.coalesce(1).write.mode("append").parquet(inbox)
    slow.coalesce(1).write.mode("append").parquet(inbox)
    stream = incremental.shards(spark, inbox, e.schema)
    q = incremental.log_stream(stream, ["event_id"], "ts", "3000 days", root)

    def result():
        done = lambda name: spark.read.schema(e.schema).parquet(f"{root}/{name}").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("logged" if name == "log" else "late"))
        return done("log").unionByName(done("late")).select("event_type", "outcome", "n")

    return incremental.finished(q, result)
