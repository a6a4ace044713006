"""Targeted defects: each mutator spoils one thing, and exactly one check must notice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions.ids import hash_split, sha_id, uniform
from corpusgauge.operators import audit


def people(df: DataFrame) -> DataFrame:
    """A clean identity table made from the rows of ``df(c_custkey, ...)``."""
    key = F.col("c_custkey")
    return df.select(
        key.alias("identity_id"), F.concat(F.lit("s"), key).alias("subject"),
        hash_split(sha_id(F.lit("split"), key), 0.1).alias("split"),
        uniform(F.lit("height"), key).alias("height"), uniform(F.lit("age"), key).alias("age"),
    )


def _some(share: float):
    return uniform(F.lit("hit"), F.col("identity_id")) < share


CORRUPTIONS = {
    "null value": lambda d: d.withColumn("age", F.when(~_some(0.05), F.col("age"))),
    "out of range": lambda d: d.withColumn("height", F.when(_some(0.05), F.lit(5.0)).otherwise(F.col("height"))),
    "repeated id": lambda d: d.withColumn(
        "identity_id", F.when(_some(0.2), F.lit(-1).cast("long")).otherwise(F.col("identity_id"))),
    "constant attribute": lambda d: d.withColumn("age", F.lit(0.5)),
    "subject across splits": lambda d: d.withColumn("subject", F.when(_some(0.5), F.lit("s-1")).otherwise(F.col("subject"))),
    "no val rows": lambda d: d.withColumn("split", F.lit("train")),
}


def identity_checks(d: DataFrame) -> DataFrame:
    """The distribution checks of an identity table, as check rows."""
    n = F.count(F.lit(1))
    long = d.select("height", "age").unpivot([], ["height", "age"], "name", "value")
    nulls = audit.null_counts(d).agg(F.sum("missing").alias("n"))
    # a missing value is the null check's finding, so range looks at present values only
    outside = d.agg(F.count_if(~F.col("height").between(0, 1) | ~F.col("age").between(0, 1)).alias("n"))
    dups = audit.duplicates(d, ["identity_id"])
    flat = audit.few_values(long, "name", "value").agg(F.count_if("collapsed").alias("n"))
    mixed = audit.contamination(d, "subject", "split").agg(n.alias("n"))
    val = d.agg(F.count_if(F.col("split") == "val").alias("v"), n.alias("n"))
    return audit.union_all([
        audit.check(nulls, "nulls", F.col("n") == 0, F.col("n")),
        audit.check(outside, "range", F.col("n") == 0, F.col("n")),
        audit.check(dups, "unique", F.col("duplicates") == 0, F.col("duplicates")),
        audit.check(flat, "spread", F.col("n") == 0, F.col("n")),
        audit.check(mixed, "subject split", F.col("n") == 0, F.col("n")),
        audit.check(val, "val share", (F.col("v") > 0) & (F.col("v") < 0.2 * F.col("n")), F.col("v")),
    ])


def red_green(clean: DataFrame) -> DataFrame:
    """(corruption, name, state) of every check on the clean table and on each corrupted one."""
    runs = {"clean": clean, **{name: spoil(clean) for name, spoil in CORRUPTIONS.items()}}
    return audit.union_all(
        identity_checks(d).select(F.lit(name).alias("corruption"), "name", "state") for name, d in runs.items()
    )
