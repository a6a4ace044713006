"""Matching what a corpus says against what exists: files, manifests, hashes, stated numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions.text import base_name, plain_name

# A tagged claim is <!--claim:name=value tol=t-->, with tol optional.
CLAIM = r"<!--\s*claim:(\w+)=([-\d.]+)(?:\s+tol=([\d.]+))?\s*-->"


def references(records: DataFrame, inputs: str, output: str) -> DataFrame:
    """One row per file a record names."""
    every = F.concat(F.coalesce(inputs, F.array()), F.array(output))
    return records.select(F.explode(every).alias("path"))


def resolve_references(refs: DataFrame, served: DataFrame, name: str) -> DataFrame:
    """(path, n, state): absolute, missing or served, per distinct path. Absolute wins: a leading
    slash, or a colon anywhere."""
    distinct = refs.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    have = served.select(F.col(name).alias("path")).distinct().withColumn("_served", F.lit(True))
    state = (
        F.when(F.col("path").startswith("/") | F.contains("path", F.lit(":")), "absolute")
        .when(F.col("_served"), "served")
        .otherwise("missing")
    )
    return distinct.join(have, "path", "left").select("path", "n", state.alias("state"))


def compare_manifests(left: DataFrame, right: DataFrame, name: str, digest: str) -> DataFrame:
    """(name, state): equal, differing, uncomparable (a side has no hash), only_left, only_right."""
    l = left.select(name, F.col(digest).alias("_a"), F.lit(True).alias("_l"))
    r = right.select(name, F.col(digest).alias("_b"), F.lit(True).alias("_r"))
    state = (
        F.when(F.col("_r").isNull(), "only_left")
        .when(F.col("_l").isNull(), "only_right")
        .when(F.col("_a").isNull() | F.col("_b").isNull(), "uncomparable")
        .when(F.col("_a") == F.col("_b"), "equal")
        .otherwise("differing")
    )
    return l.join(r, name, "full_outer").select(name, state.alias("state"))


def changed_payloads(df: DataFrame, payload: Column, digest: str) -> DataFrame:
    """Rows whose recomputed SHA-256 is not the stored one."""
    return df.where(~F.sha2(payload, 256).eqNullSafe(F.col(digest)))


def claims(df: DataFrame, text: str) -> DataFrame:
    """(name, stated, tol) of every tagged claim; the default tolerance is 5 %, at least 0.01."""
    part = lambda i: F.regexp_extract_all(text, F.lit(CLAIM), F.lit(i))
    rows = df.select(F.explode(F.arrays_zip(part(1), part(2), part(3))).alias("c"))
    cells = rows.select("c.*").toDF("name", "stated", "tol")
    stated = F.col("stated").try_cast("double")
    given = F.nullif(F.col("tol"), F.lit("")).try_cast("double")
    default = F.greatest(F.abs(stated) * 0.05, F.lit(0.01))
    return cells.select("name", stated.alias("stated"), F.coalesce(given, default).alias("tol"))


def check_claims(stated: DataFrame, measured: DataFrame, cache: DataFrame) -> DataFrame:
    """``measured(name, value, reachable)`` and ``cache(name, cached)``: a live value always wins;
    the cache answers only for a source that could not be reached; nothing registered is a hole."""
    both = stated.join(measured, "name", "left").join(cache, "name", "left")
    off = lambda v: F.abs(v - F.col("stated")) > F.col("tol")
    live, kept = F.col("value"), F.col("cached")
    state = (
        F.when(F.col("reachable").isNull(), "UNVERIFIED")
        .when(F.col("reachable") & live.isNotNull(), F.when(off(live), "DRIFTED").otherwise("ok"))
        .when(F.col("reachable") | kept.isNull(), "ERROR")
        .otherwise(F.when(off(kept), "DRIFTED").otherwise("CACHED"))
    )
    superseded = F.coalesce(F.col("reachable") & live.isNotNull() & kept.isNotNull(), F.lit(False))
    return both.select("name", "stated", "tol", state.alias("state"), superseded.alias("superseded"))


def name_difference(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """(side, name): names of one vocabulary that the other lacks, after normalising spelling."""
    a = left.select(F.col(left_name).alias("n")).distinct()
    b = right.select(F.col(right_name).alias("n")).distinct()
    a, b = (d.groupBy(plain_name(F.col("n")).alias("k")).agg(F.min("n").alias("n")) for d in (a, b))
    both = a.withColumnRenamed("n", "l").join(b.withColumnRenamed("n", "r"), "k", "full_outer")
    side = F.when(F.col("r").isNull(), "only_left").otherwise("only_right")
    one = both.where("l is null or r is null")
    return one.select(side.alias("side"), F.coalesce("l", "r").alias("name"))


def served_path(path: Column, folder: str = "renders") -> Column:
    """Where a file lands when published: the folder and its last path component."""
    return F.concat(F.lit(folder + "/"), base_name(path))
