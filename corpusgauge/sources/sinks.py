"""Writers. Nothing is published before its problems are known."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.functions.text import clock
from corpusgauge.operators.prepare import shard_by_bytes
from corpusgauge.sources.catalog import move, path_exists, remove

FILES = 256
"""Caption files that one task writes, about."""


def write_relation(df: DataFrame, path: str, mode: str = "errorifexists", level: int = 3) -> None:
    df.write.mode(mode).option("compression", "zstd").option(
        "parquet.compression.codec.zstd.level", level
    ).parquet(path)


def write_payload_shards(
    df: DataFrame, order: list[str], payload: str, path: str, budget: int = 256 << 20
) -> None:
    """Payload rows in shards of about ``budget`` bytes, one directory per shard."""
    packed = shard_by_bytes(df, order, F.col(payload), budget).drop("_bytes")
    spread = packed.repartitionByRange("shard", *order).sortWithinPartitions("shard", *order)
    spread.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def write_records(df: DataFrame, path: str, split: str = "split") -> None:
    """JSON lines, one directory per split."""
    df.write.partitionBy(split).json(path)


def cues(df: DataFrame, start: str, end: str, text: str) -> DataFrame:
    """Adds ``cue``: one caption block per row; blank text makes no cue."""
    said = df.where((F.col(text) != "") & F.col(text).isNotNull())
    block: Column = F.concat(
        clock(F.col(start)), F.lit(" --> "), clock(F.col(end)), F.lit("\n"), text, F.lit("\n")
    )
    return said.withColumn("cue", block)


def write_captions(df: DataFrame, key: str, start: str, end: str, text: str, path: str) -> None:
    """One caption file per key, ``key=.../part-*``: a header, then its cues in start order.

    The cues of a key pass through one writer as a sorted stream, so a key may be longer than any task's memory. A key without a cue gets
    a file with the header only. Equal starts follow end and text."""
    blocks = cues(df, start, end, text).select(key, F.col(start).alias("_start"), F.col(end).alias("_end"), F.col(text).alias("_text"), "cue")
    none = F.lit(None)
    heads = df.select(key).distinct().select(
        key, none.cast(blocks.schema["_start"].dataType).alias("_start"), none.cast(blocks.schema["_end"].dataType).alias("_end"),
        none.cast("string").alias("_text"), F.lit("WEBVTT\n").alias("cue"),
    )
    order = [key, F.asc_nulls_first("_start"), F.asc_nulls_first("_end"), F.asc_nulls_first("_text")]
    # a file costs far more than its bytes, so tasks are dealt by files, and adaptive execution does not merge them by size
    tasks = max(1, -(-heads.count() // FILES))
    placed = heads.union(blocks).repartition(tasks, key).sortWithinPartitions(*order)
    placed.select(key, "cue").write.partitionBy(key).text(path)


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of caption files, whole. The folders are listed by four tasks a core at most: Spark's own choice is a task for each
    folder up to 10,000, which takes longer to start than to run. The session's setting comes back at the end."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")  # lists at once
    finally:
        spark.conf.set(name, before)


class PublishRefused(ValueError):
    """Raised with the number of problems and the first of them; nothing was written."""


def publish(tables: Mapping[str, DataFrame], problems: DataFrame, root: str) -> list[str]:
    """Write every table under ``root``, which must not exist, only if ``problems`` has no row.

    The tables are written beside it, and one rename puts them there together: a table that fails leaves
    nothing under ``root``."""
    n = problems.count()
    if n:
        raise PublishRefused(f"{n} problems, nothing written. First: {[r.asDict() for r in problems.limit(5).collect()]}")
    spark, staged = problems.sparkSession, f"{root.rstrip('/')}.staged-{uuid.uuid4().hex}"
    if path_exists(spark, root):
        raise PublishRefused(f"{root} exists")
    try:
        for name, df in tables.items():
            write_relation(df, f"{staged}/{name}")
        move(spark, staged, root)
    except Exception:
        remove(spark, staged)
        raise
    return [f"{root}/{name}" for name in tables]
