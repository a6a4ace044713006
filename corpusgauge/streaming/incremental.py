"""Resumable appends, and the same gate run continuously over arriving shards."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusgauge.operators.prepare import first_match
from corpusgauge.sources.catalog import path_exists
from corpusgauge.streaming.keys import KeyIndex


def append_new(df: DataFrame, key: Sequence[str], path: str) -> None:
    """Append the rows whose key the relation does not hold yet. Running it twice changes nothing."""
    others = [c for c in df.columns if c not in key]
    # of rows that share a key, the least
    fresh = df.groupBy(*key).agg(F.min(F.struct(*others)).alias("_row")).select(*key, "_row.*").select(df.columns)
    if path_exists(df.sparkSession, path):
        held = df.sparkSession.read.schema(df.schema).parquet(path).select(*key).distinct()
        fresh = fresh.join(held, list(key), "left_anti")
    fresh.write.mode("append").option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", per_batch: int = 1) -> DataFrame:
    """A stream over the parquet shards that arrive in ``folder``."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch).parquet(folder)
    )


def judge(batch: DataFrame, rules: Sequence[tuple[str, Column]], key: Sequence[str], held: DataFrame | None) -> DataFrame:
    """The batch with ``problem``: the first rule a row breaks, or a key that is already committed
    or repeated. Repeats are settled by an aggregate on the key, never by a window over it."""
    judged = batch.withColumn("problem", first_match(rules))
    columns = [c for c in judged.columns if c not in key]
    counted = judged.groupBy(*key).agg(
        F.min(F.struct(F.col("problem").isNotNull().alias("_bad"), *columns)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    flat = counted.select(*key, *[F.col(f"_row.{c}").alias(c) for c in columns], (F.col("_n") - 1).alias("repeats"))
    if held is not None:
        flat = flat.join(held.select(*key, F.lit(True).alias("_held")).distinct(), list(key), "left")
        again = F.when(F.col("_held"), F.lit("already committed"))
        flat = flat.withColumn("problem", F.coalesce("problem", again)).drop("_held")
    return flat


def gate_stream(
    stream: DataFrame, rules: Sequence[tuple[str, Column]], key: Sequence[str], root: str,
) -> StreamingQuery:
    """Audit each micro-batch; rows that pass land in ``root/accepted``, the others in
    ``root/quarantine`` with their problem.

    Each batch owns one directory and overwrites it, so a replayed batch leaves the same files. Keys
    accepted by earlier batches are looked up in an index of them (``keys.KeyIndex``) that opens only the
    parts that may hold a key of the batch; they are not kept as stream state.
    """
    accepted, quarantine = f"{root}/accepted", f"{root}/quarantine"

    index = KeyIndex(stream.sparkSession, f"{root}/index", key)

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        judged = judge(df, rules, key, index.held(df, batch_id)).persist()
        good = judged.where("problem is null").drop("problem")
        good.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
        judged.where("problem is not null").write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        index.add(good, batch_id)
        judged.unpersist()
        df.unpersist()

    return (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )


def log_stream(measurements: DataFrame, key: Sequence[str], event_time: str, delay: str, root: str) -> StreamingQuery:
    """Append-only measurement log: each finished batch is durable in ``root/log`` before the next begins.

    A key is logged once for ever, whatever the times of its rows; logged keys are looked up in an index. Rows that come
    later than ``delay`` after the newest time of the batches before are not dropped: they go to ``root/late``, as they are. A row without a time
    is never late. Of rows of one batch that share a key, the least is logged.
    """
    log, late, newest = f"{root}/log", f"{root}/late", f"{root}/newest"
    others = [c for c in measurements.columns if c not in key]

    index = KeyIndex(measurements.sparkSession, f"{root}/index", key)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df = df.persist()
        seen = spark.read.parquet(f"{newest}/batch={batch_id - 1}").first()[0] if batch_id else None
        in_time = df
        if seen is not None:
            oldest = F.lit(seen) - F.expr(f"interval {delay}")
            df.where(F.col(event_time) < oldest).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            in_time = df.where(F.col(event_time).isNull() | (F.col(event_time) >= oldest))
        fresh = in_time.groupBy(*key).agg(F.min(F.struct(*others)).alias("_row")).select(*key, "_row.*").select(df.columns)
        held = index.held(in_time, batch_id)
        if held is not None:
            again = held.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
            same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
            fresh = fresh.join(again, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        index.add(spark.read.schema(df.schema).parquet(f"{log}/batch={batch_id}"), batch_id)
        top = df.agg(F.max(event_time).alias("newest"))
        top = top.select(F.greatest("newest", F.lit(seen).cast(df.schema[event_time].dataType)).alias("newest"))
        top.write.mode("overwrite").parquet(f"{newest}/batch={batch_id}")
        df.unpersist()

    return (
        measurements.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )


def finished(query: StreamingQuery, then: Callable[[], DataFrame]) -> DataFrame:
    """Wait for an available-now query, raise what it raised, then read its result."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return then()
