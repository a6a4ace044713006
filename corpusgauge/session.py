"""Session defaults, and the one place where a lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "corpusgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. Keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster an executor
    that is lost takes its own disk with it, so an unset folder is an error there.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="spark-")
    return _local_folder


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result must be identical for several readers (range-partition numbers are not
    stable between two evaluations) and to stop iterative plans from growing.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


PER_TASK = 1 << 18
"""Rows that ``dealt`` gives a task."""


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by hash of ``keys``, over as many tasks as ``rows`` ask for: what one task gathers does not grow with the table, whatever
    the session's shuffle partitions are."""
    return df.repartition(max(1, -(-rows // PER_TASK)), *keys)
