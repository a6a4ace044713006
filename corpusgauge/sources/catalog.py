"""Relations under a corpus root: one parquet file, or a directory of shards, per relation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgauge.operators.audit import schema_problems, union_all


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks whichever file system the path belongs to."""
    system, at = _file_system(spark, path)
    return system.exists(at)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system."""
    system, at = _file_system(spark, source)
    if not system.rename(at, _file_system(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, at = _file_system(spark, path)
    system.delete(at, True)


@dataclass
class Catalog:
    """Loaded relations, and what is wrong with their presence or their columns."""

    spark: SparkSession
    wanted: Mapping[str, T.StructType]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    problems: list[str] = field(default_factory=list)

    def summary(self) -> DataFrame:
        rows = []
        for name, schema in self.wanted.items():
            have = self.tables.get(name)
            counted = (
                have.agg(F.count(F.lit(1)).alias("n_rows")) if have is not None
                else self.spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
            )
            rows.append(counted.select(
                F.lit(name).alias("relation"), F.lit(len(schema)).alias("declared_columns"),
                "n_rows", F.lit(have is not None).alias("present"),
            ))
        return union_all(rows)


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def catalog(
    spark: SparkSession, root: str, wanted: Mapping[str, T.StructType | str], strict: bool = True,
    rename: Mapping[str, Mapping[str, str]] | None = None,
) -> Catalog:
    """Load ``<root>/<name>.parquet`` or the shard directory ``<root>/<name>``.

    Sharded relations are audited like the others. ``strict`` also reports unexpected and
    mistyped columns; otherwise only missing ones are reported. ``rename`` maps, per relation, a
    column's stored name to its declared one.
    """
    out = Catalog(spark, {n: as_schema(s) for n, s in wanted.items()})
    for name, schema in out.wanted.items():
        choices = [f"{root}/{name}.parquet", f"{root}/{name}"]
        found = next((p for p in choices if path_exists(spark, p)), None)
        if found is None:
            out.problems.append(f"missing relation: {name}")
            continue
        df = spark.read.parquet(found).withColumnsRenamed(dict((rename or {}).get(name, {})))
        out.tables[name] = df
        found_problems = schema_problems(name, df.schema, schema)
        out.problems += [p for p in found_problems if strict or "missing column" in p]
    return out
