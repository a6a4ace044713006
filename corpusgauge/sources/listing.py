"""Files and lists: what lies under a root, and the small text files that steer a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.schemas import ANNOTATION_DDL, struct
from corpusgauge.sources.catalog import path_exists


def list_files(spark: SparkSession, root: str, depth: int | None = None) -> DataFrame:
    """(path, bytes) of all files below ``root``, or of those at most ``depth`` folders below it where a
    depth is given. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.regexp_replace(F.col("path"), F.lit(r"^[a-z0-9]+:/*"), F.lit("/"))
    deep = F.size(F.split(below, "/")) - len([p for p in root.split("://")[-1].split("/") if p]) - 1
    kept = files if depth is None else files.where(deep <= depth)
    return kept.select(below.alias("path"), F.col("length").alias("bytes"))


def libraries(files: DataFrame, suffixes: Sequence[str], marker: str = ".cff") -> DataFrame:
    """(path, owner): asset files with the nearest folder above them that holds a ``marker`` file."""
    from corpusgauge.operators.prepare import nearest_owner

    folder = F.regexp_replace("path", "/[^/]*$", "")
    ending = F.concat(F.lit("."), F.regexp_extract("path", r"\.([^./]+)$", 1))
    assets = files.where(ending.isin(*suffixes)).select("path", folder.alias("folder"))
    marked = files.where(F.endswith("path", F.lit(marker))).select(folder.alias("marked"))
    return nearest_owner(assets, "folder", marked, "marked").select("path", "owner")


def steering_lines(spark: SparkSession, tracked: str, local: str | None = None) -> DataFrame:
    """(line): non-blank lines with comments cut off. A local file replaces the tracked one; when
    neither exists the job fails rather than running unsteered."""
    chosen = local if local and path_exists(spark, local) else tracked
    if not path_exists(spark, chosen):
        raise FileNotFoundError(f"no such list: {chosen}")
    lines = spark.read.text(chosen).select(F.trim(F.substring_index("value", "#", 1)).alias("line"))
    return lines.where("line <> ''")


def read_annotations(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per annotation file, with its split. Each file is one document, so one task reads it."""
    out = None
    for split, path in paths.items():
        doc = spark.read.schema(struct(ANNOTATION_DDL)).option("multiLine", "true").json(path)
        doc = doc.withColumn("split", F.lit(split))
        out = doc if out is None else out.unionByName(doc)
    return out
