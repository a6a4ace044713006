"""A catalogue of models from a large JSON map: models, their files, categories and tags, and the best file of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.operators import shred
from corpusgauge.schemas import MODEL_ENTRY_DDL
from corpusgauge.session import cut
from corpusgauge.sources.jsonmap import read_json_map

RESOLUTIONS = (2048, 1024)
"""Side lengths that a file's name may hold as ``_2048``; the first that occurs counts, else 0."""


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(model_id) of a text file, one a line; blank lines are dropped. A list that is named but missing or empty raises:
    no list and an empty list would otherwise both mean every model."""
    ids = spark.read.text(path).select(F.trim("value").alias("model_id")).where("model_id <> ''").distinct()
    if ids.isEmpty():
        raise ValueError(f"{path} lists no model")
    return ids


def catalogue(
    entries: DataFrame, licenses: Sequence[tuple[str, bool]], rigged_only: bool = False, ids: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The relations of a model map. ``entries`` is what ``read_json_map`` gives; ``licenses`` are the accepted (name, share_alike).

    ``histogram`` counts all models by licence and says which are kept. ``models``, ``files`` (path and resolution, in the order of
    the list), ``categories`` and ``tags`` hold the kept ones, ``best`` the file of highest resolution of each (the first of equals).
    ``problems``: entries that are no model record, ids that occur twice, and NULLs among paths, categories or tags.
    """
    spark = entries.sparkSession
    parsed = cut(entries.select("file", "block", "n", F.from_json("entry", f"map<string,{MODEL_ENTRY_DDL}>").alias("m"), "entry"), "models")
    broken = F.col("m").isNull() | F.exists(F.map_values(F.coalesce("m", F.from_json(F.lit("{}"), f"map<string,{MODEL_ENTRY_DDL}>"))), lambda v: v.isNull())
    every = parsed.where(~broken).select(F.explode("m").alias("model_id", "m")).select("model_id", "m.*")
    ranked = sorted(licenses)
    names = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(ranked)], "license_id int, name string, share_alike boolean")
    license_of = F.coalesce("license", F.lit(""))
    known = F.broadcast(names.select("license_id", F.col("name").alias("_license")))  # the accepted licences, given as literals
    placed = every.join(known, license_of == F.col("_license"), "left")
    histogram = placed.groupBy(license_of.alias("license")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("license_id").isNotNull()).alias("kept"))
    kept = placed.where("license_id is not null")
    if rigged_only:
        kept = kept.where(F.coalesce("isRigged", F.lit(False)))
    if ids is not None:
        kept = kept.join(ids.select("model_id").distinct(), "model_id", "left_semi")
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    models = kept.select(
        "model_id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("user", F.lit("")).alias("user"), "license_id",
        number("vertexCount").alias("vertex_count"), number("faceCount").alias("face_count"), number("max_texture").alias("max_texture"),
        F.coalesce("isRigged", F.lit(False)).alias("is_rigged"), number("animation").alias("animation_count"),
    )
    resolution = F.lit(0)
    for side in reversed(RESOLUTIONS):
        resolution = F.when(F.col("path").contains(f"_{side}"), side).otherwise(resolution)
    files = kept.select("model_id", F.posexplode("glb_paths").alias("ord", "path")).withColumn("resolution", resolution)
    best = files.where("path is not null").groupBy("model_id").agg(F.max_by(F.struct("path", "resolution"), F.struct("resolution", -F.col("ord"))).alias("b"))
    twice = every.groupBy("model_id").count().where("count > 1")
    problem = lambda df, key, text: df.select(F.col(key).alias("subject"), F.lit(text).alias("problem"))
    categories, tags = (shred.tags(kept, ["model_id"], F.col(c)) for c in ("categories", "tags"))
    holes = files.where("path is null").select("model_id").union(categories.union(tags).where("tag is null").select("model_id"))
    return {
        "histogram": histogram, "licenses": names, "models": models, "files": files.where("path is not null"),
        "categories": categories.where("tag is not null").withColumnRenamed("tag", "category"), "tags": tags.where("tag is not null"),
        "best": best.select("model_id", "b.*"),
        "problems": problem(parsed.where(broken), "entry", "is no model record").union(problem(twice, "model_id", "occurs more than once"))
        .union(problem(holes, "model_id", "has a NULL path, category or tag")),
    }


def read_catalogue(spark: SparkSession, path: str, licenses: Sequence[tuple[str, bool]], rigged_only: bool = False, ids_path: str | None = None):
    """``catalogue`` of the map at ``path``, restricted to the ids listed at ``ids_path`` if one is named."""
    ids = None if ids_path is None else id_list(spark, ids_path)
    return catalogue(read_json_map(spark, path), licenses, rigged_only, ids)
