"""Annotation files to a fetch list: licence filter, classification, holdout gate, all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge import schemas
from corpusgauge.operators import prepare
from corpusgauge.operators.audit import union_all
from corpusgauge.sources.sinks import publish


def commercial_images(relations: dict[str, DataFrame], min_keypoints: int = 8) -> dict[str, DataFrame]:
    """Images under an allowed licence that show someone with enough labelled keypoints."""
    licences = relations["licenses"].where(F.col("name").isin(*schemas.COMMERCIAL_LICENSES)).select(
        F.col("id").alias("license_id"), "name", "url", F.col("name").isin(*schemas.SHARE_ALIKE).alias("share_alike")
    ).distinct()
    images = relations["images"].withColumnsRenamed({"id": "image_id", "license": "license_id"})
    allowed = images.join(licences.select("license_id").distinct(), "license_id", "left_semi")
    people = relations["annotations"].withColumn("kp", F.coalesce("num_keypoints", F.lit(0)))
    kept = prepare.keep_by_child(allowed, "image_id", people, "image_id", "kp", min_keypoints)
    return {
        "licenses": licences,
        "images": kept.select("image_id", "file_name", "coco_url", "flickr_url", "width", "height", "license_id"),
        "person_observations": kept.select(
            "image_id", F.col("n_children").alias("num_persons"), F.col("best").alias("max_num_keypoints")),
    }


def classify(images: DataFrame, licences: DataFrame, holdout: DataFrame) -> DataFrame:
    """``images`` with a ``disposition``: null, holdout, share_alike or keep; the first that holds."""
    held = holdout.select("image_id").distinct().withColumn("_held", F.lit(True))
    shared = licences.where(F.col("name").isin(*schemas.SHARE_ALIKE)).select("license_id").distinct().withColumn("_sa", F.lit(True))
    blank = None
    for c in schemas.FETCH_LIST:
        blank = F.col(c).isNull() if blank is None else blank | F.col(c).isNull()
    marked = images.join(held, "image_id", "left").join(shared, "license_id", "left")
    word = prepare.first_match([("null", blank), ("holdout", F.col("_held")), ("share_alike", F.col("_sa"))], "keep")
    return marked.withColumn("disposition", word).drop("_held", "_sa")


def problems(images: DataFrame, licences: DataFrame, holdout: DataFrame, classified: DataFrame) -> DataFrame:
    """(problem, n) rows; the list may be written only if there is none."""
    n = F.count(F.lit(1)).alias("n")
    by = classified.groupBy("disposition").agg(n)
    told = lambda d, text: by.where(F.col("disposition") == d).select(F.lit(text).alias("problem"), "n")
    shared = licences.agg(F.count_if(F.col("name").isin(*schemas.SHARE_ALIKE)).alias("n"))
    kept = classified.where("disposition = 'keep'").select("image_id", "license_id")
    leaked = kept.join(holdout.select("image_id").distinct(), "image_id", "left_semi").agg(n)
    alike = licences.where(F.col("name").isin(*schemas.SHARE_ALIKE)).select("license_id").distinct()
    shared_left = kept.join(alike, "license_id", "left_semi").agg(n)
    seen, given = by.agg(F.sum("n")).scalar(), images.agg(n).scalar()
    closure = images.sparkSession.range(1).select((F.coalesce(given, F.lit(0)) - F.coalesce(seen, F.lit(0))).alias("n"))
    rows = [
        shared.where("n = 0").select(F.lit("none of the licences is share-alike, so the licence filter cannot have worked").alias("problem"), "n"),
        told("holdout", "holdout images among the images to fetch"),
        told("null", "images with a required field missing"),
        leaked.where("n > 0").select(F.lit("holdout images in the finished list").alias("problem"), "n"),
        shared_left.where("n > 0").select(F.lit("share-alike images in the finished list").alias("problem"), "n"),
        closure.where("n <> 0").select(F.lit("dispositions do not add up to the images given").alias("problem"), "n"),
    ]
    return union_all(rows)


def build(images: DataFrame, licences: DataFrame, holdout: DataFrame, root: str) -> list[str]:
    """Write ``root/fetch_list`` and return its path, or refuse and write nothing."""
    classified = classify(images, licences, holdout)
    kept = classified.where("disposition = 'keep'").select(*schemas.FETCH_LIST)
    return publish({"fetch_list": kept}, problems(images, licences, holdout, classified), root)


def split_payloads(fetched: DataFrame, payload: str = "image", magic: bytes = b"\xff\xd8\xff") -> tuple[DataFrame, DataFrame]:
    """(ok, failures): rows whose payload starts as declared, and the others with a reason."""
    starts = F.coalesce(F.startswith(payload, F.lit(magic)), F.lit(False))
    bad = fetched.where(~starts)
    return fetched.where(starts), bad.drop(payload).withColumn("reason", F.lit("payload is not of the declared type"))
