"""Generated tables: identities, candidates, scenes, cameras, ramps. All keyed and repeatable."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions import geometry
from corpusgauge.functions.ids import hash_split, sha_id, uniform
from corpusgauge.operators.ordering import ring_next, row_numbers

# Identity attributes.
PHENOTYPES = ("gender", "age", "muscle", "weight", "height", "proportions")


def with_rows(df: DataFrame, rows: Sequence[tuple], names: str) -> DataFrame:
    """Every row of ``df`` beside every row of a fixed table, without a join."""
    columns = names.split()
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(columns, r)]) for r in rows]
    return df.select("*", F.inline(F.array(*structs)))


def ramp(df: DataFrame, key: Sequence[str], start: str, end: str, frames: str) -> DataFrame:
    """(key, frame, value): a straight line over each row's own number of frames."""
    each = df.select("*", F.explode(F.sequence(F.lit(0), F.col(frames) - 1)).alias("frame"))
    t = F.when(F.col(frames) > 1, F.col("frame") / F.nullif(F.col(frames) - 1, F.lit(0))).otherwise(0.0)
    return each.select(*key, "frame", (F.col(start) + (F.col(end) - F.col(start)) * t).alias("value"))


def identities(df: DataFrame, key: Column, subject: Column, val_fraction: float = 0.02) -> DataFrame:
    """Identity id, own seed, subject and split; the split follows the subject."""
    return df.select(
        sha_id(F.lit("identity"), key).alias("identity_id"), sha_id(F.lit("seed"), key).alias("seed"),
        subject.alias("source_subject"),
        hash_split(sha_id(F.lit("subject"), subject), val_fraction).alias("split"),
    )


def attributes(ids: DataFrame, names: Sequence[str] = PHENOTYPES) -> DataFrame:
    """Long attributes with a hash-fixed value in [0, 1)."""
    each = with_rows(ids, [(i, n) for i, n in enumerate(names)], "phenotype_id name")
    return each.withColumn("value", uniform(F.lit("phenotype"), F.col("seed"), F.col("phenotype_id")))


def graded_candidates(
    subjects: DataFrame, subject: str, edits: Sequence[tuple], grades: Sequence[tuple],
) -> DataFrame:
    """Graded candidates of every subject and edit. A wrong part that no edit names is a problem.

    ``edits``: (edit, kind, parameter, amount, wrong part). ``grades``: (rank, scale, error), the error one
    of none, part and subject. A candidate moves the parameter of its part by amount times scale.
    """
    by_name = {e[0]: e for e in edits}
    rows = []
    for edit, *_, wrong in edits:
        for rank, scale, error in grades:
            part = wrong if error == "part" else edit
            _, kind, parameter, amount, _ = by_name.get(part, (None, None, None, None, None))
            moved = None if amount is None else float(amount) * scale
            rows.append((edit, rank, part, kind, parameter, moved, float(scale), error == "subject", part not in by_name))
    names = "edit rank target target_kind parameter amount scale wrong_subject problem"
    typed = with_rows(subjects.select(subject), rows, names)
    return typed.withColumns({c: F.col(c).cast(k) for c, k in (("target_kind", "string"), ("parameter", "string"), ("amount", "double"))})


def voice_candidates(
    clips: DataFrame, clip: Sequence[str], text: str, ranks: Sequence[tuple], fixed_text: str,
    pool: DataFrame | None = None, voice: str | None = None,
) -> DataFrame:
    """Candidates of each clip with the text each must say and the voice that says it.

    ``ranks``: (rank, kind, severity, pitch, tempo, voice source, text source). A voice is ``self`` or
    from the ``pool``; a text is the clip's own (``self``), that of the ``next`` clip, or ``fixed``. Only the next
    clip's key is carried along the order; its text is joined.
    """
    key = F.struct(*clip)
    placed = ring_next(clips.select(*clip), list(clip), key, "_next")
    numbered = row_numbers(placed, list(clip), "_i")
    if pool is not None:
        voices = row_numbers(pool.select(F.col(voice).alias("_voice")).distinct(), ["_voice"], "_slot")
        n = voices.agg(F.count(F.lit(1))).scalar()
        numbered = numbered.withColumn("_slot", F.pmod(F.col("_i"), n)).join(voices, "_slot")
    else:
        numbered = numbered.withColumn("_voice", F.lit(None).cast("string"))
    texts = clips.select(*clip, F.col(text).alias("_own"))
    after = clips.select(key.alias("_next"), F.col(text).alias("_said_next"))
    full = numbered.join(texts, list(clip)).join(after, "_next")
    each = with_rows(full, ranks, "rank kind severity pitch tempo voice_source text_source")
    said = (
        F.when(F.col("text_source") == "next", F.col("_said_next"))
        .when(F.col("text_source") == "fixed", F.lit(fixed_text))
        .otherwise(F.col("_own"))
    )
    own = F.when(F.col("voice_source") == "pool", F.col("_voice").cast("string")).otherwise("self")
    return each.select(*clip, "rank", "kind", "severity", "pitch", "tempo", own.alias("voice"), said.alias("target_text"))


def scenes(ids: DataFrame, n_poses: int | Column, n_environments: int | Column) -> DataFrame:
    """One scene per identity, with pose and environment chosen by hash: never the full product."""
    pick = lambda what, n: F.pmod(sha_id(F.lit(what), F.col("identity_id")), n if isinstance(n, Column) else F.lit(n))
    return ids.select(
        sha_id(F.lit("scene"), F.col("identity_id")).alias("scene_id"), "identity_id",
        pick("pose", n_poses).alias("pose_id"), pick("environment", n_environments).alias("env_id"), "split",
    )


def grid_cameras(df: DataFrame, key: str, fov_deg: float = 40.0) -> DataFrame:
    """The enumerated camera grid beside every row: 8 azimuths, 4 elevations, 3 distances."""
    rows = [(float(a), float(e), d) for e in geometry.GRID_ELEVATIONS for d in geometry.GRID_DISTANCES
            for a in geometry.GRID_AZIMUTHS]
    each = with_rows(df.select(key), [(i, *r) for i, r in enumerate(rows)], "camera azimuth elevation distance")
    radius = geometry.camera_radius(fov_deg, F.col("distance"))
    x, y, z = geometry.camera_eye(F.radians("azimuth"), F.radians("elevation"), radius)
    return each.select("*", radius.alias("radius"), x.alias("x"), y.alias("y"), z.alias("z"))


def sphere_cameras(df: DataFrame, key: str, views: str, fov_deg: float = 40.0) -> DataFrame:
    """Each row's own number of cameras from the low-discrepancy sphere sequence."""
    each = df.select(key, views, F.explode(F.sequence(F.lit(0), F.col(views) - 1)).alias("view_index"))
    yaw, pitch = geometry.sphere_point(F.col("view_index"), F.col(views))
    x, y, z = geometry.camera_eye(yaw, pitch, geometry.camera_radius(fov_deg))
    turn = 180.0 / math.pi
    return each.select(key, "view_index", (yaw * turn).alias("yaw"), (pitch * turn).alias("pitch"),
                       x.alias("x"), y.alias("y"), z.alias("z"))
