"""The semantic audit of an identity table: values, audit power, body plausibility, coverage, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators import audit, shred, stats
from corpusgauge.operators.generate import PHENOTYPES
from corpusgauge.operators.ordering import exact_percentiles
from corpusgauge.operators.prepare import literal_rows

# Published adult mean statures in metres, (region, male, female).
STATURE_REFERENCES = (
    ("EU-tall(NL)", 1.84, 1.70), ("EU-mid(IT/ES)", 1.76, 1.63), ("US", 1.77, 1.63),
    ("Oceania(AU/NZ)", 1.79, 1.66), ("Japan", 1.72, 1.58),
)
ADULT_AGE, CHILD_AGE = 0.55, 0.25
MALE_BELOW, FEMALE_ABOVE = 0.35, 0.65


def wide_attributes(values: DataFrame, names: DataFrame, wanted=PHENOTYPES) -> DataFrame:
    """(identity_id, one column per attribute) from the long table and its vocabulary."""
    named = values.join(names, "phenotype_id")
    return shred.pivot(named, ["identity_id"], "name", "value", wanted)


def checks(
    identities: DataFrame, phenotypes: DataFrame, values: DataFrame, boxes: DataFrame,
    coverage_ppm: float = 1000.0, decoded: int | None = None,
) -> DataFrame:
    """Check rows. ``boxes(identity_id, extent_x, extent_y, extent_z, lo_x, hi_x)`` holds the decoded
    bounding box of each identity; the body model itself is not part of this library."""
    wide = wide_attributes(values, phenotypes)
    n = F.count(F.lit(1))
    rows = []
    spread = audit.value_range(wide, list(PHENOTYPES), 0.0, 1.0).agg(
        F.sum("not_finite").alias("bad"), F.sum(F.col("outside") - F.col("not_finite")).alias("out"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    rows.append(audit.check_each(spread, [
        ("no NaN/Inf in attribute values", F.col("bad") == 0, F.col("bad")),
        ("attributes within [0,1]", F.col("out") == 0, F.format_string("min %.3f max %.3f", "low", "high")),
    ]))
    dups = audit.duplicates(identities, ["identity_id"])
    rows.append(audit.check(dups, "identity_id unique", F.col("duplicates") == 0, F.col("duplicates")))
    long = values.join(phenotypes, "phenotype_id").select("name", "value")
    flat = audit.few_values(long, "name", "value").agg(F.count_if("collapsed").alias("n"))
    rows.append(audit.check(flat, "no collapsed dimension", F.col("n") == 0, F.col("n")))

    total = identities.agg(n.alias("total")).withColumn("used", F.lit(decoded).cast("long") if decoded else F.col("total"))
    floor = audit.detection_floor(F.col("used"), F.col("total"))
    rows.append(audit.check(total, "run can catch defects at the stated rate", floor <= coverage_ppm,
                            F.format_string("floor is %.0f ppm", floor)))

    body = boxes.join(wide.select("identity_id", "gender", "age"), "identity_id")
    axes = [f"extent_{c}" for c in "xyz"]
    mean = body.agg(*[F.avg(c).alias(c) for c in axes], F.avg(F.abs(F.col("lo_x") + F.col("hi_x"))).alias("off"))
    up = F.array_position(F.array(*axes), F.greatest(*axes)) - 1
    rows.append(audit.check_each(mean, [
        ("up axis is Z (index 2)", up == 2, up),
        ("rest pose is left/right symmetric", F.col("off") < 0.05, F.col("off")),
    ]))

    adult, child = F.col("age") > ADULT_AGE, F.col("age") < CHILD_AGE
    kinds = F.array_compact(F.array(
        F.lit("all"), F.when(adult, "adult"), F.when(child, "child"),
        F.when(adult & (F.col("gender") < MALE_BELOW), "male"), F.when(adult & (F.col("gender") > FEMALE_ABOVE), "female"),
    ))
    # all subgroups and all percentiles in one ordered pass
    grouped = body.select(F.explode(kinds).alias("grp"), F.col("extent_z").alias("stature"))
    q = exact_percentiles(grouped, "stature", [0.05, 0.5, 0.95], ["grp"])
    cell = lambda g, p: F.max(F.when((F.col("grp") == g) & (F.col("p") == p), F.col("q")))
    size = lambda g: F.coalesce(F.max(F.when(F.col("grp") == g, F.col("n"))), F.lit(0))
    groups = ("all", "adult", "child", "male", "female")
    one = q.agg(
        *[size(g).alias(f"n_{g}") for g in groups],
        *[cell(g, p).alias(f"{g}_{name}") for g in groups for p, name in ((0.05, "p05"), (0.5, "p50"), (0.95, "p95"))],
    )
    c = F.col
    gap = c("male_p50") - c("female_p50")
    both = (c("n_male") > 20) & (c("n_female") > 20)
    rows.append(audit.check_each(one, [
        ("stature is in metres", (c("all_p50") > 0.4) & (c("all_p50") < 2.5), c("all_p50")),
        ("sex subgroups present", both, F.concat_ws("/", "n_male", "n_female")),
        ("male median stature > female", both & (gap > 0), gap),
        ("dimorphism magnitude plausible", both & (gap > 0.05) & (gap < 0.20), gap),
        ("adult stature band", (c("n_adult") > 20) & (c("adult_p05") > 1.35) & (c("adult_p95") < 2.05),
         F.concat_ws("..", "adult_p05", "adult_p95")),
        ("child subgroup present", c("n_child") > 10, c("n_child")),
        ("children shorter than adults", (c("n_child") > 10) & (c("child_p50") < c("adult_p50")), c("child_p50")),
    ]))
    spark = identities.sparkSession
    refs = literal_rows(spark, [(g, r, v) for r, m, f in STATURE_REFERENCES for g, v in (("male", m), ("female", f))], "grp name value")
    bands = q.groupBy("grp").agg(
        F.max(F.when(c("p") == 0.05, c("q"))).alias("p05"), F.max(F.when(c("p") == 0.95, c("q"))).alias("p95"))
    covered = stats.coverage(bands, "grp", refs).groupBy("name").agg(F.bool_and("covered").alias("ok"))
    missed = covered.agg(F.count_if(~c("ok")).alias("n"), F.concat_ws(", ", F.sort_array(F.collect_list(F.when(~c("ok"), c("name"))))).alias("detail"))
    rows.append(audit.check(missed, "target populations covered", c("n") == 0, c("detail")))
    val = identities.agg(F.count_if(c("split") == "val").alias("v"), n.alias("n"))
    rows.append(audit.check(val, "val split is non-empty and small", (c("v") > 0) & (c("v") < 0.2 * c("n")), c("v")))
    mixed = audit.contamination(identities, "source_subject", "split").agg(n.alias("n"))
    rows.append(audit.check(mixed, "subjects stay in one split", c("n") == 0, c("n")))
    return audit.union_all(rows)
