"""The whole integrity audit of a corpus root, as one table of checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge import schemas
from corpusgauge.operators import audit
from corpusgauge.sources.catalog import Catalog, catalog


def load(spark: SparkSession, root: str, strict: bool = True, rename: Mapping[str, Mapping[str, str]] | None = None) -> Catalog:
    """Every declared relation under ``root``."""
    return catalog(spark, root, schemas.RELATION_DDL, strict, rename)


def checks(found: Catalog, extended: bool = False) -> DataFrame:
    """One row per check. A check whose relations are absent is a FAIL of the presence check, and
    the provenance check fails outright when the runs are missing."""
    tables, spark = found.tables, found.spark
    rows = [audit.stated(spark, "relations and columns as declared", found.problems)]
    n = F.count(F.lit(1)).alias("n")
    for name, df in tables.items():
        nulls = audit.null_counts(df)
        worst = nulls.where("missing > 0").agg(
            F.count(F.lit(1)).alias("n"),
            F.concat_ws(", ", F.sort_array(F.collect_list(F.concat_ws(": ", "column", "missing")))).alias("detail"),
        )
        rows.append(audit.check(worst, f"nulls violating the schema: {name}", F.col("n") == 0, F.col("detail")))
    edges = schemas.FOREIGN_KEYS + (schemas.EXTENDED_KEYS if extended else [])
    present = lambda t, k: t in tables and k in tables[t].columns
    usable = [e for e in edges if present(e[0], e[1]) and present(e[2], e[3])]
    if usable:
        lost = audit.foreign_keys(tables, usable)
        rows.append(lost.select(
            F.replace("edge", F.lit(" -> "), F.lit(" absent from ")).alias("name"),
            F.when(F.col("missing") == 0, "PASS").otherwise("FAIL").alias("state"),
            F.col("missing").cast("string").alias("detail"), F.lit(True).alias("fatal"),
        ))
    if {"scenes", "identities"} <= tables.keys():
        apart = audit.parent_agreement(
            tables["scenes"], "identity_id", "split", tables["identities"], "identity_id", "split"
        ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        rows.append(audit.check(apart, "scene split disagrees with its identity", F.col("n") == 0, F.col("n")))
    if "identities" in tables:
        mixed = audit.contamination(tables["identities"], "source_subject", "split").agg(n)
        rows.append(audit.check(mixed, "CONTAMINATION: subjects span splits", F.col("n") == 0, F.col("n")))
    if {"render_data", "edited_renders"} <= tables.keys():
        both = audit.shared_keys(tables["render_data"], "render_id", tables["edited_renders"], "edit_id").agg(n)
        rows.append(audit.check(both, "POOL MERGE: edit ids in render_data", F.col("n") == 0, F.col("n")))
    if "edited_renders" in tables:
        if "edit_runs" not in tables:
            rows.append(audit.stated(spark, "edited_renders present with no edit_runs relation", ["precision cannot be established"]))
        else:
            by = audit.eligibility(tables["edited_renders"], "edit_run_id", tables["edit_runs"], "edit_run_id", "precision")
            of = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).alias(s)
            split = by.agg(of("ineligible"), of("unknown"))
            rows.append(audit.check_each(split, [
                ("NOT CORPUS DATA: rows of a quantised run", F.col("ineligible") == 0, F.col("ineligible")),
                ("edited rows whose run precision is unknown", F.col("unknown") == 0, F.col("unknown")),
            ]))
    return audit.union_all(rows)


def validate(
    spark: SparkSession, root: str, strict: bool = True, extended: bool = False,
    rename: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Checks of the corpus at ``root``; no FAIL row means clean."""
    return checks(load(spark, root, strict, rename), extended)


def problems(rows: DataFrame) -> DataFrame:
    """What blocks: fatal failures only."""
    return rows.where((F.col("state") == "FAIL") & F.col("fatal"))
