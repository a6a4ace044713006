"""Score tables: port older stubs, validate, and nest for publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge import schemas
from corpusgauge.operators import audit, shred
from corpusgauge.operators.prepare import literal_rows


def checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schema, NULL, vocabulary and key checks of whichever of the five tables are given."""
    spark = next(iter(tables.values())).sparkSession
    n = F.count(F.lit(1)).alias("n")
    rows = []
    for name, df in tables.items():
        wrong = audit.schema_problems(name, df.schema, schemas.struct(schemas.SCORE_DDL[name]))
        rows.append(audit.stated(spark, f"{name} schema", wrong))
        nulls = audit.null_counts(df).agg(F.sum("missing").alias("n"))
        rows.append(audit.check(nulls, f"{name} nulls", F.col("n") == 0, F.col("n")))
        if name != "root" and "root" in tables and "row_key" in df.columns:
            lost = audit.orphans(df, ["row_key"], tables["root"], ["key"]).agg(n)
            rows.append(audit.check(lost, f"{name} row_key joins a root key", F.col("n") == 0, F.col("n")))
    for (name, column), words in schemas.SCORE_VOCABULARIES.items():
        if name in tables and column in tables[name].columns:
            known = literal_rows(spark, [("", w) for w in words], "axis value")
            odd = audit.vocabulary(tables[name], column, known).agg(n, F.min("value").alias("first"))
            rows.append(audit.check(odd, f"{name}.{column} vocabulary", F.col("n") == 0, F.col("first")))
    if "candidates" in tables:
        known = literal_rows(spark, [(a, k) for a, ks in schemas.KINDS_BY_AXIS.items() for k in ks], "axis value")
        odd = audit.vocabulary(tables["candidates"], "candidate_kind", known, axis="candidate_axis")
        odd = odd.agg(n, F.min("value").alias("first"))
        rows.append(audit.check(odd, "candidates.candidate_kind by axis", F.col("n") == 0, F.col("first")))
    return audit.union_all(rows)


def port(
    root: DataFrame, candidates: DataFrame, scores: DataFrame, task_type: str, dimension: str,
    input_kind: str, candidate_kind: str, extra: str, metrics: Sequence[str] = ("depth_l1", "normal_l1", "normal_dot"),
) -> dict[str, DataFrame]:
    """An older stub (wide metrics, candidate names) to the score tables.

    A candidate's rank is looked up within its own root: the same name may rank differently elsewhere.
    """
    new_root = root.select(
        "key", F.lit(task_type).alias("task_type"), F.lit(dimension).alias("dimension"), "input_column",
        "input_asset", F.lit(input_kind).alias("input_asset_kind"),
    )
    extras = root.select(
        F.col("key").alias("row_key"), F.lit(extra).alias("extra_name"), F.col(extra).cast("string").alias("extra_value"),
        F.lit("json_path").alias("extra_kind"),
    )
    new_candidates = candidates.select(
        "row_key", F.lit("edit").alias("candidate_axis"), F.col("rank").cast("int").alias("rank"), "candidate_asset",
        F.lit(candidate_kind).alias("candidate_asset_kind"), F.col("candidate").alias("candidate_kind"),
    )
    ranks = candidates.select("row_key", "candidate", F.col("rank").cast("int").alias("candidate_rank"))
    ranked = scores.join(ranks, ["row_key", "candidate"])
    ranked = ranked.withColumn("view_index", F.col("view_index").cast("int"))
    long = shred.melt(ranked, ["row_key", "candidate_rank", "view_index"], metrics)
    new_scores = long.select("row_key", F.lit("edit").alias("candidate_axis"), "candidate_rank", "view_index",
                             "metric_name", "metric_value")
    return {"root": new_root, "candidates": new_candidates, "scores": new_scores, "root_extras": extras}


def nested(
    root: DataFrame, candidates: DataFrame, scores: DataFrame,
    candidate_key: Sequence[str] = ("row_key", "candidate"), score_key: Sequence[str] = ("row_key", "candidate"),
) -> tuple[DataFrame, DataFrame]:
    """(wide, problems): a row per root and candidate with its scores, and the key check rows.

    ``problems`` must be empty before ``wide`` is published.
    """
    n = F.count(F.lit(1)).alias("n")
    keys = audit.key_set_difference(root, ["key"], candidates, ["row_key"])
    lost = audit.orphans(scores, list(score_key), candidates, list(candidate_key)).agg(n)
    twice = audit.duplicates(candidates, list(candidate_key))
    rows = audit.union_all([
        audit.check(keys, "root keys equal candidate keys", (F.col("only_left") == 0) & (F.col("only_right") == 0),
                    F.concat_ws("/", "only_left", "only_right", "in_both")),
        audit.check(lost, "scores join a candidate", F.col("n") == 0, F.col("n")),
        audit.check(twice, "candidate keys are unique", F.col("duplicates") == 0, F.col("duplicates")),
    ])
    fields = [c for c in scores.columns if c not in score_key]
    named = scores.select(*[F.col(s).alias(c) for s, c in zip(score_key, candidate_key)], *fields)
    order = [c for c in candidate_key if c != "row_key"]
    inner = order + [c for c in candidates.columns if c not in candidate_key]
    every = candidates.join(named, list(candidate_key), "left").withColumnRenamed("row_key", "key")
    packed = shred.nest(every, "key", inner, fields, fields)
    # a candidate without scores keeps an empty array
    scored = F.filter("scores", lambda s: s.getField(fields[0]).isNotNull())
    wide = shred.with_empty_roots(root, packed.withColumn("scores", scored), "key")
    return wide, rows.where("state <> 'PASS'")
