"""Nested to flat and back: shredding, melting, pivoting, nesting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions.ids import sha_id
from corpusgauge.operators.ordering import row_numbers
from corpusgauge.session import cut

# The shape of a generator's run record. Outputs are a map by name.
RUN_RECORD = (
    "edit_models struct<repo_id: string, revision: string>, "
    "edit_runs struct<precision: string, steps: smallint, text_guidance_scale: float, image_guidance_scale: float, "
    "negative_prompt: string, started_utc: string>, "
    "outputs map<string, struct<file: string, prompt: string, seed: bigint>>"
)


def run_relations(runs: DataFrame, run_key: str, record: str, made: DataFrame) -> dict[str, DataFrame]:
    """Run records (JSON text) to the declared relations of edited images, and ``problems``.

    ``made`` has the images: (file, render_id, image). Outputs of a record that share a prompt share a row of
    ``edit_runs``. A record without a resolved revision is a problem row and yields nothing else; so is an
    output whose file is not in ``made``. ``run_outputs`` keeps (run_key, name, edit_id, edit_run_id).

    Sides with a row for each run or output are merged, never broadcast: their columns compress some fifty times, so a
    shuffle that looks small to Spark would fill the driver.
    """
    read = runs.select(F.col(run_key).alias("run_key"), F.from_json(record, RUN_RECORD).alias("r"))
    flat = cut(read.select("run_key", "r.edit_models.*", "r.edit_runs.*", "r.outputs"), "runs")  # parsed once
    revision = F.col("revision").isNotNull() & ~F.lower("revision").isin("", "main", "unresolved")
    resolved = F.coalesce(revision, F.lit(False))
    good = flat.where(resolved).withColumn("negative_prompt", F.coalesce("negative_prompt", F.lit("")))
    each = good.select("*", F.explode("outputs").alias("name", "o")).select("*", "o.*").drop("outputs", "o")
    # models, prompts and runs are numbered together, each kind from 0: one order over their distinct keys
    none = F.lit(None).cast(flat.schema["run_key"].dataType)
    key = lambda df, kind, k0, k1, k2: df.select(F.lit(kind).alias("kind"), k0.alias("k0"), k1.alias("k1"), k2.alias("k2"))
    blank = F.lit("")
    keys = key(good, "model", none, F.col("repo_id"), F.col("revision")).union(key(each, "prompt", none, F.col("prompt"), blank)).union(
        key(each, "prompt", none, F.col("negative_prompt"), blank)).union(key(each, "run", F.col("run_key"), F.col("prompt"), blank))
    ids = cut(row_numbers(keys.where("k1 is not null or kind = 'model'").distinct(), ["k0", "k1", "k2"], "id", ["kind"]), "ids")
    of = lambda kind, id_type, *names: ids.where(F.col("kind") == kind).select(F.col("id").cast(id_type).alias("id"), *[F.col(k).alias(n) for k, n in names])
    models = of("model", "smallint", ("k1", "repo_id"), ("k2", "revision")).withColumnRenamed("id", "edit_model_id")
    prompts = of("prompt", "int", ("k1", "text")).withColumnRenamed("id", "prompt_id")
    asked = prompts.select("prompt_id", F.col("text").alias("prompt"))
    avoided = prompts.select(F.col("prompt_id").alias("negative_prompt_id"), F.col("text").alias("negative_prompt"))
    numbered = of("run", "int", ("k0", "run_key"), ("k1", "prompt")).withColumnRenamed("id", "edit_run_id")
    settings = ["precision", "steps", "text_guidance_scale", "image_guidance_scale", "started_utc"]
    one = each.select("run_key", "repo_id", "revision", "prompt", "negative_prompt", *settings).distinct()
    merged = lambda df: df.hint("merge")
    edit_runs = one.join(merged(numbered), ["run_key", "prompt"]).join(merged(models), ["repo_id", "revision"]).join(merged(asked), "prompt").join(merged(avoided), "negative_prompt").select(
        "edit_run_id", "edit_model_id", "prompt_id", "negative_prompt_id", *settings)
    outputs = each.join(merged(numbered), ["run_key", "prompt"]).join(merged(made), "file", "left")
    outputs = outputs.withColumn("edit_id", sha_id(F.lit("edit"), F.col("run_key"), F.col("name")))
    problem = lambda df, text: df.select("run_key", F.lit(text).alias("problem"))
    return {
        "edit_models": models.select("edit_model_id", "repo_id", "revision"),
        "edit_prompts": prompts,
        "edit_runs": edit_runs,
        "edited_renders": outputs.where("render_id is not null").select("edit_id", "render_id", "edit_run_id", "seed", "image"),
        "run_outputs": outputs.select("run_key", "name", "edit_id", "edit_run_id"),
        "problems": problem(flat.where(~resolved), "revision is not a resolved commit").union(
            problem(outputs.where("render_id is null"), "an output has no image")),
    }


def annotation_document(doc: DataFrame) -> dict[str, DataFrame]:
    """An annotation file (images, annotations, categories, licenses as arrays) to flat relations.

    Categories are keyed by (split, id), and annotation ids come from the data, never a counter. Boxes
    have four numbers. A segmentation is a list of polygons, of which empty ones are left out while the others keep
    their places; one of another kind (a run-length mask) gives no polygons. Area and crowd flag are 0 if absent.
    """
    part = lambda name: doc.select("split", F.explode(name).alias("x")).select("split", "x.*")
    notes = part("annotations").withColumn("ann_id", sha_id(F.col("split"), F.col("id")))
    boxed = notes.where(F.size("bbox") == 4)
    polygons = F.from_json("segmentation", "array<array<double>>")
    drawn = notes.select("ann_id", F.posexplode(polygons).alias("poly_idx", "points"))
    return {
        "images": part("images"),
        "licenses": part("licenses").distinct(),
        "categories": part("categories").select(
            "split", F.col("id").alias("category_id"), "name", F.coalesce("supercategory", F.lit("")).alias("supercategory")
        ).distinct(),
        "annotations": notes.select(
            "ann_id", "split", "image_id", "category_id", "num_keypoints",
            F.coalesce("area", F.lit(0.0)).alias("area"), F.coalesce("iscrowd", F.lit(0)).alias("iscrowd"),
        ),
        "boxes": boxed.select("ann_id", *[F.col("bbox")[i].alias(c) for i, c in enumerate("xywh")]),
        "polygons": drawn.where(F.size("points") > 0),
        "keypoints": triples(notes, ["ann_id"], "keypoints"),
    }


def triples(df: DataFrame, key: Sequence[str], values: str) -> DataFrame:
    """(key, idx, x, y, v) for every complete triple of a flat array."""
    whole = F.floor(F.size(values) / 3).cast("int")
    at = F.when(whole > 0, F.sequence(F.lit(0), whole - 1))
    each = df.select(*key, F.col(values).alias("_v"), F.explode(at).alias("idx"))
    cell = lambda i: F.get("_v", F.col("idx") * 3 + i)
    return each.select(*key, "idx", cell(0).alias("x"), cell(1).alias("y"), cell(2).alias("v"))


def melt(df: DataFrame, key: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metric columns to (key, metric_name, metric_value)."""
    wide = df.select(*key, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(key), list(metrics), "metric_name", "metric_value")


def pivot(long: DataFrame, key: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """(key, one column per name). The names are given, so no extra pass looks for them."""
    cell = lambda n: F.max(F.when(F.col(name) == n, F.col(value))).alias(n)
    return long.groupBy(*key).agg(*[cell(n) for n in names])


def with_default(wide: DataFrame, names: Sequence[str], default: float = 0.0) -> DataFrame:
    """A sparse attribute's absent row means ``default``."""
    return wide.fillna({n: default for n in names})


def nest(scores: DataFrame, root: str, candidate: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(root, candidate columns, scores): one row per root and candidate, with its scores in order.

    The layout is the same whatever the size of a root: its candidates are rows, not one array, so a
    root's size bounds no row, and only one candidate's scores are gathered at a time."""
    wanted = scores.select(*dict.fromkeys([root, *candidate, *order, *fields]))
    score = F.struct(*dict.fromkeys([*order, *fields]))
    per = wanted.groupBy(root, *candidate).agg(F.array_sort(F.collect_list(score)).alias("scores"))
    return per.withColumn("scores", F.transform("scores", lambda s: F.struct(*[s[f].alias(f) for f in fields])))


def with_empty_roots(roots: DataFrame, nested: DataFrame, key: str) -> DataFrame:
    """Roots without candidates keep one row, with NULL as candidate and an empty array of scores."""
    empty = F.from_json(F.lit("[]"), nested.schema["scores"].dataType)
    return roots.join(nested, key, "left").withColumn("scores", F.coalesce("scores", empty))


def tags(df: DataFrame, key: Sequence[str], values: Column) -> DataFrame:
    return df.select(*key, F.explode(values).alias("tag"))


def model_map(df: DataFrame, text: str, entry: str) -> DataFrame:
    """A JSON map of id -> record to (id, record fields)."""
    parsed = F.from_json(text, f"map<string,{entry}>")
    return df.select(F.explode(parsed).alias("model_id", "m")).select("model_id", "m.*")


def concatenate(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Same-shaped tables stacked under a ``stub`` column."""
    out = None
    for stub, df in parts.items():
        tagged = df.withColumn("stub", F.lit(stub))
        out = tagged if out is None else out.unionByName(tagged)
    return out
