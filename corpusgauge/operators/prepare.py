"""Filtering, classification and gates that decide which rows enter a corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.operators.ordering import row_numbers, running_total

def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: str) -> DataFrame:
    """A small constant table built inside the plan, without starting a Python worker."""
    columns = names.split()
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(columns, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def first_match(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """Name of the first rule that holds. Rules are exclusive by construction."""
    out = F.lit(otherwise) if otherwise is not None else F.lit(None).cast("string")
    for name, holds in reversed(rules):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def category_by_substring(name: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Category of the first rule whose text occurs in the name, else NULL."""
    low = F.lower(name)
    return first_match([(category, F.contains(low, F.lit(part))) for part, category in rules])


def histogram(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """(value, n, mark): how many rows each licence keeps or drops. NULL reads as ''."""
    value = F.coalesce(F.col(column), F.lit(""))
    mark = F.when(F.col("value").isin(*allowed), "KEEP").otherwise("drop")
    counted = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("value", "n", mark.alias("mark"))


def keep_by_child(
    parent: DataFrame, parent_key: str, child: DataFrame, child_key: str, measure: str, at_least: float
) -> DataFrame:
    """Parents with a child whose ``measure`` reaches the bar; childless parents are dropped."""
    best = child.groupBy(F.col(child_key).alias(parent_key)).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.max(F.coalesce(F.col(measure), F.lit(0.0))).alias("best"),
    )
    return parent.join(best.where(F.col("best") >= at_least), parent_key)


@dataclass
class Gate:
    """What a holdout gate kept, what leaked in, and the two facts that must be zero after it."""

    kept: DataFrame
    leaked: DataFrame
    report: DataFrame


def holdout_gate(df: DataFrame, key: str, holdout: DataFrame, holdout_key: str) -> Gate:
    """Exclude the holdout, and count its members before and after excluding them.

    The holdout is never forced into a broadcast: adaptive execution does so when its measured
    size allows, and sorts and merges otherwise.
    """
    held = holdout.select(F.col(holdout_key).alias(key)).distinct()
    marked = df.join(held.withColumn("_held", F.lit(True)), key, "left")
    kept = marked.where("_held is null").drop("_held")
    still = kept.select(key).join(held, key, "left_semi").agg(F.count(F.lit(1))).scalar()
    report = marked.agg(
        F.count(F.lit(1)).alias("n_in"), F.count("_held").alias("leaked_before"),
        F.count_if(F.col("_held").isNull()).alias("n_kept"),
    )
    return Gate(kept, marked.where("_held").drop("_held"), report.withColumn("leaked_after", still))


def stride_split(df: DataFrame, order: Sequence[str], val_fraction: float) -> DataFrame:
    """Every Nth row in order goes to val, N = round(1 / fraction) but at least 2."""
    stride = max(round(1 / val_fraction), 2)
    numbered = row_numbers(df, order, "_row")
    held = F.pmod("_row", F.lit(stride)) == 0
    return numbered.withColumn("split", F.when(held, "val").otherwise("train")).drop("_row")


def stride_sample(df: DataFrame, order: Sequence[str], stride: int, group: Sequence[str] = ()) -> DataFrame:
    """Every ``stride``-th row of each group, the first included."""
    numbered = row_numbers(df, order, "_row", group)
    return numbered.where(F.pmod("_row", F.lit(stride)) == 0).drop("_row")


def hash_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows by the order of a seeded hash: the same rows however the data is partitioned."""
    draw = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")


def shard_by_bytes(df: DataFrame, order: Sequence[str], payload: Column, budget: int) -> DataFrame:
    """Consecutive rows packed into shards of about ``budget`` bytes (a row is never split).

    ``order`` names columns that tell the rows apart. Only they and the sizes are put in order; the
    payload joins its shard by them."""
    sized = df.select(*order, F.octet_length(payload).cast("long").alias("_bytes"))
    packed = running_total(sized, order, F.col("_bytes"), "_upto")
    before = F.col("_upto") - F.col("_bytes")
    return df.join(packed.select(*order, "_bytes", F.floor(before / budget).alias("shard")), list(order))


def upsert_entry(entries: Column, key: Column, value: Column) -> Column:
    """The map with ``key`` set to ``value``, replacing an older entry."""
    others = F.map_filter(entries, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(key, value))


def unfinished(work: DataFrame, key: str, committed: DataFrame, limit: int | None = None) -> DataFrame:
    """Work whose key is not in the committed output, in key order when limited."""
    todo = work.join(committed.select(key).distinct(), key, "left_anti")
    return todo if limit is None else todo.orderBy(key).limit(limit)


def intern(df: DataFrame, columns: Mapping[str, str], start: int = 0) -> DataFrame:
    """Ids for the distinct texts of several columns that share one vocabulary: (id, text)."""
    texts = None
    for c in columns:
        t = df.select(F.col(c).alias("text")).where(F.col("text").isNotNull()).distinct()
        texts = t if texts is None else texts.unionByName(t)
    return row_numbers(texts.distinct(), ["text"], "id").withColumn("id", F.col("id") + start)


def line_findings(
    df: DataFrame, key: str, text: str, pattern: str, exempt: str, comment: str = "#"
) -> DataFrame:
    """(key, line_no) of lines matching ``pattern``, except comments and lines exempt with a reason."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("_i", "_line"))
    bare = F.ltrim("_line")
    bad = F.col("_line").rlike(pattern) & ~F.startswith(bare, F.lit(comment)) & ~F.col("_line").rlike(exempt)
    return lines.where(bad).select(key, (F.col("_i") + 1).alias("line_no"))


def config_lines(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """Non-blank lines with ``#`` comments cut off."""
    lines = df.select(*key, F.explode(F.split(text, "\n")).alias("_line"))
    body = F.trim(F.substring_index("_line", "#", 1))
    return lines.select(*key, body.alias("line")).where("line <> ''")


def nearest_owner(df: DataFrame, directory: str, markers: DataFrame, marker: str) -> DataFrame:
    """``owner``: the deepest ancestor of ``directory`` (itself included) that holds a marker, else
    the directory itself. Works on distinct directories and joins the answer back."""
    dirs = df.select(F.col(directory).alias("_dir")).distinct()
    parts = F.split("_dir", "/")
    up = dirs.select("_dir", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("_depth"))
    up = up.withColumn("_anc", F.array_join(F.slice(F.split("_dir", "/"), 1, F.col("_depth")), "/"))
    marked = markers.select(F.col(marker).alias("_anc")).distinct()
    owned = up.join(marked, "_anc", "left_semi").groupBy("_dir").agg(
        F.max_by("_anc", "_depth").alias("_owner")
    )
    out = df.join(owned, F.col(directory) == F.col("_dir"), "left")
    return out.withColumn("owner", F.coalesce("_owner", F.col(directory))).drop("_dir", "_owner")
