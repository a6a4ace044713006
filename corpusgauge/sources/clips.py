"""Motion clips: whole hierarchy/motion texts to one row per clip, frame and joint.

Everything is array arithmetic on the text column. A clip that contradicts its own header becomes a
row of the failures table; the rest of the batch goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.session import cut

# Channel names, and the angle each rotation channel sets.
CHANNELS = ("Xposition", "Yposition", "Zposition", "Xrotation", "Yrotation", "Zrotation")
ROTATIONS = {"rx": "Xrotation", "ry": "Yrotation", "rz": "Zrotation"}
POSITIONS = {"tx": "Xposition", "ty": "Yposition", "tz": "Zposition"}


def read_clips(spark: SparkSession, path: str) -> DataFrame:
    """(clip, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("clip"), F.col("value").alias("text")
    )


def _header(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def parsed(clips: DataFrame, clip: str, text: str) -> DataFrame:
    """Header facts, the flat channel list and the numbers of each clip, with its problem if any."""
    head = F.substring_index(F.col(text), "MOTION", 1)
    body = F.substring(F.col(text), F.length(head) + F.length(F.lit("MOTION")) + 1, F.length(text))
    df = clips.select(
        clip,
        _header(head, r"(?m)^\s*(?:ROOT|JOINT)\s+(\S+)").alias("joints"),
        hierarchy(head).alias("tree"),
        # a leaf tip declares no channels, so joints and channel lines pair up in order
        _header(head, r"(?m)^\s*CHANNELS\s+\d+[ \t]+([^\r\n]+)").alias("lists"),
        F.regexp_extract(body, r"Frames:\s*(\d+)", 1).try_cast("int").alias("frames"),
        F.regexp_extract(body, r"Frame Time:\s*([\d.eE+-]+)", 1).try_cast("double").alias("frame_time"),
        F.regexp_extract(body, r"Frame Time:[^\n]*\n(?s)(.*)$", 1).alias("numbers"),
    )
    named = F.transform("lists", lambda line, j: F.transform(
        F.split(F.trim(line), r"\s+"), lambda c: F.struct(j.alias("j"), c.alias("channel"))))
    values = F.filter(F.split("numbers", r"\s+"), lambda v: v != "")
    df = df.withColumn("channels", F.flatten(named)).withColumn("values", F.transform(values, lambda v: v.try_cast("double")))
    axes = lambda line: F.regexp_extract_all(line, F.lit("([XYZ])rotation"), F.lit(1))
    df = df.withColumn("orders", F.transform("lists", lambda line: F.lower(F.array_join(axes(line), ""))))
    df = cut(df.drop("numbers"), "clips")  # the text is taken apart once; checks and frames read the result
    width = F.size("channels")
    got = F.floor(F.size("values") / F.nullif(width, F.lit(0)))
    known = F.forall("channels", lambda c: c["channel"].isin(*CHANNELS))
    whole = (got == F.col("frames")) & (F.size("values") == got * width)
    problem = (
        F.when(F.size("joints") == 0, "no joints").when(F.size("joints") != F.size("lists"), "joints and channel lines differ")
        .when(~known, "unknown channel").when(F.col("frames").isNull() | F.col("frame_time").isNull(), "no frame header")
        .when(F.exists("values", lambda v: v.isNull()), "not a number")
        .when(~F.coalesce(whole, F.lit(False)), F.concat(F.lit("header says "), "frames", F.lit(" frames, data holds "), got))
    )
    return df.withColumn("problem", problem)


def ingest(clips: DataFrame, clip: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((clip, frame, joint, parent, ox..oz, rotation_order, tx..tz, rx..rz), failures(clip, problem)).

    Channels are read by their declared name, never by position. A missing channel is 0. ``parent`` is NULL for
    a root. ``rotation_order`` has the axes as declared, such as zxy: the order in which rx, ry and rz compose.
    """
    df = parsed(clips, clip, text)
    failures = df.where("problem is not null").select(clip, "problem")
    both = {**POSITIONS, **ROTATIONS}

    def value(row: Column, joint: Column, name: str) -> Column:
        at = F.array_position(F.col("flat"), F.concat(joint.cast("string"), F.lit(" "), F.lit(both[name])))
        return F.when(at > 0, F.get(row, (at - 1).cast("int"))).otherwise(0.0).alias(name)

    # places of the channels by joint and name are found in one list of strings; a frame's numbers stay one array
    flat = F.transform("channels", lambda c: F.concat(c["j"].cast("string"), F.lit(" "), c["channel"]))
    width = F.size("channels")
    good = df.where("problem is null and frames > 0").withColumn("flat", flat)
    rows = F.transform(F.sequence(F.lit(0), F.col("frames") - 1), lambda f: F.struct(
        f.alias("frame"), F.slice("values", f * width + 1, width).alias("row")))

    def joints_of(frame: Column) -> Column:
        return F.transform("tree", lambda joint, j: F.struct(
            frame["frame"].alias("frame"), joint["name"].alias("joint"), joint["parent"].alias("parent"),
            *[F.get(joint["offset"], F.lit(k)).alias(n) for k, n in enumerate(("ox", "oy", "oz"))],
            F.get("orders", j).alias("rotation_order"), *[value(frame["row"], j, n) for n in both],
        ))

    each = good.select(clip, "flat", "tree", "orders", F.explode(rows).alias("f")).select(clip, F.inline(joints_of(F.col("f"))))
    return each, failures


def hierarchy(head: Column) -> Column:
    """Joints in order: name, name of the parent, offset. Tips (end sites) are no joints.

    One pass over the lines keeps the stack of open joints; a tip opens a level without a joint."""
    lines = F.split(head, "\n")
    state = "struct<stack: array<string>, open: string, joints: array<struct<name: string, parent: string, offset: array<double>>>>"
    start = F.from_json(F.lit('{"stack": [], "open": null, "joints": []}'), state)

    def step(s: Column, raw: Column) -> Column:
        line = F.trim(F.regexp_replace(raw, r"\s+", " "))
        word = F.substring_index(line, " ", 1)
        name = F.try_element_at(F.split(line, " "), F.lit(2))
        joint = word.isin("ROOT", "JOINT")
        top = F.try_element_at(s["stack"], F.lit(-1))
        numbers = F.transform(F.slice(F.split(line, " "), 2, 3), lambda x: x.try_cast("double"))
        last = F.try_element_at(s["joints"], F.lit(-1))
        placed = F.concat(
            F.slice(s["joints"], F.lit(1), F.size(s["joints"]) - 1),
            F.array(F.struct(last["name"].alias("name"), last["parent"].alias("parent"), numbers.alias("offset"))),
        )
        added = F.concat(s["joints"], F.array(F.struct(
            name.alias("name"), top.alias("parent"), F.lit(None).cast("array<double>").alias("offset"))))
        joints = F.when(joint, added).when((word == "OFFSET") & (top != ""), placed).otherwise(s["joints"])
        stack = (
            F.when(word == "{", F.concat(s["stack"], F.array(F.coalesce(s["open"], F.lit("")))))
            .when(word == "}", F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(0)))).otherwise(s["stack"])
        )
        open_ = F.when(joint, name).when(word == "End", F.lit("")).otherwise(s["open"])
        return F.struct(stack.alias("stack"), open_.alias("open"), joints.alias("joints")).cast(state)

    return F.aggregate(lines, start, step)["joints"]
