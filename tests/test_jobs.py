"""Comparisons, references, claims, clips, sinks and streams."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgauge import session
from corpusgauge.bindings import QUERIES
from corpusgauge.operators import audit, compare, prepare, resolve, shred, spatial, stats
from corpusgauge.operators.audit import eligibility, roll_up, vocabulary
from corpusgauge.sources import clips, listing, sinks
from corpusgauge.streaming import incremental


def run(spark, rows):
    return spark.createDataFrame([(float(a), float(e)) for a, e in rows], "asked double, err double")


def test_run_comparison(spark):
    eight = [(45 * k, 1) for k in range(8)]
    same = compare.compare_runs(run(spark, eight), run(spark, eight), ["asked"], "err")
    assert {r.outcome for r in same.collect()} == {"same"} and same.count() == 8
    worse = [(a, e + 19) for a, e in eight if a not in (45, 135)]
    every = run(spark, [*eight, (999, 0)]).select("asked")
    out = {r.asked: r.outcome for r in compare.compare_runs(run(spark, eight), run(spark, worse), ["asked"], "err", every).collect()}
    assert sorted(a for a, o in out.items() if o == "lost by other") == [45, 135]
    assert sum(o == "worse" for o in out.values()) == 6 and out[999] == "unscored in both"


def test_slope_needs_three_rows(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 45.0, 40.0), ("b", 0.0, 170.0), ("b", 45.0, -145.0), ("b", 90.0, -100.0)],
                               "run string, asked double, got double")
    out = {r.run: r.slope for r in compare.slope(df, ["run"], ["asked"], "asked", "got").collect()}
    assert math.isnan(out["a"]) and math.isclose(out["b"], 1.0)


def test_references(spark):
    records = spark.createDataFrame([(["renders/a.png"], "renders/b.png"), (None, "renders/gone.png"), (["O:/local/a.png", "/home/me/a.png"], "renders/a.png")],
                                    "inputs array<string>, output string")
    served = spark.createDataFrame([("renders/a.png",), ("renders/b.png",), ("/home/me/a.png",)], "name string")
    got = {r.path: (r.n, r.state) for r in resolve.resolve_references(resolve.references(records, "inputs", "output"), served, "name").collect()}
    assert got == {"renders/a.png": (2, "served"), "renders/b.png": (1, "served"), "renders/gone.png": (1, "missing"),
                   "O:/local/a.png": (1, "absolute"), "/home/me/a.png": (1, "absolute")}


def test_claims(spark):
    doc = spark.createDataFrame([("x <!--claim:bones=104 tol=0.5--> y <!--claim:clips=810--> <!--claim:hole=1-->"
                                  "<!-- claim:off=10 --><!--claim:away=5--><!--claim:lost=5-->",)], "text string")
    found = resolve.claims(doc, "text")
    assert {r.name: r.tol for r in found.collect()}["clips"] == pytest.approx(40.5)
    live = spark.createDataFrame([("bones", 104.0, True), ("clips", 811.0, True), ("off", 11.0, True), ("away", None, False), ("lost", None, False)],
                                 "name string, value double, reachable boolean")
    cache = spark.createDataFrame([("away", 5.1), ("clips", 1.0)], "name string, cached double")
    got = {r.name: (r.state, r.superseded) for r in resolve.check_claims(found, live, cache).collect()}
    assert got == {"bones": ("ok", False), "clips": ("ok", True), "hole": ("UNVERIFIED", False), "off": ("DRIFTED", False),
                   "away": ("CACHED", False), "lost": ("ERROR", False)}


def test_claims_are_measured_by_name(spark, tmp_path):
    from corpusgauge.plans.claims import check_document

    doc = spark.createDataFrame([("<!--claim:rows=5--> <!--claim:gone=3--> <!--claim:broken=1--> <!--claim:free=2-->",)], "text string")
    registry = {
        "rows": lambda s: s.range(5).agg(F.count("*")),
        "gone": lambda s: s.read.parquet(f"{tmp_path}/nowhere").agg(F.count("*")),
        "broken": lambda s: s.range(1).select(F.raise_error(F.lit("no")).cast("double")),
        "unclaimed": lambda s: 1 / 0,
    }
    cache = spark.createDataFrame([("gone", 3.0), ("broken", 1.0)], "name string, cached double")
    got = {r.name: r.state for r in check_document(spark, doc, "text", registry, cache).collect()}
    assert got == {"rows": "ok", "gone": "CACHED", "broken": "ERROR", "free": "UNVERIFIED"}


def test_name_difference(spark):
    a = spark.createDataFrame([(f"brow_{i}",) for i in range(52)], "n string")
    b = spark.createDataFrame([(f"Brow{i}",) for i in range(51)] + [("extra",)], "n string")
    got = {(r.side, r.name) for r in resolve.name_difference(a, "n", b, "n").collect()}
    assert got == {("only_left", "brow_51"), ("only_right", "extra")}


def test_selection_classes(spark):
    sets = {"whole": range(8), "prefix": range(3), "one": [3], "picked": [1, 4, 7]}
    df = spark.createDataFrame([(k, i) for k, v in sets.items() for i in v], "g string, i int")
    got = {r.g: r.selection for r in stats.selection_class(df, "g", "i", 8).collect()}
    assert got == {"whole": "whole", "prefix": "prefix", "one": "hand-picked", "picked": "hand-picked"}
    named = {"whole": "nowhere", "picked": "high", "one": "waist", "prefix": None}
    more = spark.createDataFrame([("outside", i) for i in (1, 4, 6)] + [("outprefix", 0), ("outprefix", 1)], "g string, i int")
    band = F.create_map(*[F.lit(x) for k, v in named.items() for x in (k, v or "")])[F.col("g")]
    band = F.when(F.col("g").isin("outside", "outprefix"), "high").otherwise(F.when(band != "", band))
    bands = spark.createDataFrame([("high", 1, 2), ("high", 4, 7), ("low", 0, 3)], "band string, low int, high int")
    judged = stats.selection_class(df.union(more).withColumn("b", band), "g", "i", 8, "b", bands)
    got = {r.g: r.selection for r in judged.collect()}
    assert got == {"whole": "whole", "prefix": "prefix", "one": "undeclared band", "picked": "band", "outside": "band", "outprefix": "prefix"}
    assert {r.g for r in stats.selection_problems(judged, "g").collect()} == {"one", "prefix", "outprefix"}


def test_empty_vocabulary_is_unchecked_and_null_is_not_a_word(spark):
    df = spark.createDataFrame([("edit", "x"), ("audio", None), ("audio", "identity")], "axis string, v string")
    known = prepare.literal_rows(spark, [("audio", "identity")], "axis value")
    assert [(r.axis, r.value) for r in vocabulary(df, "v", known, "axis").collect()] == [("audio", None)]


def test_roll_up_counts_only_fatal_failures(spark):
    rows = spark.createDataFrame([("a", "PASS", "", True), ("b", "FAIL", "", True), ("c", "WARN", "", False)],
                                 "name string, state string, detail string, fatal boolean")
    assert {r.outcome: (r.n, r.blocking) for r in roll_up(rows).collect()} == {"PASS": (1, 0), "FAIL": (1, 1), "WARN": (1, 0), "ALL": (3, 1)}


def test_eligibility_ignores_case(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (9,)], "run int")
    runs = spark.createDataFrame([(1, "BF16"), (2, "Q4_K_M")], "id int, p string")
    assert dict(eligibility(rows, "run", runs, "id", "p").collect()) == {"eligible": 2, "ineligible": 1, "unknown": 1}


@pytest.mark.parametrize("n", [100, 25_000])
def test_nest_has_one_layout(spark, n):
    rows = [("hot", i % 300, i) for i in range(n)] + [("cold", 0, 1)]
    df = spark.createDataFrame(rows, "k string, c int, v int")
    out = shred.nest(df, "k", ["c"], ["v"], ["v"]).collect()
    assert len(out) == len({(k, c) for k, c, _ in rows})
    assert sorted((r.k, r.c, s.v) for r in out for s in r.scores) == sorted(rows)
    assert all([s.v for s in r.scores] == sorted(s.v for s in r.scores) for r in out)


def test_late_rows_are_kept_apart(spark, tmp_path):
    from datetime import datetime, timedelta

    from corpusgauge.streaming.incremental import finished, log_stream, shards

    at = lambda minutes: datetime(2024, 1, 1) + timedelta(minutes=minutes)
    batches = [[(1, at(0), "a"), (1, at(0), "a"), (2, at(100), "b")], [(2, at(100), "b"), (3, at(101), "c"), (4, at(1), "late")]]
    schema = spark.createDataFrame(batches[0], "id int, ts timestamp, v string").schema
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = log_stream(shards(spark, f"{tmp_path}/in", schema), ["id"], "ts", "1 hour", f"{tmp_path}/out")
        log = finished(q, lambda: spark.read.parquet(f"{tmp_path}/out/log"))
    assert sorted(r.id for r in log.collect()) == [1, 2, 3]
    assert [r.v for r in spark.read.parquet(f"{tmp_path}/out/late").collect()] == ["late"]


def test_publish_puts_all_tables_there_or_none(spark, tmp_path):
    from corpusgauge.sources.sinks import publish

    good = spark.range(3)
    bad = good.select(F.raise_error(F.lit("broken")).alias("x"))
    none = good.where("id < 0")
    with pytest.raises(Exception, match="broken"):
        publish({"a": good, "b": bad}, none, f"{tmp_path}/out")
    assert not list(tmp_path.iterdir())
    assert publish({"a": good, "b": good}, none, f"{tmp_path}/out") == [f"{tmp_path}/out/a", f"{tmp_path}/out/b"]
    assert spark.read.parquet(f"{tmp_path}/out/b").count() == 3


def test_files_at_any_depth_are_listed(spark, tmp_path):
    from corpusgauge.sources.listing import list_files

    deep = tmp_path.joinpath(*"abcdefghijkl")
    deep.mkdir(parents=True)
    (deep / "x.bin").write_bytes(b"1")
    assert [r.bytes for r in list_files(spark, str(tmp_path)).collect()] == [1]
    assert list_files(spark, str(tmp_path), depth=4).count() == 0


def test_run_records_need_a_revision_and_images(spark):
    from corpusgauge import schemas

    good = ('{"edit_models":{"repo_id":"r","revision":"abc"},"edit_runs":{"precision":"bf16","steps":30,"text_guidance_scale":5.0,'
            '"image_guidance_scale":2.0,"negative_prompt":"n"},"torch":"2","outputs":{"a":{"file":"a.png","prompt":"p","seed":7},'
            '"b":{"file":"b.png","prompt":"p","seed":8},"c":{"file":"c.png","prompt":"q","seed":9,"seconds":1.5}}}')
    bad = good.replace('"revision":"abc"', '"x":1')
    images = spark.createDataFrame([("a.png", 100, b"A"), ("b.png", 101, b"B")], "file string, render_id long, image binary")
    rows = spark.createDataFrame([(1, good), (2, bad), (3, good.replace("abc", "main"))], "k int, r string")
    out = shred.run_relations(rows, "k", "r", images)
    assert sorted(tuple(r) for r in out["problems"].collect()) == [
        (1, "an output has no image"), (2, "revision is not a resolved commit"), (3, "revision is not a resolved commit")]
    for name in ("edit_models", "edit_prompts", "edit_runs", "edited_renders"):
        assert [(f.name, f.dataType) for f in out[name].schema] == [(f.name, f.dataType) for f in schemas.struct(schemas.RELATION_DDL[name])]
    assert sorted((r.render_id, r.seed, r.edit_run_id) for r in out["edited_renders"].collect()) == [(100, 7, 0), (101, 8, 0)]
    runs = {r.edit_run_id: r for r in out["edit_runs"].collect()}
    text = {r.prompt_id: r.text for r in out["edit_prompts"].collect()}
    assert [(text[r.prompt_id], text[r.negative_prompt_id], r.steps, r.text_guidance_scale) for _, r in sorted(runs.items())] == [("p", "n", 30, 5.0), ("q", "n", 30, 5.0)]


def test_trees(spark):
    rows = [(0, -1, "a"), (1, 0, "b"), (2, 1, "c"), (3, 2, "d"), (4, 0, "e"), (5, 9, "f"), (7, 7, "g")]
    df = spark.createDataFrame(rows, "id int, up int, name string")
    paths, bad = spatial.tree_paths(df, "id", "up", "name")
    assert {r.id: (r.path, r.depth) for r in paths.collect()} == {0: ("a", 1), 1: ("a/b", 2), 2: ("a/b/c", 3), 3: ("a/b/c/d", 4), 4: ("a/e", 2)}
    assert {r.id for r in bad.collect()} == {5, 7}
    with pytest.raises(Exception, match="before its child"):
        spatial.subtree_ranges(df, "id", "up").collect()
    sound = df.where("id < 5").union(spark.createDataFrame([(6, 5, "h")], df.schema))  # the parent of 6 is no node
    spans = {r.id: (r.first, r.last) for r in spatial.subtree_ranges(sound, "id", "up").collect()}
    inside = {(a, b) for a, (x, y) in spans.items() for b, (z, _) in spans.items() if a != b and x <= z <= y}
    assert sorted(x for x, _ in spans.values()) == [0, 1, 2, 3, 4, 5]
    assert inside == {(0, 1), (0, 2), (0, 3), (0, 4), (1, 2), (1, 3), (2, 3)}


def test_subtree_of_a_long_chain_and_of_a_wide_node(spark):
    n = 10_000
    chain = [(i, i - 1, f"c{i}") for i in range(n)]
    wide = [(n, -1, "w")] + [(n + 1 + k, n, "leaf") for k in range(3_000)]
    df = spark.createDataFrame(chain + wide, "id long, up long, name string").repartition(6)
    spans = {r.id: r.last - r.first + 1 for r in spatial.subtree_ranges(df, "id", "up", at_once=500).collect()}
    assert all(spans[i] == n - i for i in range(n)) and spans[n] == 3_001 and spans[n + 7] == 1


def test_weighted_centroids_of_subtrees(spark):
    nodes = spark.createDataFrame([(0, -1), (1, 0), (2, 1), (3, 0), (4, -1)], "id long, up long")
    heavy = 1e15  # outside the subtree of 1, whose total is small beside it
    w = spark.createDataFrame([(2, 1e-3, 4.0), (2, 1e-3, 8.0), (3, heavy, 1.0)], "id long, w double, x double")
    got = {r.id: (r.source, r.x) for r in spatial.weighted_centroids(w, "id", "w", ["x"], nodes, "id", "up").collect()}
    assert got[1] == ("descendants", pytest.approx(6.0)) and got[2] == ("own", pytest.approx(6.0))
    assert got[0][0] == "descendants" and got[3] == ("own", 1.0) and got[4] == ("problem", None)


def test_visibility_of_empty_pixels(spark):
    v = spark.createDataFrame([("r", 1.5, 1.5, 2.0)], "r string, x double, y double, d double")
    k = spark.createDataFrame([("r", 1.2, 1.7, 2.01), ("r", 1.2, 1.7, 3.0), ("r", 9.5, 1.0, 1.0), ("r", 3.0, 3.0, 1.0), ("r", 3.0, 3.0, -1.0)], v.schema)
    for flag, empty in ((True, 2), (False, 0)):
        out = spatial.visibility(v, k, "r", "x", "y", "d", 8, 8, empty_is_visible=flag).collect()
        assert sorted(r.visibility for r in out) == sorted([2, 1, 0, empty, 0])


def test_signed_volume_flips_when_mirrored(spark):
    v = spark.createDataFrame([(0, 0., 0., 0.), (1, 1., 0., 0.), (2, 0., 1., 0.), (3, 0., 0., 1.)], "id int, x double, y double, z double")
    f = spark.createDataFrame([("m", 0, 2, 1), ("m", 0, 1, 3), ("m", 1, 2, 3), ("m", 0, 3, 2)], "m string, a int, b int, c int")
    vol = lambda verts: spatial.signed_volume(f, "m", ["a", "b", "c"], verts, "id", ["x", "y", "z"]).collect()[0].signed_volume
    assert vol(v) == pytest.approx(1 / 6) and vol(v.withColumn("x", -F.col("x"))) == pytest.approx(-1 / 6)


def test_determinant_of_a_mirrored_basis(spark):
    basis = [[F.lit(1.0), F.lit(0.0), F.lit(0.0)], [F.lit(0.0), F.lit(1.0), F.lit(0.0)], [F.lit(0.0), F.lit(0.0), F.lit(-1.0)]]
    assert spark.range(1).select(spatial.determinant(basis)).collect()[0][0] == -1


CLIP = """HIERARCHY
ROOT hip
{
 OFFSET 0 0 0
 CHANNELS 6 Xposition Yposition Zposition Yrotation Xrotation Zrotation
 JOINT arm
 {
  OFFSET 0 1 0
  CHANNELS 3 Zrotation Xrotation Yrotation
  End Site
  {
   OFFSET 0 1 0
  }
 }
}
MOTION
Frames: 2
Frame Time: 0.0166667
1 2 3 10 20 30 7 8 9
4 5 6 11 21 31 70 80
90
"""


def test_clips_by_declared_name_and_failures(spark, tmp_path):
    (tmp_path / "ok.bvh").write_text(CLIP)
    (tmp_path / "short.bvh").write_text(CLIP.replace("Frames: 2", "Frames: 3"))
    (tmp_path / "odd.bvh").write_text(CLIP.replace("Zrotation Xrotation Yrotation", "Zrotation Xrotation Wrotation"))
    (tmp_path / "text.bvh").write_text(CLIP.replace("90\n", "ninety\n"))
    (tmp_path / "empty.bvh").write_text("nothing here")
    good, bad = clips.ingest(clips.read_clips(spark, str(tmp_path)), "clip", "text")
    rows = {(r.frame, r.joint): (r.tx, r.ty, r.tz, r.rx, r.ry, r.rz) for r in good.collect()}
    assert rows == {(0, "hip"): (1, 2, 3, 20, 10, 30), (0, "arm"): (0, 0, 0, 8, 9, 7), (1, "hip"): (4, 5, 6, 21, 11, 31), (1, "arm"): (0, 0, 0, 80, 90, 70)}
    kept = {(r.joint, r.parent, r.ox, r.oy, r.oz, r.rotation_order) for r in good.collect()}
    assert kept == {("hip", None, 0.0, 0.0, 0.0, "yxz"), ("arm", "hip", 0.0, 1.0, 0.0, "zxy")}
    assert {r.clip: r.problem for r in bad.collect()} == {
        "short": "header says 3 frames, data holds 2", "odd": "unknown channel", "text": "not a number", "empty": "no joints"}


def test_listing_and_lists(spark, tmp_path):
    deep = tmp_path / "lib" / "pack" / "meshes"
    deep.mkdir(parents=True)
    (tmp_path / "lib" / "a.cff").write_text("x")
    (deep / "m.obj").write_text("x")
    (tmp_path / "loose").mkdir()
    (tmp_path / "loose" / "n.obj").write_text("x")
    owners = {r.path.rsplit("/", 1)[1]: r.owner.rsplit("/", 1)[1] for r in listing.libraries(listing.list_files(spark, str(tmp_path)), [".obj"]).collect()}
    assert owners == {"m.obj": "lib", "n.obj": "loose"}
    (tmp_path / "t.txt").write_text("# note\n a # b\n\nc\n")
    (tmp_path / "l.txt").write_text("only\n")
    got = lambda *a: [r.line for r in listing.steering_lines(spark, *map(str, a)).collect()]
    assert got(tmp_path / "t.txt", tmp_path / "none.txt") == ["a", "c"] and got(tmp_path / "t.txt", tmp_path / "l.txt") == ["only"]
    with pytest.raises(FileNotFoundError):
        got(tmp_path / "none.txt")


def test_captions_and_payload_shards(spark, tmp_path):
    df = spark.createDataFrame([("a", 2.5, 5.0, "two"), ("a", 0.0, 2.5, "one"), ("a", 5.0, 6.0, "")], "clip string, s double, e double, t string")
    more = spark.createDataFrame([("b", 0.5 * i, 0.5 * i + 1, f"line {i}") for i in range(3000)] + [("c", 0.0, 1.0, None)], df.schema)
    sinks.write_captions(df.union(more).repartition(5), "clip", "s", "e", "t", f"{tmp_path}/vtt")
    files = {r.clip: r.text for r in sinks.read_captions(spark, f"{tmp_path}/vtt").collect()}
    assert files["a"] == "WEBVTT\n\n00:00:00.000 --> 00:00:02.500\none\n\n00:00:02.500 --> 00:00:05.000\ntwo\n\n"
    assert files["c"] == "WEBVTT\n\n" and files["b"].startswith("WEBVTT\n\n00:00:00.000 --> ")
    assert [x for x in files["b"].split("\n") if x.startswith("line")] == [f"line {i}" for i in range(3000)]
    assert all(len(list((tmp_path / "vtt" / f"clip={k}").glob("part*"))) == 1 for k in "abc")  # one file each
    data = spark.createDataFrame([(i, bytearray(b"x" * 100)) for i in range(50)], "id long, image binary")
    sinks.write_payload_shards(data, ["id"], "image", f"{tmp_path}/shards", 1000)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 50 and back.select("shard").distinct().count() == 5


def test_captions_are_dealt_and_listed_by_files(spark, tmp_path):
    name, tracker = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.statusTracker()
    n, before = 4 * sinks.FILES, spark.conf.get(name)
    df = spark.range(n).select(F.col("id").alias("clip"), F.lit(0.0).alias("s"), F.lit(1.0).alias("e"), F.lit("x").alias("t"))
    spark.sparkContext.setJobGroup("captions", "")
    try:
        sinks.write_captions(df, "clip", "s", "e", "t", f"{tmp_path}/vtt")
        writers = {p.name.split("-")[1] for p in (tmp_path / "vtt").glob("clip=*/part*")}
        wrote = set(tracker.getJobIdsForGroup("captions"))
        files = sinks.read_captions(spark, f"{tmp_path}/vtt")
        listed = [tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup("captions")) - wrote for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(writers) == 4  # not one writer, as small data would get
    assert listed and max(listed) <= 4 * spark.sparkContext.defaultParallelism < n and spark.conf.get(name) == before
    assert {r.clip for r in files.collect()} == set(range(n)) and files.select("text").distinct().count() == 1


CUBE = [(0, 2, 1), (0, 3, 2), (4, 5, 6), (4, 6, 7), (0, 1, 5), (0, 5, 4), (2, 3, 7), (2, 7, 6), (1, 2, 6), (1, 6, 5), (3, 0, 4), (3, 4, 7)]
PLACES = [(-1, -1, -1), (1, -1, -1), (1, 1, -1), (-1, 1, -1), (-1, -1, 1), (1, -1, 1), (1, 1, 1), (-1, 1, 1)]


def body(spark, faces=CUBE, places=PLACES, right=("hand.R", 0.8), left=("hand.L", -0.8), basis=(1, 0, 0, 0, 1, 0, 0, 0, 1)):
    f = spark.createDataFrame([("m", *x) for x in faces], "m string, a int, b int, c int")
    v = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(places)], "id int, x double, y double, z double")
    j = spark.createDataFrame([("m", n, x, 0.0, 0.0, 1.0, 0.0, 0.0) for n, x in (right, left, ("spine", 0.0))], "m string, n string, x double, y double, z double, rx double, ry double, rz double")
    b = spark.createDataFrame([("m", *map(float, basis))], "m string, " + ", ".join(f"b{i} double" for i in range(9)))
    volumes = spatial.signed_volume(f, "m", ["a", "b", "c"], v, "id", ["x", "y", "z"])
    edges = spatial.edge_pairs(f, "m", ["a", "b", "c"])
    sides = spatial.side_split(j, "m", "n", ["x", "y", "z"], ["rx", "ry", "rz"])
    return spatial.handedness(sides, "m", volumes, edges, b, [f"b{i}" for i in range(9)]).collect()


def test_handedness(spark):
    (good,) = body(spark)
    assert good.handed and good.signed_volume == pytest.approx(8.0) and (good.n_edges, good.open_edges, good.flipped_edges) == (18, 0, 0)
    (r,) = body(spark, faces=[(a, c, b) if k == 0 else (a, b, c) for k, (a, b, c) in enumerate(CUBE)])
    assert not r.handed and r.problem == "faces are flipped" and r.flipped_edges == 3
    (r,) = body(spark, places=[(-x, y, z) for x, y, z in PLACES])
    assert r.problem == "volume is not positive"
    (r,) = body(spark, basis=(-1, 0, 0, 0, 1, 0, 0, 0, 1))
    assert r.problem == "bases are mirrored" and r.negative_bases == 1
    (r,) = body(spark, right=("hand.R", -0.8), left=("hand.L", 0.8))
    assert r.problem == "sides are not split"
    (r,) = body(spark, left=("tail", -0.8))
    assert r.problem == "sides are not split" and r.left_dot is None
    (r,) = body(spark, faces=CUBE[1:])
    assert r.open_edges == 3 and (r.handed or r.signed_volume < 8)


def test_few_values_by_a_sketch(spark):
    rows = [("wide", float(i % 5000)) for i in range(20_000)] + [("flat", float(i % 3)) for i in range(900)] + [("flat", float("nan")), ("flat", None)]
    long = spark.createDataFrame(rows, "a string, v double").repartition(4)
    exact = {r.a: (r.n_values, r.collapsed) for r in audit.few_values(long, "a", "v").collect()}
    about = {r.a: (r.n_values, r.collapsed) for r in audit.few_values(long, "a", "v", error=0.02).collect()}
    assert exact == {"wide": (5000, False), "flat": (3, True)}
    assert about["flat"] == (3, True) and abs(about["wide"][0] - 5000) < 500 and not about["wide"][1]


def test_append_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string")
    for _ in range(2):
        incremental.append_new(df, ["id"], f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    todo = prepare.unfinished(spark.range(5), "id", spark.read.parquet(f"{tmp_path}/t"), limit=2)
    assert [r.id for r in todo.collect()] == [0, 3]


def test_gate_stream_resumes_and_replays(spark, tmp_path):
    inbox, root = f"{tmp_path}/inbox", f"{tmp_path}/gate"
    schema = "id long, v double"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)

    def gate():
        stream = incremental.shards(spark, inbox, spark.createDataFrame([], schema).schema)
        q = incremental.gate_stream(stream, [("no value", F.col("v").isNull()), ("negative", F.col("v") < 0)], ["id"], root)
        read = lambda d: {(r.id, r.asDict().get("problem")) for r in spark.read.parquet(f"{root}/{d}").collect()}
        return incremental.finished(q, lambda: (read("accepted"), read("quarantine")))

    arrive([(1, 1.0), (2, -1.0), (3, None)])
    assert gate() == ({(1, None)}, {(2, "negative"), (3, "no value")})
    arrive([(1, 1.0), (4, 2.0), (2, 5.0)])  # a repeat, a new row, and a corrected one
    good, bad = gate()
    assert good == {(1, None), (2, None), (4, None)} and (1, "already committed") in bad
    assert gate() == (good, bad)  # nothing new has arrived


def test_a_slope_of_one_half_does_not_follow_whatever_the_rounding(spark):
    rows = [(f"{a},{b}", x, y, 0.0) for a in range(0, 20) for b in range(0, 30) for x, y in ((0.0, float(a)), (45.0, b * 1.1), (90.0, a + 45.0))]
    df = spark.createDataFrame(rows, "g string, asked double, recovered double, err double").repartition(5)
    out = compare.verdict(df, ["g"], ["asked"], "asked", "recovered", "err")
    assert {r.verdict: r.n for r in out.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()} == {"does not follow": 600}


def test_sides_with_a_row_for_each_run_are_not_broadcast(spark):
    record = '{"edit_models": {"repo_id": "m", "revision": "r1"}, "edit_runs": {"steps": 3}, "outputs": {"a": {"file": "f", "prompt": "p", "seed": 1}}}'
    runs = spark.createDataFrame([(1, record), (2, record)], "k long, r string")
    made = shred.run_relations(runs, "k", "r", spark.createDataFrame([("f", 7, b"x")], "file string, render_id long, image binary"))
    for name in ("edit_runs", "edited_renders", "run_outputs"):
        rows = made[name].collect()
        assert len(rows) == 2 and "BroadcastHashJoin" not in made[name]._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_signed_volumes_grow_with_the_faces(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FACES", 100)
    faces = spark.createDataFrame([(m % 5, m, m + 1, 7000) for m in range(1000)], "mesh long, a long, b long, c long")
    v = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 3)) for i in [*range(1001), 7000]], "k long, x double, y double, z double")
    out = spatial.signed_volume(faces, "mesh", ["a", "b", "c"], v, "k", ["x", "y", "z"])
    at = lambda i: np.array([i % 7, i % 5, i % 3], float)
    want = {g: sum(float(np.dot(at(m), np.cross(at(m + 1), at(7000)))) for m in range(g, 1000, 5)) / 6 for g in range(5)}
    got = {r.mesh: (r.n_faces, round(r.signed_volume, 6)) for r in out.collect()}
    assert got == {g: (200, round(x, 6)) for g, x in want.items()}
    # 1000 faces in tasks of 100, and the busy vertex in ten copies
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "10), REPARTITION_BY_NUM" in plan


def test_tasks_of_edges_grow_with_the_faces(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FACES", 100)
    faces = spark.createDataFrame([(0, m, m + 1, 5000) for m in range(1000)], "mesh long, a long, b long, c long")
    out = spatial.edge_pairs(faces, "mesh", ["a", "b", "c"])
    assert tuple(out.first()) == (0, 2001, 1002, 0, 0)
    assert "30), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_mask_overlaps_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "PER_TASK", 100)
    cells = lambda lo, hi: spark.createDataFrame([(i % 2, i, 0) for i in range(lo, hi)] * 2, "g long, x long, y long")
    out = spatial.iou(cells(0, 600), cells(400, 800), "g", ["x", "y"], spark.range(3).withColumnRenamed("id", "g"))
    assert sorted(tuple(r) for r in out.collect()) == [(0, 100, 400, 0.25), (1, 100, 400, 0.25), (2, 0, 0, 0.0)]
    assert "20), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()  # 2000 rows


def test_lines_of_the_model_map_are_dealt_by_their_number(spark, monkeypatch):
    asked = []
    deal = session.dealt
    monkeypatch.setattr(session, "dealt", lambda df, rows, *keys: asked.append((rows, keys)) or deal(df, rows, *keys))
    QUERIES["shred_map"](spark, "/root/testdata/sf0.001").count()
    assert asked == [(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count(), ("l_partkey",))]
    assert deal(spark.range(10), 10 * session.PER_TASK + 1, "id").rdd.getNumPartitions() == 11


def test_annotation_files_are_parsed_once(spark):
    out = QUERIES["shred_json"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(StructField(images" not in plan and plan.count("from_json") <= 1 and "polygons" in out.columns
