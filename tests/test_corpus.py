"""Red/green: a clean corpus passes, and each planted defect trips the check it should."""

import pytest
from pyspark.sql import functions as F

from corpusgauge import schemas
from corpusgauge.plans import corpus_audit, distribution_audit, fetch_gate, score_audit
from corpusgauge.sources.sinks import PublishRefused, publish, write_relation

ROWS = {
    "bones": [(0, "upperarm01.L", -1)], "phenotypes": [(0, "age")], "local_changes": [(0, "c")],
    "licenses": [(0, "CC-BY-4.0", "u")], "source_datasets": [(0, "clips", 0)],
    "identities": [(1, 7, "s1", "train"), (2, 8, "s2", "val")],
    "identity_phenotype": [(1, 0, 0.5)], "identity_local_change": [(1, 0, 0.5)],
    "motion_clips": [(0, 0, "walk", 30.0)], "poses": [(0, 0, 0)], "pose_rotations": [(0, 0, 0.0, 0.0, 0.0)],
    "environments": [(0, "e", "h", 0)], "scenes": [(0, 1, 0, 0, 9, "train")],
    "cameras": [(0, 0, 0, 1.0, 1.0, 0.5, 0.5, 64, 64, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0)],
    "render_runs": [(0, "1", "r", "sha", "2026-01-01T00:00:00Z")], "renders": [(100, 0, 0)],
    "render_data": [(100, bytearray(b"p"))], "topologies": [(0, "full", 19158), (1, "body", 13718)],
    "keypoint_defs": [(0, "left_shoulder"), (1, "nose")], "keypoint_bone_anchor": [(0, 0)],
    "keypoint_vertex_anchor": [(1, 0, 4021)], "keypoints_2d": [(100, 1, 1.0, 2.0, 2)],
    "segmentation": [(100, bytearray(b"m"))], "meshes": [(100, 1, bytearray(b"g"))],
    "edit_models": [(0, "base", "df5d")], "edit_prompts": [(0, "restyle"), (1, "blurry")],
    "edit_runs": [(1, 0, 0, 1, "bf16", 30, 5.0, 2.0, "2026-01-01T00:00:00Z")],
    "edited_renders": [(900, 100, 1, 3, bytearray(b"e"))],
}


def table(spark, name, rows=None):
    return spark.createDataFrame(ROWS[name] if rows is None else rows, schemas.struct(schemas.RELATION_DDL[name]))


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    for name in ROWS:
        # one relation is sharded into a directory of its own name
        write_relation(table(spark, name).coalesce(1), f"{root}/{name}" if name == "scenes" else f"{root}/{name}.parquet")
    return root


def failing(spark, found):
    rows = corpus_audit.problems(corpus_audit.checks(found)).collect()
    return {r.name: r.detail for r in rows}


def spoiled(spark, clean, **rows):
    found = corpus_audit.load(spark, clean)
    for name, new in rows.items():
        found.tables[name] = table(spark, name, new)
    return found


def test_counts():
    assert len(schemas.RELATION_DDL) == 28 and len(schemas.FOREIGN_KEYS) == 29


def test_clean_corpus_passes_and_shards_are_read(spark, clean):
    found = corpus_audit.load(spark, clean)
    assert "scenes" in found.tables and not found.problems
    assert failing(spark, found) == {}


# Independent defects share a corpus; the set of failing checks must be exactly theirs.
DEFECTS = [
    ({"edit_runs": [(1, 0, 0, 1, "NF4", 30, 5.0, 2.0, "t")], "keypoint_vertex_anchor": [(1, 7, 4021)],
      "scenes": [(0, 1, 0, 0, 9, "val")], "pose_rotations": [(0, 0, float("nan"), 0.0, 0.0)]},
     {"NOT CORPUS DATA: rows of a quantised run", "keypoint_vertex_anchor.topology_id absent from topologies.topology_id",
      "scene split disagrees with its identity", "nulls violating the schema: pose_rotations"}),
    ({"renders": [(100, 0, 0), (900, 0, 0)], "render_data": [(900, bytearray(b"p"))], "keypoint_vertex_anchor": [(99, 0, 4021)],
      "identities": [(1, 7, "s1", "train"), (2, 8, "s1", "val")]},
     {"POOL MERGE: edit ids in render_data", "keypoint_vertex_anchor.keypoint_id absent from keypoint_defs.keypoint_id",
      "CONTAMINATION: subjects span splits"}),
    ({"edited_renders": [(900, 999, 42, 3, bytearray(b"e"))], "keypoint_vertex_anchor": [(1, None, 4021)], "meshes": [(100, 9, bytearray(b"g"))]},
     {"edited rows whose run precision is unknown", "edited_renders.edit_run_id absent from edit_runs.edit_run_id",
      "edited_renders.render_id absent from renders.render_id", "nulls violating the schema: keypoint_vertex_anchor",
      "keypoint_vertex_anchor.topology_id absent from topologies.topology_id", "meshes.topology_id absent from topologies.topology_id"}),
]


@pytest.mark.parametrize("case", range(len(DEFECTS)))
def test_each_defect_trips_its_check(spark, clean, case):
    rows, expected = DEFECTS[case]
    assert set(failing(spark, spoiled(spark, clean, **rows))) == expected


def test_missing_relations_fail(spark, clean):
    found = corpus_audit.load(spark, clean)
    found.tables = {"edited_renders": found.tables["edited_renders"]}
    assert set(failing(spark, found)) == {"edited_renders present with no edit_runs relation"}
    empty = corpus_audit.load(spark, clean + "/nowhere")
    assert "missing relation: edit_models" in failing(spark, empty)["relations and columns as declared"]


def test_schema_problems_are_strict(spark, clean, tmp_path):
    wrong = spark.createDataFrame([(1, "a", "x")], "keypoint_id long, name string, extra string")
    write_relation(wrong.coalesce(1), f"{tmp_path}/keypoint_defs.parquet")
    found = corpus_audit.load(spark, str(tmp_path)).problems
    assert "keypoint_defs: unexpected column extra" in found
    assert "keypoint_defs: column keypoint_id has type bigint, expected smallint" in found
    loose = corpus_audit.load(spark, str(tmp_path), strict=False).problems
    assert not any("keypoint_defs:" in p for p in loose)


# -- fetch gate ----------------------------------------------------------------------------------------

IMAGES = "image_id long, file_name string, coco_url string, flickr_url string, width long, height long, license_id long"


def images(spark, ids, licence=4, url="u"):
    return spark.createDataFrame([(i, f"{i}.jpg", url, "f", 8, 8, licence) for i in ids], IMAGES)


def world(spark):
    train = images(spark, range(10, 14)).union(images(spark, (20, 21), 5)).union(images(spark, (30,), 7))
    licences = spark.createDataFrame(
        [(4, "Attribution License", "a", False), (5, "Attribution-ShareAlike License", "b", True),
         (7, "No known copyright restrictions", "c", False)],
        "license_id long, name string, url string, share_alike boolean")
    return train, licences, images(spark, (90, 91, 92))


def test_fetch_list_keeps_five(spark, tmp_path):
    path = fetch_gate.build(*world(spark), f"{tmp_path}/out")[0]
    back = spark.read.parquet(path)
    assert back.count() == 5 and back.columns == list(schemas.FETCH_LIST)


@pytest.mark.parametrize("expected", ["holdout images among", "none of the licences is share-alike", "required field missing"])
def test_fetch_gate_refuses_and_writes_nothing(spark, tmp_path, expected):
    train, licences, holdout = world(spark)
    if expected.startswith("holdout"):
        train = train.union(images(spark, (91,)))
    elif expected.startswith("none"):
        licences = licences.withColumn("name", F.when(F.col("license_id") == 5, "CC BY-SA").otherwise(F.col("name")))
    else:
        train = train.union(images(spark, (14,), url=None))
    with pytest.raises(PublishRefused, match=expected):
        fetch_gate.build(train, licences, holdout, f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_annotations_to_images(spark, tmp_path):
    import json

    from corpusgauge.operators.shred import annotation_document
    from corpusgauge.sources.listing import read_annotations

    doc = {
        "images": [{"id": i, "file_name": f"{i}.jpg", "coco_url": "u", "flickr_url": "f", "width": 4, "height": 4, "license": lic}
                   for i, lic in ((1, 1), (2, 1), (3, 2), (4, 1))],
        "annotations": [
            {"id": 9, "image_id": 1, "category_id": 1, "num_keypoints": 8, "keypoints": [1, 2, 2, 3, 4, 1, 5], "bbox": [0, 0, 1, 1],
             "area": 2.5, "iscrowd": 1, "segmentation": [[1, 2, 3, 4], [], [5.5, 6]]},
            {"id": 10, "image_id": 2, "category_id": 1, "num_keypoints": 7, "keypoints": [], "bbox": [0, 0, 1],
             "segmentation": {"counts": [1, 2], "size": [4, 4]}},
            {"id": 11, "image_id": 3, "category_id": 1, "num_keypoints": 17, "keypoints": None, "bbox": None}],
        "categories": [{"id": 1, "name": "person", "supercategory": "animal"}],
        "licenses": [{"id": 1, "name": "Attribution License", "url": "u"}, {"id": 2, "name": "Attribution-NonCommercial License", "url": "v"}],
    }
    (tmp_path / "a.json").write_text(json.dumps(doc))
    flat = annotation_document(read_annotations(spark, {"train": str(tmp_path / "a.json")}))
    assert flat["boxes"].count() == 1
    assert sorted(tuple(r)[1:] for r in flat["keypoints"].collect()) == [(0, 1.0, 2.0, 2.0), (1, 3.0, 4.0, 1.0)]
    assert sorted(tuple(r)[1:] for r in flat["polygons"].collect()) == [(0, [1.0, 2.0, 3.0, 4.0]), (2, [5.5, 6.0])]
    assert sorted((r.area, r.iscrowd) for r in flat["annotations"].collect()) == [(0.0, 0), (0.0, 0), (2.5, 1)]
    assert [r.supercategory for r in flat["categories"].collect()] == ["animal"]
    kept = fetch_gate.commercial_images(flat)
    assert [r.image_id for r in kept["images"].collect()] == [1]  # 4 has no annotation at all
    assert kept["licenses"].count() == 1


def test_payload_magic(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xd8\xffx")), (2, bytearray(b"GIF")), (3, None)], "image_id long, image binary")
    ok, bad = fetch_gate.split_payloads(df)
    assert [r.image_id for r in ok.collect()] == [1] and sorted(r.image_id for r in bad.collect()) == [2, 3]


# -- score tables ----------------------------------------------------------------------------------------

SCORE_ROWS = {
    "root": [("ex/a", "speech_edit", "overall", "input_audio", "a.wav", "wav_16khz")],
    "candidates": [("ex/a", "audio", 1, "r1.wav", "wav_16khz", "identity"), ("ex/a", "edit", 1, "m.npz", "soma_mesh", "anything")],
    "scores": [("ex/a", "audio", 1, -1, "wer", 0.0)],
    "root_extras": [("ex/a", "text", "hello", "text_utf8")],
    "candidate_extras": [("ex/a", "audio", 1, "text", "hello", "text_utf8")],
}


@pytest.mark.parametrize("name,row,expected", [
    (None, None, None),
    ("root", ("ex/a", "FAKE_TASK", "overall", "c", "a", "png"), {"root.task_type vocabulary"}),
    ("candidates", ("ex/a", "audio", 1, "r.wav", "wav_16khz", "facs_02"), {"candidates.candidate_kind by axis"}),
    ("scores", ("ex/zzz", "audio", 1, -1, "wer", 0.0), {"scores row_key joins a root key"}),
    ("scores", ("ex/a", "audio", 1, -1, "made_up", 0.0), {"scores.metric_name vocabulary"}),
    ("scores", ("ex/a", "audio", 1, -1, "wer", float("nan")), {"scores nulls"}),
])
def test_score_tables(spark, name, row, expected):
    rows = {**SCORE_ROWS, **({name: [row]} if name else {})}
    tables = {n: spark.createDataFrame(r, schemas.struct(schemas.SCORE_DDL[n])) for n, r in rows.items()}
    bad = {r.name for r in score_audit.checks(tables).where("state = 'FAIL'").collect()}
    assert bad == (expected or set())


def stub(spark):
    root = spark.createDataFrame([("ex/a", "col", "a.png", "x.json"), ("ex/b", "col", "b.png", "y.json")],
                                 "key string, input_column string, input_asset string, json string")
    # the same candidate name ranks differently under the two roots
    cands = spark.createDataFrame([("ex/a", "c1", 1, "p"), ("ex/a", "c5", 5, "q"), ("ex/b", "c1", 5, "r"), ("ex/b", "c5", 1, "s")],
                                  "row_key string, candidate string, rank int, candidate_asset string")
    scores = spark.createDataFrame([(k, c, v, 0.1, 0.2, 0.9) for k in ("ex/a", "ex/b") for c in ("c1", "c5") for v in range(3)],
                                   "row_key string, candidate string, view_index int, depth_l1 double, normal_l1 double, normal_dot double")
    return root, cands, scores


def test_port_ranks_within_the_root(spark):
    ported = score_audit.port(*stub(spark), "depth_edit", "overall", "png", "aov_npz", "json")
    assert not score_audit.checks(ported).where("state = 'FAIL'").collect()
    got = {(r.row_key, r.candidate_rank) for r in ported["scores"].collect()}
    assert got == {("ex/a", 1), ("ex/a", 5), ("ex/b", 1), ("ex/b", 5)} and ported["scores"].count() == 36


def test_nested_view(spark):
    root, cands, scores = stub(spark)
    extra = spark.createDataFrame([("ex/a", "c7", 7, "t")], cands.schema)  # a candidate without scores
    wide, bad = score_audit.nested(root, cands.union(extra), scores)
    assert not bad.collect()
    got = sorted((r.key, len(r.scores)) for r in wide.collect())
    assert got == [("ex/a", 0), ("ex/a", 3), ("ex/a", 3), ("ex/b", 3), ("ex/b", 3)]
    rogue = spark.createDataFrame([("ex/a", "rank99", 0, 0.1, 0.2, 0.9)], scores.schema)
    assert [r.name for r in score_audit.nested(root, cands, scores.union(rogue))[1].collect()] == ["scores join a candidate"]


# -- distribution ------------------------------------------------------------------------------------------

def population(spark, n=3000, **spoil):
    import numpy as np

    rng = np.random.default_rng(0)
    names = list(distribution_audit.PHENOTYPES)
    v = {k: rng.uniform(0, 1, n) for k in names}
    v.update({k: x for k, x in spoil.items() if k in names})
    ids = [(i, i, spoil.get("subject", lambda i: f"s{i}")(i), spoil.get("split", lambda i: "val" if i % 50 == 0 else "train")(i)) for i in range(n)]
    adult = v["age"] > 0.55
    h = np.where(adult, 1.70 + 0.06 * (0.5 - v["gender"]) * 2, 0.8 + 0.9 * np.minimum(v["age"] / 0.55, 1) * 0.9)
    h = h + spoil.get("noise", rng.normal(0, 0.09, n)) * adult
    h = spoil.get("stature", lambda x: x)(h)
    identities = spark.createDataFrame(ids, "identity_id int, seed long, source_subject string, split string")
    phen = spark.createDataFrame(list(enumerate(names)), "phenotype_id int, name string")
    values = spark.createDataFrame([(i, k, float(v[c][i])) for k, c in enumerate(names) for i in range(n)],
                                   "identity_id int, phenotype_id int, value double")
    boxes = spark.createDataFrame([(i, 0.5, 0.3, float(h[i]), -0.25, 0.25) for i in range(n)],
                                  "identity_id int, extent_x double, extent_y double, extent_z double, lo_x double, hi_x double")
    return identities, phen, values, boxes


def blocked(spark, **spoil):
    rows = distribution_audit.checks(*population(spark, **spoil)).collect()
    return {r.name for r in rows if r.state == "FAIL"}


def test_distribution_clean(spark):
    assert blocked(spark) == set()


def test_distribution_defects(spark):
    import numpy as np

    half = np.full(3000, 0.5)
    assert "sex subgroups present" in blocked(spark, gender=half)
    assert "no collapsed dimension" in blocked(spark, muscle=half)
    rng = np.random.default_rng(2)
    with_nan, beyond = rng.uniform(0, 1, 3000), rng.uniform(0, 1, 3000)
    with_nan[:50], beyond[:20] = np.nan, 5.0
    assert blocked(spark, weight=with_nan) == {"no NaN/Inf in attribute values"}
    assert blocked(spark, weight=beyond) == {"attributes within [0,1]"}
    assert "child subgroup present" in blocked(spark, age=np.full(3000, 0.8))
    assert {"stature is in metres", "adult stature band"} <= blocked(spark, stature=lambda h: h * 100)
    assert blocked(spark, subject=lambda i: "s0" if i < 200 else f"s{i}") == {"subjects stay in one split"}
    assert blocked(spark, split=lambda i: "train") == {"val split is non-empty and small"}
