"""A JSON map read by byte ranges, and the catalogue made from it."""

import json

import pytest

from corpusgauge.plans import model_catalogue
from corpusgauge.sources.jsonmap import read_json_map, write_json_map

NASTY = {
    "plain": {"a": 1, "b": [1, {"c": "}"}, []]}, "quotes \" and { braces }, \\": 'x"}{,\\', "empty": {}, "list": [], "number": 3,
    "deep": {"x": {"y": {"z": [[["},{"]]]}}}, "uni ö}": "日本}語 \\\" ,", "long": "word } , { " * 400, "slash": "\\\\", "null": None,
}


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def entries(spark, path):
    rows = read_json_map(spark, str(path)).orderBy("file", "block", "n").collect()
    return [item for r in rows for item in json.loads(r.entry).items()]


@pytest.mark.parametrize("indent, tail", [(None, ""), (2, "\n"), (None, " \n\n")])
def test_entries_that_cross_ranges(small_ranges, tmp_path, indent, tail):
    file = tmp_path / "map.json"
    file.write_text("\n " + json.dumps(NASTY, indent=indent, ensure_ascii=False) + tail)
    assert entries(small_ranges, file) == list(NASTY.items())
    assert read_json_map(small_ranges, str(file)).select("block").distinct().count() >= 3


def test_several_files_and_empty_maps(small_ranges, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.json").write_text(json.dumps({f"{i}-{k}": {"v": "}" * k} for k in range(i * 5)}))
    found = dict(entries(small_ranges, tmp_path))
    assert found == {f"{i}-{k}": {"v": "}" * k} for i in range(4) for k in range(i * 5)}


@pytest.mark.parametrize("text", ['{"a": {"b": 1}', '{"a": "b}'])
def test_a_map_that_is_cut_off_raises(small_ranges, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(ValueError, match="no closed JSON map"):
        read_json_map(small_ranges, str(tmp_path))


def test_write_and_read(spark, tmp_path):
    df = spark.createDataFrame([(f'k"{i}', json.dumps({"i": i})) for i in range(50)], "k string, v string").repartition(4)
    write_json_map(df, "k", "v", str(tmp_path / "maps"))
    assert dict(entries(spark, tmp_path / "maps")) == {f'k"{i}': {"i": i} for i in range(50)}


MODELS = {
    "m1": {"name": "one", "license": "Free", "isRigged": True, "glb_paths": ["a.glb", "b_1024.glb", "c_2048.glb", "d_2048.glb"], "categories": ["x", "y"], "tags": ["t"]},
    "m2": {"license": "Free", "vertexCount": 7, "glb_paths": [], "tags": None},
    "m3": {"name": "three", "license": "Closed", "glb_paths": ["e.glb"]},
    "m4": {"name": "four", "glb_paths": ["f.glb"]},
    "m5": {"name": "five", "license": "Shared", "glb_paths": ["g.glb", None], "isRigged": True},
}
FREE = [("Shared", True), ("Free", False)]


def catalogued(spark, tmp_path, text, **settings):
    (tmp_path / "map.json").write_text(text)
    found = model_catalogue.read_catalogue(spark, str(tmp_path / "map.json"), FREE, **settings)
    return {k: sorted(tuple(r) for r in v.collect()) for k, v in found.items()}


def test_catalogue(spark, tmp_path):
    got = catalogued(spark, tmp_path, json.dumps(MODELS))
    assert got["histogram"] == [("", 1, False), ("Closed", 1, False), ("Free", 2, True), ("Shared", 1, True)]
    assert got["licenses"] == [(0, "Free", False), (1, "Shared", True)]
    assert got["models"] == [("m1", "one", "", 0, 0, 0, 0, True, 0), ("m2", "", "", 0, 7, 0, 0, False, 0), ("m5", "five", "", 1, 0, 0, 0, True, 0)]
    assert got["best"] == [("m1", "c_2048.glb", 2048), ("m5", "g.glb", 0)]
    assert got["categories"] == [("m1", "x"), ("m1", "y")] and got["tags"] == [("m1", "t")]
    assert got["problems"] == [("m5", "has a NULL path, category or tag")]
    assert [r[0] for r in catalogued(spark, tmp_path, json.dumps(MODELS), rigged_only=True)["models"]] == ["m1", "m5"]


def test_catalogue_names_what_is_no_record(spark, tmp_path):
    got = catalogued(spark, tmp_path, '{"a": 3, "b": {"license": "Free"}, "b": {"license": "Free"}}')
    assert ("b", "occurs more than once") in got["problems"] and any(p == "is no model record" for _, p in got["problems"])


def test_catalogue_of_listed_ids(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("m2\n\n m5 \nunknown\n")
    got = catalogued(spark, tmp_path, json.dumps(MODELS), ids_path=str(tmp_path / "ids.txt"))
    assert [r[0] for r in got["models"]] == ["m2", "m5"] and len(got["histogram"]) == 4
    with pytest.raises(Exception, match="ids"):
        catalogued(spark, tmp_path, json.dumps(MODELS), ids_path=str(tmp_path / "no-ids.txt"))
    (tmp_path / "blank-ids.txt").write_text("\n\n")
    with pytest.raises(ValueError, match="lists no model"):
        catalogued(spark, tmp_path, json.dumps(MODELS), ids_path=str(tmp_path / "blank-ids.txt"))
