"""The index of committed keys, and the streams that use it."""

import random
from datetime import datetime, timedelta

from corpusgauge.sources.catalog import remove
from corpusgauge.streaming import keys
from corpusgauge.streaming.incremental import finished, log_stream, shards
from corpusgauge.streaming.keys import KeyIndex


def frame(spark, ids):
    return spark.createDataFrame([(i, "x" if i is None or i % 2 else None) for i in ids], "id long, kind string")


def files(path):
    return sorted(str(p.relative_to(path)).rsplit("/", 1)[0] for p in path.rglob("*.parquet"))


def test_runs_cover_all_earlier_batches():
    index = KeyIndex(None, "r", ["id"], fanout=8)
    for before in (0, 1, 7, 8, 9, 63, 64, 100, 1000):
        runs = list(index.runs(before))
        assert [b for level, first in runs for b in range(first, first + 8**level)] == list(range(before))
        assert len(runs) <= 7 * 4
    assert list(index.runs(100)) == [(2, 0), (1, 64), (1, 72), (1, 80), (1, 88), (0, 96), (0, 97), (0, 98), (0, 99)]


def test_batches_open_only_parts_that_may_hold_their_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ["id", "kind"], fanout=3, parts=4)
    r, seen = random.Random(1), []
    for batch in range(11):
        new = list(range(100 * batch, 100 * batch + 30)) + ([None] if batch == 2 else [])
        old = r.sample(seen, 3) if seen else []
        held = index.held(frame(spark, new + old + old), batch)
        assert (held is None) == (batch == 0)
        if held is not None:
            assert sorted(x.id for x in held.collect()) == sorted(old)
            assert 1 <= len(index.opened) <= 8  # three keys, and a few that a filter takes for known
        index.add(frame(spark, new), batch)
        seen += [i for i in new if i is not None]
    # batches 0 to 8 are merged; what the merges of batch 8 read is still there for a replay of it, older runs are gone
    runs = {x.split("/part=")[0] for x in files(tmp_path / "keys")}
    assert runs == {"level=2/first=0", "level=0/first=9", "level=0/first=10"}
    assert index.held(frame(spark, range(5000, 5030)), 11).count() == 0 and len(index.opened) <= 2
    assert [tuple(x) for x in index.held(frame(spark, [None, 7]), 11).orderBy("id").collect()] == [(None, "x"), (7, "x")]


def test_a_batch_of_many_keys_does_not_ask_the_filters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "FEW", 20)
    index = KeyIndex(spark, str(tmp_path), ["id", "kind"], fanout=3, parts=4)
    for batch in range(4):
        index.add(frame(spark, range(100 * batch, 100 * batch + 30)), batch)
    remove(spark, f"{tmp_path}/filters")
    found = index.held(frame(spark, [*range(20, 120), 329, 330, None]), 4)
    assert sorted(r.id for r in found.collect()) == [*range(20, 30), *range(100, 120), 329]
    assert [x.split("keys/")[1] for x in index.opened] == ["level=1/first=0", "level=0/first=3"]


def test_a_replayed_batch_leaves_the_same(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ["id"], fanout=2, parts=2)
    for batch in range(4):
        index.add(frame(spark, range(10 * batch, 10 * batch + 10)), batch)
    before = files(tmp_path)
    assert sorted(x.id for x in index.held(frame(spark, range(25, 35)), 3).collect()) == [25, 26, 27, 28, 29]
    index.add(frame(spark, range(30, 40)), 3)
    assert files(tmp_path) == before
    assert index.held(frame(spark, range(0, 60)), 4).count() == 40


def test_a_key_is_logged_once_for_ever(spark, tmp_path):
    at = lambda hours: datetime(2024, 1, 1) + timedelta(hours=hours)
    batches = [[(1, at(0), "a"), (2, None, "b"), (2, None, "c")], [(1, at(10), "again"), (2, None, "again"), (3, at(10), "d")],
               [(1, at(30), "again"), (3, None, "again"), (4, at(2), "late"), (5, None, "e")], [(4, at(30), "in time")]]
    schema = spark.createDataFrame(batches[0], "id int, ts timestamp, v string").schema
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = log_stream(shards(spark, f"{tmp_path}/in", schema), ["id"], "ts", "1 hour", f"{tmp_path}/out")
        log = finished(q, lambda: spark.read.schema(schema).parquet(f"{tmp_path}/out/log"))
    assert sorted((r.id, r.v) for r in log.collect()) == [(1, "a"), (2, "b"), (3, "d"), (4, "in time"), (5, "e")]
    assert [r.v for r in spark.read.schema(schema).parquet(f"{tmp_path}/out/late").collect()] == ["late"]
