"""Nearest neighbours, word error rate and the other scalar functions against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgauge.functions import angles, geometry, ids, text, vectors
from corpusgauge.operators import nearest


@pytest.mark.parametrize("dims,block", [(3, 50), (16, 200)])
def test_nearest_is_exact(spark, monkeypatch, dims, block):
    monkeypatch.setattr(nearest, "BLOCK", block)  # many blocks and chunks
    rng = np.random.default_rng(dims)
    s = rng.normal(size=(700, dims)).round(3)
    s[:250] = s[0]  # copies: a third of the sources
    t = np.concatenate([rng.normal(size=(120, dims)).round(3), s[:5]])
    sdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(s)], "id long, v array<double>")
    tdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(t)], "id long, v array<double>")
    got = {r.t_id: (r.s_id, r.d2) for r in nearest.nearest(tdf, "id", "v", sdf, "id", "v").collect()}
    d2 = ((t[:, None] - s[None]) ** 2).sum(-1)
    assert len(got) == len(t)
    for i, (j, d) in got.items():
        assert j == d2[i].argmin() and math.isclose(d, d2[i].min(), abs_tol=1e-12)
    same = {r.t_id: r.s_id for r in nearest.nearest(sdf, "id", "v", sdf, "id", "v", skip_same=True).collect()}
    d2 = ((s[:, None] - s[None]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    assert all(same[i] == d2[i].argmin() for i in range(len(s)))


def test_nearest_of_nothing(spark):
    t = spark.createDataFrame([(1, [0.0])], "id long, v array<double>")
    assert nearest.nearest(t, "id", "v", t.limit(0), "id", "v").collect()[0].s_id is None
    assert nearest.nearest(t, "id", "v", t, "id", "v", skip_same=True).count() == 0


def test_nearest_by_projection_and_its_recall(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24)) * 3
    s = centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, 24)) * 0.4
    s[:400] = s[0]  # a bucket of copies is measured whole
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(s)], "id long, v array<double>").repartition(4)
    exact = {r.t_id: r.d2 for r in nearest.nearest(df, "id", "v", df, "id", "v", skip_same=True).collect()}
    near = {r.t_id: r.d2 for r in nearest.nearest_by_projection(df, "id", "v", df, "id", "v", skip_same=True).collect()}
    assert all(near[i] >= d - 1e-9 for i, d in exact.items() if i in near)
    assert np.mean([math.isclose(near.get(i, -1.0), d, abs_tol=1e-9) for i, d in exact.items()]) >= 0.9


def test_vectors_with_holes_find_nothing(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = [tuple(r) for r in nearest.nearest(df, "id", "v", df, "id", "v", skip_same=True).orderBy("t_id").collect()]
    assert got == [(1, 5, 25.0), (5, 1, 25.0)]


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def test_word_edits_match_the_table(spark):
    rng = np.random.default_rng(1)
    word = lambda k: f"w{k}" if k % 3 else "é" * k
    pairs = [tuple([word(k + 1) for k in rng.integers(0, 9, rng.integers(1, 60))] for _ in range(2)) for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in df.withColumn("got", text.word_error_rate(F.col("a"), F.col("b"))).collect():
        a, b = pairs[r.i]
        assert math.isclose(r.got, plain_edits(a, b) / len(a))


def test_word_error_rate(spark):
    rows = [("turn on the lights", "turn off lights now", 0.75), ("Same  Words", "same words", 0.0), ("", "", 0.0),
            (" ", "anything", 1.0), ("a b", "", 1.0), ("a", "b c d", 3.0), ("w " * 3000, "w " * 2500, 500 / 3000)]
    df = spark.createDataFrame(rows, "r string, h string, want double")
    for r in df.withColumn("got", text.word_error_rate(F.col("r"), F.col("h"))).collect():
        assert math.isclose(r.got, r.want)


def test_query_wer_by_brute_force(spark):
    from corpusgauge.bindings import QUERIES

    folder = "/root/testdata/sf0.001"
    turns = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()}
    got = {(r.conv_id, r.turn): r.wer for r in QUERIES["wer"](spark, folder).collect()}
    want = {}
    for (c, t), said in turns.items():
        later = [u for (d, u) in turns if d == c and u > t]
        if later:
            a, b = said.lower().split(), turns[c, min(later)].lower().split()
            want[c, t] = round(plain_edits(a, b) / len(a), 6) if a else float(bool(b))
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=2e-6) for k in want)


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_ids(spark):
    want = int.from_bytes(hashlib.blake2b(b"x|1|y", digest_size=8).digest(), "big") & ((1 << 63) - 1)
    a, b, c = one(spark, ids.blake_id(F.lit("x"), F.lit(1), F.lit("y")), ids.sha_id(F.lit("x"), F.lit(1)), ids.fold_31(F.lit(want)))
    assert a == want and b == int(hashlib.sha256(b"x|1").hexdigest()[:15], 16) and c == want % (2**31 - 1)
    n = spark.range(20000).select(ids.hash_split(ids.sha_id(F.col("id")), 0.02, 0.01).alias("s")).groupBy("s").count()
    got = dict(n.collect())
    assert abs(got["val"] - 400) < 100 and abs(got["test"] - 200) < 80


def test_angles(spark):
    got = one(spark, *[angles.wrap(F.lit(float(a))) for a in (350 - 10, -180, 180, 540, 0)])
    assert list(got) == [-20, -180, -180, -180, 0]
    assert math.isclose(one(spark, angles.azimuth(F.lit(1.0), F.lit(1.0)))[0], 45)


def test_text_functions(spark):
    got = one(
        spark,
        text.clock(F.lit(59.9996)), text.clock(F.lit(3723.5)),
        text.phrase_slug(F.lit("<t> right side view eye-level shot medium"), "<t>"),
        text.file_stem(F.lit("Grid: 96 poses of (x)")), text.plain_name(F.lit("Brow_Down-L 2")),
        text.scrub_paths(F.lit("none in C:\\Users\\me\\az045.png at 0.3, /Users/me/x/y.txt")),
        text.judge_answer(F.lit("<channel|> 87. ok")), text.judge_answer(F.lit("12 then 2019 and 45")), text.judge_answer(F.lit("none")),
        text.has_marker(F.lit("a/VAL2017/b.png")), text.is_absolute(F.lit("O:/x")), text.is_absolute(F.lit("renders/x")),
        text.first_nonblank(F.lit("  "), F.lit(None).cast("string"), F.lit(" b ")),
    )
    assert list(got) == [
        "00:01:00.000", "01:02:03.500", "right-side-view_eye-level-shot_medium", "grid-96-poses-of-x", "browdownl2",
        "none in az045.png at 0.3, y.txt", 87, 45, None, "val2017", True, False, "b",
    ]


def test_rotation_and_cosine(spark):
    x, y, z = geometry.rotate((F.lit(1.0), F.lit(0.0), F.lit(0.0)), (F.lit(0.0), F.lit(0.0), F.lit(90.0)), "yxz")
    got = one(spark, x, y, z, vectors.cosine(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(2.0), F.lit(4.0))))
    assert np.allclose(list(got), [0, 1, 0, 1], atol=1e-8)


def distances(df):
    return {(r.g, repr(r.x), repr(r.y)): (r.n, r.distance) for r in df.collect()}


def test_lattice_distance_equals_brute_force(many_chunks):
    r = random.Random(8)
    mask = {("a", r.randrange(-30, 40), r.randrange(0, 9)) for _ in range(60)} | {("b", 1_000_000, -5), ("b", 0, 0)}
    mask |= {("hot", r.randrange(300), r.randrange(300)) for _ in range(400)}
    asked = [("a", r.uniform(-90, 90), float(r.randrange(-50, 50))) for _ in range(80)] + [("a", 3.0, 3.0)] * 5
    asked += [("b", 499_999.0, 0.0), ("b", 500_001.5, 0.0), ("b", -1e9, 1e9), ("none", 1.0, 2.0)]
    asked += [("hot", r.uniform(-20, 320), r.uniform(-20, 320)) for _ in range(150)]
    points = many_chunks.createDataFrame(asked, "g string, x double, y double").repartition(5)
    cells = many_chunks.createDataFrame(sorted(mask) * 2, "g string, x long, y long").repartition(3)
    got = distances(nearest.lattice_distance(points, cells, "g", "x", "y"))
    assert len(got) == len(set(asked))
    for g, x, y in asked:
        near = [math.hypot(x - cx, y - cy) for h, cx, cy in mask if h == g]
        n, d = got[g, repr(x), repr(y)]
        assert n == asked.count((g, x, y))
        assert d == pytest.approx(min(near)) if near else d is None


def test_lattice_distance_of_points_that_are_nowhere(spark):
    nan, inf = float("nan"), float("inf")
    asked = [("a", nan, 1.0), ("a", None, 1.0), ("a", 1.0, None), ("a", inf, 1.0), ("a", 1.0, -inf), ("a", 4.0, 5.0), (None, 1.0, 1.0)]
    points = spark.createDataFrame(asked, "g string, x double, y double")
    cells = spark.createDataFrame([("a", 1, 1), ("a", None, 1), (None, 1, 2)], "g string, x long, y long")
    got = distances(nearest.lattice_distance(points, cells, "g", "x", "y"))
    assert len(got) == 7
    assert got["a", "4.0", "5.0"] == (1, 5.0)
    assert all(d is None for (g, x, y), (n, d) in got.items() if g == "a" and x != "4.0")
    none = nearest.lattice_distance(points, cells.limit(0), "g", "x", "y")
    assert [r.distance for r in none.collect()] == [None] * 7


def test_points_of_small_masks_meet_one_row_and_nothing_is_written(spark, monkeypatch):
    def written(df, label):
        raise AssertionError(label)

    monkeypatch.setattr(nearest, "cut", written)
    r = random.Random(3)
    mask = {(g, r.randrange(-9, 54), r.randrange(40, 100)) for g in ("a", "b") for _ in range(200)} | {("c", -9, 103), ("c", 54, 40)}
    asked = [(g, r.uniform(-90, 90), r.uniform(-50, 150)) for g in ("a", "b", "c", "none") for _ in range(30)] + [("c", -9.0, 103.0), ("c", 1e300, 0.0)]
    points, cells = spark.createDataFrame(asked, "g string, x double, y double"), spark.createDataFrame(sorted(mask) * 2, "g string, x long, y long")
    got = distances(nearest.lattice_distance(points, cells, "g", "x", "y"))
    for g, x, y in asked:
        near = [math.hypot(x - cx, y - cy) for h, cx, cy in mask if h == g]
        d = got[g, repr(x), repr(y)][1]
        assert d == (pytest.approx(min(near)) if near and x < 1e9 else float("inf") if near else None)


def test_a_target_travels_once_to_each_bundle_of_cells(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 256)
    visits, met = [], nearest._met
    monkeypatch.setattr(nearest, "_met", lambda s, t, skip: visits.append(t.count()) or met(s, t, skip))
    vectors = np.random.Generator(np.random.PCG64(5)).normal(size=(1000, 32))  # so far apart that no cell is ruled out
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")
    got = {r.t_id: r.s_id for r in nearest.nearest(df, "id", "v", df, "id", "v", skip_same=True).collect()}
    gap = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2) + np.diag(np.full(1000, np.inf))
    assert got == dict(enumerate(gap.argmin(axis=1).tolist()))
    assert visits[0] == 1000 and visits[1] <= 8 * 1000
