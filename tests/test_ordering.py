"""Ordered computations against pandas, over several chunks and with one group holding a third."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusgauge.operators import ordering
from corpusgauge.operators.compare import unwrapped
from corpusgauge.operators.prepare import hash_sample, shard_by_bytes, stride_split
from corpusgauge.operators.stats import apportion, tail_means


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    g = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 400, n))  # group 0 holds a third
    v = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 50, n).astype(float))
    return pd.DataFrame({"id": rng.permutation(n), "g": g, "v": v})


def load(spark, frame, parts=5):
    df = spark.createDataFrame(frame.astype({"g": "int64", "id": "int64"}))
    return df.withColumn("v", F.nanvl("v", F.lit(None).cast("double"))).repartition(parts)


def result(df, *cols):
    return df.select(*cols).toPandas().sort_values(cols[0]).reset_index(drop=True)


def test_row_numbers(many_chunks, frame):
    got = result(ordering.row_numbers(load(many_chunks, frame), ["id"], "n"), "id", "n")
    assert (got.id == got.n).all()
    grouped = result(ordering.row_numbers(load(many_chunks, frame), ["id"], "n", ["g"], size="size"), "id", "n", "size")
    want = frame.sort_values("id")
    assert grouped.n.tolist() == want.groupby("g").cumcount().tolist()
    assert grouped["size"].tolist() == want.groupby("g").id.transform("size").tolist()


def test_running_total_ignores_partitioning(many_chunks, frame):
    want = frame.fillna(0).sort_values("id")
    want["t"] = want.groupby("g").v.cumsum()
    for parts in (1, 7):
        df = load(many_chunks, frame, parts)
        got = result(ordering.running_total(df, ["id"], F.coalesce("v", F.lit(0.0)), "t", ["g"]), "id", "t")
        assert np.allclose(got.t, want.t)


def test_neighbours_cross_chunks(many_chunks, frame):
    df = load(many_chunks, frame)
    want = frame.sort_values("id")
    for ahead, shift in ((True, -1), (False, 1)):
        got = result(ordering.neighbour(df, ["id"], F.col("id"), "x", ["g"], ahead=ahead), "id", "x")
        expected = want.groupby("g").id.shift(shift)
        assert got.x.fillna(-1).tolist() == expected.fillna(-1).tolist()


def test_ring_wraps(many_chunks, frame):
    got = result(ordering.ring_next(load(many_chunks, frame), ["id"], F.col("id"), "x"), "id", "x")
    assert got.x.tolist() == [*range(1, len(frame)), 0]


def test_first_at_or_after(many_chunks, frame):
    got = result(ordering.first_at_or_after(load(many_chunks, frame), ["id"], F.col("v"), "x", ["g"]), "id", "x")
    want = frame.sort_values("id")
    ahead = want.groupby("g").v.bfill()
    last = want.groupby("g").v.transform(lambda s: s.dropna().iloc[-1] if s.notna().any() else np.nan)
    assert np.allclose(got.x, ahead.fillna(last), equal_nan=True)


def test_exact_percentiles(many_chunks, frame):
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    got = ordering.exact_percentiles(load(many_chunks, frame), "v", probs, ["g"]).toPandas()
    for (g, p), q in got.set_index(["g", "p"]).q.items():
        assert np.isclose(q, np.percentile(frame[frame.g == g].v.dropna(), p * 100))
    whole = ordering.exact_percentiles(load(many_chunks, frame), "v", [0.5]).collect()
    assert np.isclose(whole[0].q, np.percentile(frame.v.dropna(), 50))


def test_unwrap_matches_numpy(many_chunks):
    rng = np.random.default_rng(5)
    angles = np.concatenate([rng.uniform(-180, 180, 200), [0, 180, 0, -180, 0]])
    df = many_chunks.createDataFrame([(int(i), float(a)) for i, a in enumerate(angles)], "i long, a double")
    got = result(unwrapped(df, ["i"], "a", "u"), "i", "u")
    assert np.allclose(got.u, np.degrees(np.unwrap(np.radians(angles))))


def test_stride_split_and_sample_ignore_partitioning(many_chunks, frame):
    out = []
    for parts in (1, 7):
        df = load(many_chunks, frame, parts)
        split = result(stride_split(df, ["id"], 0.12), "id", "split")
        assert (split.split == np.where(split.id % 8 == 0, "val", "train")).all()
        out.append(result(hash_sample(df, "id", 50, "s"), "id").id.tolist())
    assert out[0] == out[1] and len(out[0]) == 50


def test_shards_keep_every_byte(many_chunks):
    rows = [(i, "x" * (i % 97)) for i in range(2000)]
    df = many_chunks.createDataFrame(rows, "i long, t string")
    got = result(shard_by_bytes(df, ["i"], F.col("t"), 1000), "i", "shard", "_bytes")
    assert got._bytes.sum() == sum(len(t) for _, t in rows)
    assert got.shard.is_monotonic_increasing and got.groupby("shard")._bytes.sum().max() < 1000 + 97


def test_tail_means_need_twenty_rows(many_chunks, frame):
    df = load(many_chunks, frame).where("v is not null")
    got = tail_means(df, "g", "v", ["id"]).toPandas().set_index("g")
    for g, rows in frame.dropna().groupby("g"):
        v = np.sort(rows.v.to_numpy())
        k = max(1, len(v) // 10)
        if len(v) < 20:
            assert np.isnan(got.top[g]) and np.isnan(got.bottom[g])
        else:
            assert np.isclose(got.top[g], v[-k:].mean()) and np.isclose(got.bottom[g], v[:k].mean())


def test_apportion(many_chunks):
    def shares(**kw):
        return many_chunks.createDataFrame(list(kw.items()), "name string, share double")

    got = lambda df, total, floor: dict(apportion(df, "name", "share", total, floor).collect())
    out = got(shares(a=50.0, b=38.0, c=6.0, d=0.0), 1000, 90)
    assert sum(out.values()) == 1000 and out["d"] == 90
    assert got(shares(a=0.0, b=0.0, c=0.0), 10, 0) == {"a": 4, "b": 3, "c": 3}
    with pytest.raises(Exception, match="does not fit"):
        got(shares(a=1.0, b=1.0), 10, 6)
