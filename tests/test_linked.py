"""Sums along linked lists against plain loops."""

import random

import pytest

from corpusgauge.operators.linked import list_sums


def lists(n, n_lists, seed=3):
    r = random.Random(seed)
    ids = r.sample(range(10 * n), n)
    edges = sorted(r.sample(range(1, n), n_lists - 1))
    rows, want = [], {}
    for a, b in zip([0, *edges], [*edges, n], strict=True):
        total, weight = 0, 0.0
        for k in range(a, b):
            rows.append((ids[k], ids[k + 1] if k + 1 < b else None, k % 7, k * 0.5))
            want[ids[k]] = (total, weight)
            total, weight = total + k % 7, weight + k * 0.5
    r.shuffle(rows)
    return rows, want


@pytest.mark.parametrize("at_once", [1 << 18, 40])
def test_sums_before_each_element(spark, at_once):
    rows, want = lists(700, 3)
    links = spark.createDataFrame(rows, "id long, next long, a long, b double").repartition(5)
    found = {r.id: (r.a, r.b) for r in list_sums(links, ["a", "b"], at_once=at_once).collect()}
    assert found == want


def test_a_chain_of_one_home_is_contracted_where_it_is_read(spark):
    rows = [(i, i + 1 if i < 9_999 else None, 1) for i in range(10_000)]
    links = spark.createDataFrame(rows, "id long, next long, a long").repartition(7)
    from pyspark.sql import functions as F
    found = {r.id: r.a for r in list_sums(links, ["a"], [F.lit(0)], at_once=50).collect()}
    assert found == {i: i for i in range(10_000)}


def test_empty_and_single(spark):
    links = spark.createDataFrame([(5, None, 3)], "id long, next long, a long")
    assert [tuple(r) for r in list_sums(links, ["a"]).collect()] == [(5, 0)]
    assert list_sums(links.limit(0), ["a"]).collect() == []


def test_values_may_be_called_n(spark):
    links = spark.createDataFrame([(i, i + 1 if i < 99 else None, 1) for i in range(100)], "id long, next long, n long").repartition(5)
    assert {r.id: r.n for r in list_sums(links, ["n"], at_once=10).collect()} == {i: i for i in range(100)}
