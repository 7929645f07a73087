"""Running sums, quantiles, ids and the skew-aware join against plain Python."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators.components import connected_components
from reviewlens.operators.ordered import exact_quantiles, join_heavy, with_dense_ids, with_running_sums


@pytest.mark.parametrize("slices", [1, 4, 16])
def test_running_sums_do_not_depend_on_slices(spark, slices):
    rows = [(k, i, (i * 7) % 11) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, v long").repartition(5)
    found = {(r.k, r.i): r.total for r in with_running_sums(df, ["k"], ["i"], {"total": "v"}, slices).collect()}
    for k in "ab":
        total = 0
        for i in range(200):
            total += (i * 7) % 11
            assert found[(k, i)] == total


def test_dense_ids_follow_the_order(spark):
    words = sorted({f"w{i * 37 % 1000}" for i in range(500)} | {"é", "z", "Ω", "𝒳"})
    df = spark.createDataFrame([(w,) for w in reversed(words)], "w string")
    found = {r.w: r.id for r in with_dense_ids(df, ["w"], "id", start=2).collect()}
    assert found == {w: i + 2 for i, w in enumerate(words)}


def test_quantiles_match_linear_interpolation(spark):
    rng = random.Random(1)
    rows = [(k, float(rng.randint(0, 30))) for k in ("a", "b", None) for _ in range(101 if k else 2)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = exact_quantiles(df, ["k"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.9}).collect()
    assert len(found) == 3
    for row in found:
        values = [v for k, v in rows if k == row.k]
        for name, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.9)):
            assert row[name] == pytest.approx(np.quantile(values, p))
        assert row.q2 == pytest.approx(statistics.median(values))
    (whole,) = exact_quantiles(df, [], "v", {"m": 0.5}).collect()
    assert whole.m == pytest.approx(statistics.median(v for _, v in rows))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_heavy_equals_plain_join_when_a_key_is_hot(spark, how):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(3000)] + [("lost", -1), (None, -2)]
    left = spark.createDataFrame(rows, "k string, i long")
    right = left.filter("k <> 'lost'").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.length("k"))
    plain = left.join(right.drop("n"), "k", how)
    found = join_heavy(left, right, ["k"], "n", "i", how, share=20, floor=1)
    assert sorted(map(tuple, found.select("k", "i", "v").collect()), key=repr) == sorted(
        map(tuple, plain.select("k", "i", "v").collect()), key=repr
    )


def test_join_heavy_cuts_the_hot_key(spark):
    left = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("i"))
    right = spark.createDataFrame([("hot", 2000, 1)], "k string, n long, v int")
    text = join_heavy(left, right, ["k"], "n", "i", share=10, floor=1)._jdf.queryExecution().toString()
    assert "_piece" in text


def test_components_of_paths_cycles_and_stars(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loop = [(1000 + i, 1000 + (i + 1) % 30) for i in range(30)]
    loose = [(rng.randint(2000, 2060), rng.randint(2000, 2060)) for _ in range(40)]
    edges = path + star + loop + loose
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.vertex: r.component for r in found.collect()} == {x: find(x) for x in list(parent)}
