import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgate.operators.neighbours import nearest_neighbours
from weirgate.operators.smote import smote


def points(spark, array, copies=None):
    rows = [(i, [float(x) for x in row], 1 if copies is None else copies[i]) for i, row in enumerate(array)]
    return spark.createDataFrame(rows, "pid long, features array<double>, copies long").repartition(4)


@pytest.mark.parametrize("shape", ["uniform", "clusters"])
def test_neighbours_equal_brute_force(spark, shape):
    generator = np.random.default_rng(5)
    data = generator.uniform(size=(700, 3))
    if shape == "clusters":
        data[:500] = data[:500] * 0.001 + 5
    out = nearest_neighbours(points(spark, data), 4, max_pivots=12, block_rows=60).collect()
    got = {}
    for r in out:
        got.setdefault(r.pid, {})[r.rank] = (r.neighbour, r.distance2)
    squared = ((data[:, None, :] - data[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(squared, np.inf)
    for i in range(len(data)):
        want = np.argsort(squared[i], kind="stable")[:4]
        assert [got[i][k][0] for k in range(4)] == list(want)


def test_classes_become_equal_and_points_lie_between_neighbours(spark):
    generator = np.random.default_rng(9)
    rows = [(i, 0, float(x), int(k)) for i, (x, k) in enumerate(zip(generator.normal(size=50), generator.integers(0, 9, 50)))]
    rows += [(100 + i, 1, float(i), 10 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "k long, y int, x double, n int")
    out = smote(df, ["x", "n"], "y", "k", k=3, seed=1)
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {0: 50, 1: 50}
    assert out.schema["n"].dataType.simpleString() == "int"
    base = {100 + i: float(i) for i in range(8)}
    made = out.where("draw is not null").collect()
    assert len(made) == 42 and {r.k for r in made} == set(base)
    for r in made:
        # Neighbours on a line of step 1 are at most 3 away.
        assert abs(r.x - base[r.k]) <= 3.0
        assert abs(r.n - 10 * r.x) < 1.0
    again = smote(df, ["x", "n"], "y", "k", k=3, seed=1)
    assert sorted(again.collect(), key=str) == sorted(out.collect(), key=str)


def test_copies_are_their_own_neighbours(spark):
    rows = [(i, 0, float(i)) for i in range(30)] + [(50 + i, 1, 7.0) for i in range(6)] + [(60, 1, 9.0)]
    df = spark.createDataFrame(rows, "k long, y int, x double")
    made = smote(df, ["x"], "y", "k", k=5).where("draw is not null").collect()
    assert len(made) == 23
    # Five copies fill all five places of a copy, so nothing moves towards 9.
    assert all(r.x == 7.0 for r in made if r.k != 60)


def test_many_draws_from_few_rows(spark):
    majority = spark.range(9000).select(F.col("id").alias("k"), F.lit(0).alias("y"), F.rand(1).alias("x"))
    minority = spark.range(3).select((F.col("id") + 10_000).alias("k"), F.lit(1).alias("y"), F.col("id").cast("double").alias("x"))
    out = smote(majority.union(minority), ["x"], "y", "k", k=2)
    counts = {(r.y, r.n) for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert counts == {(0, 9000), (1, 9000)}
    draws = out.where("draw is not null").groupBy("k").agg(F.count_distinct("draw").alias("n")).collect()
    assert {r.n for r in draws} == {2999}


def test_too_small_a_class_is_refused(spark):
    df = spark.createDataFrame([(i, int(i < 3), float(i)) for i in range(20)], "k long, y int, x double")
    with pytest.raises(ValueError, match="more than 5"):
        smote(df, ["x"], "y", "k")


def test_integer_copy_option(spark):
    rows = [(i, 0, 0) for i in range(20)] + [(50 + i, 1, 1000 * i) for i in range(6)]
    df = spark.createDataFrame(rows, "k long, y int, n int")
    made = smote(df, ["n"], "y", "k", integers="copy").where("draw is not null")
    assert made.where("n % 1000 <> 0").count() == 0


def test_blocks_are_compared_in_little_memory():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from weirgate.operators.neighbours import _best_of_block

    n, k = 1500, 3
    # Small whole numbers, so that many distances tie.
    points = np.random.default_rng(5).integers(0, 4, (n, 6)).astype(float)
    left = pd.DataFrame({"pid": np.arange(n), "features": list(points)})
    right = left.iloc[::-1].assign(copies=1)
    tracemalloc.start()
    got = _best_of_block(k)(left, right)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Less than one matrix of all distances.
    assert most < 8 * n * n
    for pid in (0, 63, 64, 1499):
        squared = ((points - points[pid]) ** 2).sum(axis=1)
        wanted = sorted((d, i) for i, d in enumerate(squared) if i != pid)[:k]
        assert [(r.distance2, r.neighbour) for r in got[got.pid == pid].itertuples()] == wanted
