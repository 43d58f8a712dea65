import numpy as np
from pyspark.sql import functions as F

from weirgate.operators.ordered import quantiles, ranked_values, running_totals
from weirgate.operators.profile import boxplot, describe, histogram


def test_running_totals_across_partitions_and_a_heavy_group(spark):
    rows = [("big", i, (i * 7) % 5) for i in range(3000)] + [("small", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, v int, n long").repartition(6)
    out = running_totals(df, ["g"], "v", ["n"], partitions=16, with_next=True)
    got = {(r.g, r.v): (r.n_before, r.n_total, r.next_value) for r in out.collect()}
    assert len(got) == 3005
    total = sum((i * 7) % 5 for i in range(3000))
    before = 0
    for i in range(3000):
        assert got["big", i] == (before, total, i + 1 if i < 2999 else None)
        before += (i * 7) % 5
    assert got["small", 4] == (4, 5, None)


def test_quantiles_equal_numpy(spark):
    generator = np.random.default_rng(3)
    values = np.concatenate([generator.normal(size=400), np.zeros(200)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 2.0), ("b", None)], "g string, v double")
    wanted = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    out = {r.g: r for r in quantiles(ranked_values(df, ["g"], "v"), ["g"], "v", wanted).collect()}
    for name, p in wanted.items():
        assert abs(out["a"][name] - np.quantile(values, p)) < 1e-12
        assert out["b"][name] == 2.0


def test_describe_skips_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    row = describe(df).first()
    assert (row["count"], row["mean"], row["q50"], row["max"]) == (2, 2.0, 2.0, 3.0)
    assert abs(row["std"] - 2**0.5) < 1e-12


def test_histogram_of_a_constant_and_density_sums_to_one(spark):
    df = spark.createDataFrame([(0, 5.0), (0, 5.0), (1, 0.0), (1, 1.0), (1, 1.0)], "y int, x double")
    rows = histogram(df, ["x"], "y", bins=10).collect()
    flat = [r for r in rows if r.y == 0]
    assert [(r.bin, r.n) for r in flat] == [(5, 2)]
    closed = {r.bin: r.n for r in rows if r.y == 1}
    assert closed == {0: 1, 9: 2}
    for label in (0, 1):
        assert abs(sum(r.density * 0.1 for r in rows if r.y == label) - 1) < 1e-9


def test_boxplot_whiskers_and_outliers(spark):
    df = spark.createDataFrame([(0, float(v)) for v in [1, 2, 3, 4, 5, 100]] + [(0, None)], "y int, x double")
    row = boxplot(df, ["x"], "y").first()
    assert (row.n, row.outliers, row.whisker_low, row.whisker_high) == (6, 1, 1.0, 5.0)
    assert (row.q25, row.q50, row.q75) == (2.25, 3.5, 4.75)


def test_no_window_runs_over_all_rows_at_once(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    plan = running_totals(df, ["g"], "v", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
