import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgate.functions.pvalues import chi_square_tail, ks_paths, ks_tail, normal_two_sided
from weirgate.operators import drift, sketches
from weirgate.operators.validate import ValidationConfig, schema_difference, validate


def frame(spark, n, shift=0.0, seed=1, big=("a", "b", "c")):
    generator = np.random.default_rng(seed)
    rows = [(float(x) + shift, big[int(k)], int(b)) for x, k, b in zip(generator.normal(size=n), generator.integers(0, len(big), n), generator.integers(0, 2, n))]
    return spark.createDataFrame(rows, "x double, c string, flag int")


def test_tails_match_known_values(spark):
    row = spark.createDataFrame([(3.841458820694124, 1.0, 1.959963984540054)], "q double, k double, z double").select(
        chi_square_tail("q", "k"), normal_two_sided("z"), ks_tail(F.lit(0.1923), F.lit(100), F.lit(100))
    ).first()
    assert abs(row[0] - 0.05) < 1e-9 and abs(row[1] - 0.05) < 1e-9
    assert abs(row[2] - 0.0495) < 1e-3
    edge = spark.createDataFrame([(200.0, 3.0), (0.0, 3.0), (float("inf"), 2.0), (0.5, 8.0)], "q double, k double")
    got = [r[0] for r in edge.select(chi_square_tail("q", "k")).collect()]
    assert got[0] < 1e-40 and got[1] == 1.0 and got[2] == 0.0 and abs(got[3] - 0.99986663) < 1e-6


def test_ks_and_wasserstein_equal_brute_force(spark):
    a, b = frame(spark, 300, seed=2), frame(spark, 211, 0.4, seed=3)
    row = drift.numeric_statistics(drift.stacked(a, b, ["x"]), ["x"]).first()
    xs, ys = (np.sort([r.x for r in f.collect()]) for f in (a, b))
    grid = np.sort(np.concatenate([xs, ys]))
    gap = np.abs(np.searchsorted(xs, grid, "right") / 300 - np.searchsorted(ys, grid, "right") / 211)
    assert abs(row.ks - gap.max()) < 1e-12
    assert abs(row.wasserstein - (gap[:-1] * np.diff(grid)).sum() / xs.std()) < 1e-9


def test_small_reference_is_tested_large_one_measured(spark):
    small = drift.drift_report(frame(spark, 400), frame(spark, 300, 2.0, seed=8), family="by_size")
    assert {r["column"]: (r.method, r.drifted) for r in small.collect()} == {
        "x": ("ks", True), "c": ("chisquare", False), "flag": ("z", False)
    }
    large = drift.drift_report(frame(spark, 1500), frame(spark, 300, 2.0, seed=8), family="by_size")
    assert {r["column"]: r.method for r in large.collect()} == {"x": "wasserstein", "c": "jensenshannon", "flag": "jensenshannon"}
    summary = drift.drift_summary(large).first()
    assert (summary.drifted_column_count, round(summary.drifted_column_share, 6)) == (1.0, 0.333333)


def test_a_table_does_not_drift_from_itself(spark):
    for n in (200, 1500):
        same = frame(spark, n)
        assert drift.drift_summary(drift.drift_report(same, same)).first().drifted_column_share == 0.0


def test_category_that_is_new_in_the_current_table(spark):
    a = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    b = spark.createDataFrame([("a",)] * 50 + [("z",)] * 50, "c string")
    row = drift.categorical_statistics(drift.stacked(a, b, ["c"]), ["c"]).first()
    assert math.isinf(row.chi2) and row.categories == 3
    assert drift.drift_report(a, b).first().drifted


def test_method_override(spark):
    a, b = frame(spark, 100), frame(spark, 100, seed=4)
    got = drift.drift_report(a, b, ["x"], method={"x": "wasserstein"}).first()
    assert got.method == "wasserstein"
    with pytest.raises(ValueError, match="unknown drift method"):
        drift.drift_report(a, b, method={"x": "nope"})


# --- the gate --------------------------------------------------------------------------

SCHEMA = "CreditScore int, Balance double, Exited int"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def fake(share):
    def report(reference, current):
        spark = reference.sparkSession
        if share is None:
            return spark.createDataFrame([], "column string, drifted boolean")
        return spark.createDataFrame([("a", True), ("b", share > 0.5)], "column string, drifted boolean")

    return report


def test_gate_passes(spark):
    a = batch(spark, (600, 1.0, 0), (700, 2.0, 1))
    row = validate(a, a, ValidationConfig(), fake(0.0)).first()
    assert row.status == "passed" and row.failed_checks == [] and row.row_counts.reference == 2
    assert row.current_columns == ["Balance", "CreditScore", "Exited"]


def test_missing_values_fail_before_drift_is_computed(spark):
    def never(reference, current):
        raise AssertionError("drift must not run")

    a, b = batch(spark, (600, 1.0, 0), (700, 2.0, 1)), batch(spark, (None, 1.0, 0), (None, 2.0, 1))
    row = validate(a, b, ValidationConfig(fail_on_drift=True), never).first()
    assert row.failed_checks == ["max_missing_fraction"] and row.drifted_column_share is None
    half = batch(spark, (None, 1.0, 0), (5, 2.0, 1))
    assert validate(a, half, ValidationConfig(max_missing_fraction=0.5), fake(0.0)).first().status == "passed"
    assert validate(a, half, ValidationConfig(fail_on_missing_fraction=False), fake(0.0)).first().status == "passed"


def test_drift_over_and_without_a_metric(spark):
    a = batch(spark, (600, 1.0, 0), (700, 2.0, 1))
    failing = ValidationConfig(fail_on_drift=True)
    row = validate(a, a, failing, fake(0.5)).first()
    assert row.failed_checks == ["data_drift_detected"] and row.checks.drift_within_threshold is False
    assert validate(a, a, failing, fake(None)).first().failed_checks == ["drift_metric_missing"]
    assert validate(a, a, ValidationConfig(), fake(0.5)).first().status == "passed"


def test_order_of_checks_and_target(spark):
    a = batch(spark, (600, 1.0, 0), (700, 2.0, 1))
    b = spark.createDataFrame([(None,)], "CreditScore int")
    row = validate(a, b, ValidationConfig(fail_on_row_count_delta=True, max_row_count_delta_fraction=0.4), fake(0.0)).first()
    assert row.failed_checks == ["target_column_present", "schema_mismatch", "max_missing_fraction", "row_count_delta_fraction"]
    # Column order and types do not matter to the gate.
    c = a.selectExpr("Exited", "CAST(Balance AS STRING) AS Balance", "CreditScore")
    assert validate(a, c, ValidationConfig(), fake(0.0)).first().checks.schema_match
    assert [r["column"] for r in schema_difference(a, c).collect()] == ["Balance"]


def test_one_family_for_every_size(spark):
    for n in (400, 1500):
        a, b = frame(spark, n), frame(spark, 300, 2.0, seed=8)
        methods = {r["column"]: r.method for r in drift.drift_report(a, b).collect()}
        assert methods == {"x": "wasserstein", "c": "jensenshannon", "flag": "jensenshannon"}
        methods = {r["column"]: r.method for r in drift.drift_report(a, b, family="test").collect()}
        assert methods == {"x": "ks", "c": "chisquare", "flag": "z"}
    with pytest.raises(ValueError):
        drift.drift_report(a, b, family="nope")


def test_lattice_paths_count_every_interleaving():
    for n, m in ((1, 1), (2, 5), (4, 4), (6, 3), (7, 5)):
        gaps = []
        for chosen in itertools.combinations(range(n + m), n):
            i = j = gap = 0
            for k in range(n + m):
                i, j = (i + 1, j) if k in chosen else (i, j + 1)
                gap = max(gap, abs(i * m - j * n))
            gaps.append(gap)
        for gap in range(n * m + 2):
            assert ks_paths(gap, n, m) == sum(g >= gap for g in gaps) / len(gaps)
    # The series comes close where both can be had.
    assert abs(ks_paths(round(0.2 * 90 * 100), 90, 100) - 0.0378) < 0.01


def sides(spark, xs, ys):
    def table(values):
        return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")

    return table(xs), table(ys)


@pytest.mark.parametrize("size", [50, 2000])
def test_binned_intervals_hold(spark, size):
    rng = np.random.default_rng(5)
    heavy = [1.0] * 1500 + list(rng.normal(0, 1, 3000)) + [None, float("nan")]
    cases = {
        "moved": (rng.normal(0, 1, 5000), rng.normal(0.5, 1, 4000)),
        "heavy": (heavy, list(rng.normal(0, 1, 3000)) + [1.0] * 100),
        "same": (heavy, heavy),
        "few": ([1, 2, 3], [0, 2, 2, 9]),
        "apart": (np.arange(4000), np.arange(5000, 9000)),
        "negative": (-(rng.random(3000) ** 3), -(rng.random(3000) ** 2)),
    }
    for name, (xs, ys) in cases.items():
        a, b = sides(spark, xs, ys)
        row = sketches.binned_report(a, b, ["x"], size=size).first()
        left, right = (np.array([v for v in t if v is not None and v == v], dtype=float) for t in (xs, ys))
        grid = np.unique(np.concatenate([left, right]))
        gap = np.abs([(left <= g).mean() - (right <= g).mean() for g in grid])
        distance = float((gap[:-1] * np.diff(grid)).sum())
        assert row.ks_low - 1e-9 <= gap.max() <= row.ks_high + 1e-9, name
        assert row.wasserstein_low - 1e-9 <= distance <= row.wasserstein_high + 1e-9, name
        if size == 2000:
            assert row.ks_high - row.ks_low < 0.03, name


def test_sketches_of_parts_merge(spark):
    rng = np.random.default_rng(6)
    a, b = sides(spark, rng.normal(0, 1, 9000), rng.normal(0.3, 1, 8000))
    parts = [sketches.quantile_sketches(t.withColumn("p", F.spark_partition_id()), ["x"], by=["p"]) for t in (a, b)]
    row = sketches.binned_drift(*[sketches.merged(p) for p in parts]).first()
    assert (row.ref_n, row.cur_n) == (9000, 8000) and row.ks_low <= 0.12 <= row.ks_high + 0.02
    empty = sketches.quantile_sketches(a.where("x > 99"), ["x"])
    for left, right in ((empty, parts[0].where("p = 0").drop("p")), (empty, empty)):
        assert all(r.ks_low is None for r in sketches.binned_drift(left, right).collect())


def test_exact_tail_in_a_report(spark):
    a, b = sides(spark, [1, 2, 3, 4], [5, 6, 7, 8])
    row = drift.drift_report(a, b, ["x"], kinds={"x": "num"}, method={"x": "ks_exact"}).first()
    assert row.method == "ks_exact" and row.score == pytest.approx(2 / 70) and row.drifted
