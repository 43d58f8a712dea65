from weirgate.operators import profile


def frame(spark):
    rows = [(1, 2.0, "a"), (1, float("nan"), "a"), (1, None, None), (2, 2.0, "b"), (1, 2.0, "a")]
    return spark.createDataFrame(rows, "i int, x double, s string")


def test_missing_counts_nan_and_null(spark):
    got = {r["column"]: (r.missing_count, r.missing_fraction) for r in profile.missing_by_column(frame(spark)).collect()}
    assert got == {"i": (0, 0.0), "x": (2, 0.4), "s": (1, 0.2)}
    assert {r["column"] for r in profile.missing_report(frame(spark)).collect()} == {"x", "s"}
    assert profile.max_missing_fraction(frame(spark).limit(0)).first()[0] == 0.0


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "a int, b int")
    assert tuple(profile.duplicate_count(df).first()) == (3, 1)


def test_cardinality_ignores_missing_but_divides_by_all(spark):
    got = {r["column"]: (r.unique_count, r.unique_ratio) for r in profile.cardinality(frame(spark)).collect()}
    assert got == {"i": (2, 0.4), "x": (1, 0.2), "s": (2, 0.4)}
    assert [r["column"] for r in profile.high_cardinality_columns(frame(spark), 0.3).collect()] == ["i", "s"]
    assert profile.cardinality(frame(spark), approximate=True).count() == 3


def test_row_delta_against_an_empty_reference(spark):
    df = frame(spark)
    assert profile.row_count_delta(df.limit(0), df).first().row_count_delta_fraction == 5.0


def test_value_counts_and_crosstab(spark):
    df = frame(spark)
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 3), ("b", 1)]
    got = {r.s: (r.i_0, r.i_1) for r in profile.crosstab(df, "s", "i").collect()}
    assert got == {"a": (0, 3), "b": (0, 0), None: (0, 1)}


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, float("nan"))], "a double, b double")
    got = {(r.column_a, r.column_b): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert abs(got["a", "b"] - 1) < 1e-12 and got["a", "a"] == 1.0


def test_profile_flags_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "c int, e double")
    got = {r["column"]: (r.is_empty, r.is_constant) for r in profile.summary_profile(df).collect()}
    assert got == {"c": (False, True), "e": (True, False)}
    info = {r["column"]: (r.dtype, r.non_null_count) for r in profile.column_info(df).collect()}
    assert info == {"c": ("int", 2), "e": ("double", 0)}
