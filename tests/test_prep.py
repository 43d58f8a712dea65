import hashlib
import math

import pytest
from pyspark.sql import functions as F

from weirgate.functions.columns import hash52, numeric_columns, uniform
from weirgate.operators import prep
from weirgate.operators.pick import pick_by_hash


def h(seed, key):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:13], 16)


def labelled(spark, sizes):
    rows = [(k, label) for label, n in sizes.items() for k in range(label * 100_000, label * 100_000 + n)]
    return spark.createDataFrame(rows, "k long, y int").repartition(5)


def test_hash_is_the_documented_one(spark):
    row = spark.createDataFrame([(17,)], "k long").select(hash52("s", F.col("k")), uniform("s", F.col("k"))).first()
    assert row[0] == h("s", 17) and row[1] == h("s", 17) / 2**52


@pytest.mark.parametrize("rank_at_most", [0, 3, 10_000])
def test_pick_equals_a_full_ranking(spark, rank_at_most):
    df = labelled(spark, {0: 700, 1: 90, 2: 5})
    quotas = {0: 211, 1: 90, 2: 0}
    cut = pick_by_hash(df, "y", "k", quotas, 42, rank_at_most)
    got = {r.k for r in cut.chosen(df).where("chosen").collect()}
    want = set()
    for label, q in quotas.items():
        keys = [r.k for r in df.where(F.col("y") == label).collect()]
        want |= set(sorted(keys, key=lambda k: (h(42, k), k))[:q])
    assert got == want


def test_split_sizes_follow_largest_remainders():
    assert prep.train_quotas({0: 8, 1: 2}, 0.2) == {0: 6, 1: 2}
    # 7 of 10 training rows over classes of 5 and 5: equal fractions, the smaller label gets it.
    assert prep.train_quotas({0: 5, 1: 5}, 0.3) == {0: 4, 1: 3}
    with pytest.raises(ValueError, match="at least 2"):
        prep.train_quotas({0: 9, 1: 1}, 0.2)
    with pytest.raises(ValueError):
        prep.train_quotas({0: 9, 1: 2}, 0)


def test_split_is_disjoint_and_exact(spark):
    df = labelled(spark, {0: 803, 1: 199})
    rows = prep.split(df, prep.fit_split(df, "y", "k", 0.2)).collect()
    assert len(rows) == 1002 and len({r.k for r in rows}) == 1002
    test = [r for r in rows if r.split == "test"]
    assert len(test) == math.ceil(0.2 * 1002)
    assert sum(r.y for r in test) == 199 - prep.train_quotas({0: 803, 1: 199}, 0.2)[1]
    plain = prep.split(df, prep.fit_split(df, "y", "k", 0.5, stratify=False))
    assert plain.columns == ["k", "y", "split"] and plain.where("split = 'test'").count() == 501


def test_missing_labels_are_refused(spark):
    df = spark.createDataFrame([(1, None), (2, 1)], "k long, y int")
    with pytest.raises(ValueError, match="missing"):
        prep.fit_split(df, "y", "k")


def test_encoding(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "s string")
    encoders = prep.fit_encoders(df, ["s", "absent"])
    assert {r.value: r.code for r in encoders.collect()} == {"a": 0, "b": 1, "c": 2}
    new = spark.createDataFrame([("c",), ("z",), (None,)], "s string")
    assert [r.s for r in prep.encode(df, encoders, ["s"]).collect()].count(0) == 2
    assert sorted(map(str, [r.s for r in prep.encode(new, encoders, ["s"], "null").collect()])) == ["2", "None", "None"]
    assert sorted(r.s for r in prep.encode(new, encoders, ["s"], "extra").collect()) == [2, 3, 3]
    with pytest.raises(Exception, match="unseen value in s"):
        prep.encode(new, encoders, ["s"]).collect()
    gaps = prep.fit_encoders(df.union(spark.createDataFrame([(None,)], "s string")), ["s"], missing="extra")
    assert {r.value: r.code for r in gaps.collect()}[None] == 3


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5, True), (3.0, 5, False), (None, 5, True)], "x double, c int, b boolean")
    assert numeric_columns(df) == ["x", "c"]
    scaler = prep.fit_scaler(df)
    assert scaler.parameters == {"x": (2.0, 1.0), "c": (5.0, 1.0)}
    rows = scaler.apply(df).collect()
    assert [r.x for r in rows] == [-1.0, 1.0, None] and {r.c for r in rows} == {0.0}
    assert prep.fit_scaler(df, exclude=["x", "c"]).parameters == {}


def test_prepare_fits_on_training_rows_only(spark):
    df = labelled(spark, {0: 80, 1: 40}).withColumn("x", F.col("k") * 1.5).withColumn(
        "g", F.when(F.col("k") % 2 == 0, "even").otherwise("odd")
    )
    done = prep.prepare(df, target="y", key="k", drop=["nothing"], categorical=["g"])
    train = done.side("train").agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(train[0]) < 1e-9 and abs(train[1] - 1) < 1e-9
    assert done.features == ["x", "g"] and done.scaled == ["x"] and done.encoded == ["g"]
    meta = done.metadata().first()
    assert (meta.row_count, meta.train_rows, meta.test_rows) == (120, 96, 24)
    with pytest.raises(ValueError, match="not in the data"):
        prep.prepare(df.drop("y"), target="y", key="k")


def test_weights(spark):
    df = labelled(spark, {0: 30, 1: 10})
    assert prep.positive_weight(df, "y").first().scale_pos_weight == 3.0
    for kwargs in ({"family": "rf"}, {"mode": None}, {"user_set": True}):
        assert prep.positive_weight(df, "y", **kwargs).first().scale_pos_weight is None
    assert prep.positive_weight(df.where("y = 0"), "y").first().scale_pos_weight is None
    table = {r.y: r.weight for r in prep.class_weights(df, "y").collect()}
    assert table == {0: 40 / 60, 1: 2.0}
    inline = {r.y: r.weight for r in prep.with_class_weight(df, "y").distinct().drop("k").distinct().collect()}
    assert inline == table
