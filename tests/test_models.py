import pytest
from pyspark.sql import functions as F

from weirgate.functions.columns import uniform
from weirgate.operators import evaluate, models, prep
from weirgate.operators.validate import ValidationConfig


@pytest.fixture(scope="module")
def planted(spark):
    """The label follows x with a little noise; n is unrelated and has gaps."""
    noise = uniform("noise", F.col("k")) * 0.2
    return spark.range(600).select(
        F.col("id").alias("k"),
        uniform("x", F.col("id")).alias("x"),
        F.when(F.col("id") % 7 != 0, uniform("n", F.col("id"))).alias("n"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"),
    ).withColumn("y", (F.col("x") + noise > 0.85).cast("int"))


@pytest.fixture(scope="module")
def prepared(planted):
    return prep.prepare(planted, target="y", key="k", categorical=["g"])


SMALL = {"rf": {"n_estimators": 10, "max_depth": 100}, "xgboost": {"n_estimators": 5, "max_depth": 3, "odd": 1}}


def test_families_learn_a_planted_signal(prepared):
    results, fitted = models.train_families(prepared, params=SMALL)
    rows = {r.model_name: r for r in results.collect()}
    assert set(rows) == {"logreg", "rf", "xgboost"}
    assert all(r.metrics["roc_auc"] > 0.9 for r in rows.values())
    assert "max_depth 100 clamped to 30" in rows["rf"].warnings
    assert "unknown parameter odd ignored" in rows["xgboost"].warnings
    best = models.best_candidate_summary(results).first()
    assert best.metrics["f1"] == max(r.metrics["f1"] for r in rows.values())
    assert fitted["rf"].transform(models.fill_gaps(prepared.data, prepared.side("train"), prepared.features)).count() == 600


def test_oversampling_turns_weights_off(prepared):
    results, _ = models.train_families(prepared, ("logreg",), use_smote=True)
    row = results.first()
    assert row.class_weight is None and row.metrics["recall"] > 0.7


def test_unknown_family_and_failed_trials(prepared):
    with pytest.raises(ValueError, match="unknown model"):
        models.train_families(prepared, ("logreg", "nope"))
    got = {r.run_id: r for r in models.run_trials(prepared, [("a", "logreg", {"C": "0.1"}), ("b", "nope", {}), ("c", "logreg", {"C": "x"})]).collect()}
    assert got["a"].status == "finished" and got["a"].metrics["roc_auc"] > 0.9
    assert got["b"].status == "failed" and "unknown model" in got["b"].error and got["c"].status == "failed"


def test_tiny_test_side_warns(spark):
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("y"), ((F.col("id") % 2) * 10.0).alias("x"))
    results, _ = models.train_families(prep.prepare(df, target="y", key="k"), ("logreg",))
    assert len(results.first().warnings) == 2


def test_smoke_job(planted):
    row = models.smoke(planted, target="y", key="k", drop=[], categorical=["g"], config=ValidationConfig(target_column="y")).first()
    assert row.validation_status == "passed" and row.drifted_column_share == 0.0 and row.train_rows == 480


def test_metrics_on_known_cases(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2)], "y int, p int, s double")
    row = evaluate.classification_report(df, "y", "p", "s").first()
    assert (row.accuracy, row.precision, row.recall, round(row.f1, 2), row.roc_auc) == (0.75, 1.0, 0.5, 0.67, 1.0)
    none = evaluate.classification_report(df.where("y = 0"), "y", "p", "s").first()
    assert (none.precision, none.recall, none.f1, none.roc_auc) == (0.0, 0.0, 0.0, 0.5)


def test_auc_equals_pair_counting_with_ties(spark):
    rows = [((i * 7) % 3 == 0, (i * 13) % 11 / 10) for i in range(200)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "y int, s double")
    positives, negatives = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert abs(evaluate.roc_auc(df, "y", "s").first().roc_auc - wins / len(positives) / len(negatives)) < 1e-12


def test_registered_training_uses_whole_models(spark, monkeypatch):
    from weirgate.plans import model_plans

    class Stop(Exception):
        pass

    seen = []

    def taken(*args, **named):
        seen.append((args, named))
        raise Stop

    monkeypatch.setattr(model_plans, "prepared_churn", lambda spark, sf: None)
    monkeypatch.setattr(model_plans.models, "train_families", taken)
    monkeypatch.setattr(model_plans.models, "run_trials", taken)
    for name in ("train_families", "trial_results"):
        with pytest.raises(Stop):
            model_plans.plans.queries[name](spark, "/root/testdata/sf0.001")
    assert seen[0] == ((None,), {})
    trees = [int(own["n_estimators"]) for _, family, own in seen[1][0][1] if family == "rf"]
    assert trees and set(trees) <= {100, 200, 300}
