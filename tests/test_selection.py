import pytest

from weirgate.operators import registry, search, select
from pyspark.sql import functions as F

CANDIDATE = "sweep_id long, model_name string, run_id string, metrics map<string,double>"


def winner(spark, *rows, **kwargs):
    df = spark.createDataFrame([(1, m, r, x) for m, r, x in rows], CANDIDATE)
    return select.select_winner(df, **kwargs).first()


def test_secondary_metric_decides(spark):
    got = winner(spark, ("rf", "a", {"f1": 0.82, "roc_auc": 0.88}), ("xgboost", "b", {"f1": 0.82, "roc_auc": 0.91}), ("logreg", "c", {"f1": 0.1}))
    assert (got.model_name, got.tie_break_reason, got.tie_candidates, got.tied) == ("xgboost", "secondary_metric", ["rf", "xgboost"], 2)


def test_family_priority_then_name_and_run(spark):
    m = {"f1": 6 / 7, "roc_auc": 0.9375}
    got = winner(spark, ("xgboost", "a", m), ("rf", "b", m))
    assert (got.model_name, got.tie_break_reason, got.tie_candidates) == ("rf", "family_priority", ["rf", "xgboost"])
    got = winner(spark, ("zeta", "b", m), ("alpha", "c", m), ("alpha", "a", m))
    assert (got.model_name, got.run_id, got.tie_break_reason) == ("alpha", "a", "final_fallback")


def test_missing_secondary_counts_as_lowest(spark):
    got = winner(spark, ("logreg", "a", {"f1": 0.5}), ("svm", "b", {"f1": 0.5, "roc_auc": 0.0}))
    assert (got.model_name, got.tie_break_reason) == ("svm", "secondary_metric")
    only = winner(spark, ("svm", "b", {"f1": 0.5}))
    assert (only.tie_break_reason, only.tie_candidates) == ("primary_metric", ["svm"])


def test_missing_primary(spark):
    rows = (("rf", "a", {"f1": 0.2}), ("svm", "b", {"roc_auc": 0.9}))
    with pytest.raises(Exception, match="metric f1 missing for svm"):
        winner(spark, *rows)
    assert winner(spark, *rows, on_missing="reject").model_name == "rf"
    df = spark.createDataFrame([(1, m, r, x) for m, r, x in rows], CANDIDATE)
    assert select.without_metric(df, "f1").first().model_name == "svm"


def test_rounding_makes_near_ties(spark):
    rows = (("xgboost", "a", {"f1": 0.82000001}), ("rf", "b", {"f1": 0.82}))
    assert winner(spark, *rows).model_name == "xgboost"
    assert winner(spark, *rows, round_to=4).model_name == "rf"


def test_artifacts_and_consistency(spark):
    df = spark.createDataFrame([(1, "rf", "a", {"f1": 1.0}), (1, "svm", "b", {})], CANDIDATE)
    paths = "sweep_id long, model_name string, paths map<string,string>"
    bundles = spark.createDataFrame([(1, "rf", {"model": "m", "manifest": "old", "x": None})], paths)
    manifests = spark.createDataFrame([(1, "rf", {"manifest": "new"})], paths)
    got = {r.model_name: r.artifacts for r in select.with_family_artifacts(df, bundles, manifests).collect()}
    assert got == {"rf": {"model": "m", "manifest": "new"}, "svm": {}}
    pair = "run_id long, family string"
    bad = select.winner_mismatches(
        spark.createDataFrame([(1, "rf"), (2, "rf"), (3, "rf"), (4, "rf")], pair),
        spark.createDataFrame([(1, "rf"), (2, "svm"), (3, "rf")], pair),
        spark.createDataFrame([(1, "rf"), (3, "svm")], pair),
    )
    assert {r.run_id: r.mismatch for r in bad.collect()} == {2: "winner_manifest", 3: "winner_train_config", 4: "winner_manifest"}


def test_search_space(spark):
    spaces = spark.createDataFrame(
        [(1, "rf", {"use_smote": ["true"]}, {"depth": ["1", None, "2"], "leaf": ["4"]}), (1, "svm", {}, {}), (1, "logreg", {}, {"C": [None]})],
        "sweep_id long, family string, shared map<string,array<string>>, space map<string,array<string>>",
    )
    got = [r.params for r in search.expand_trials(spaces, ["depth", "leaf", "C", "use_smote"]).collect()]
    assert sorted(got, key=str) == [
        {"rf_depth": d, "rf_leaf": "4", "use_smote": "true"} for d in ("1", "2")
    ]
    keys = spark.createDataFrame([({"rf_a": "1", "svm_b": "2", "use_smote": "t"},)], "p map<string,string>")
    assert keys.select(search.override_keys(F.col("p"))).first()[0] == {"rf.a": "1", "svm_b": "2", "use_smote": "t"}


@pytest.mark.parametrize(
    "text,plain,scientific",
    [("true", "bool", "bool"), (" False ", "bool", "bool"), ("12", "int", "int"), ("-3", "int", "int"), ("1.5", "float", "float"),
     (".5", "float", "float"), ("2.e3", "float", "float"), ("1e-3", "text", "float"), ("a.b", "text", "text"), ("1.5d", "text", "text"), (None, None, None)],
)
def test_typed_scalars(spark, text, plain, scientific):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(search.typed_scalar(F.col("t")).alias("a"), search.typed_scalar(F.col("t"), True).alias("b")).first()
    assert (row.a.kind, row.b.kind) == (plain, scientific)


def test_loose_booleans(spark):
    df = spark.createDataFrame([(t,) for t in ("YES", " on ", "0", "n", None)], "t string")
    assert [r[0] for r in df.select(search.loose_bool(F.col("t"), True)).collect()] == [True, True, False, False, True]
    odd = spark.createDataFrame([("maybe",)], "t string")
    assert odd.select(search.loose_bool(F.col("t"), True, strict=False)).first()[0] is False
    with pytest.raises(Exception, match="not a boolean"):
        odd.select(search.loose_bool(F.col("t"), True)).collect()


def test_clamp_and_winner_config(spark):
    df = spark.createDataFrame([({"min_samples_split": "1", "odd": "3", "max_depth": "4"},)], "p map<string,string>")
    assert df.select(search.clamp_min_samples(F.col("p"), ["min_samples_split", "max_depth"])).first()[0] == {"min_samples_split": "2", "max_depth": "4"}
    winners = spark.createDataFrame([(1, "rf")], "sweep_id long, model_name string")
    trial = "sweep_id long, model_name string, params map<string,string>"
    good = spark.createDataFrame([(1, "rf", {"rf_max_depth": "4", "svm_x": "1", "use_smote": "true", "random_state": "42"})], trial)
    row = search.winner_configs(winners, good).first()
    assert row.models == ["rf"] and row.hyperparameters["max_depth"].kind == "int" and row.use_smote and row.random_state == 42
    with pytest.raises(Exception, match="no winner parameters"):
        search.winner_configs(winners, good.limit(0)).collect()


# --- registry --------------------------------------------------------------------------

MODEL = "name string, version string, tags map<string,string>"


def test_latest_approved_compares_versions_as_numbers(spark):
    df = spark.createDataFrame(
        [("m", "9", {"approval_status": "Approved", "f1": "0.7"}), ("m", "10", {"approval_status": "approved"}),
         ("m", "11", {"approval_status": "candidate", "f1": "bad"}), ("n", "1", {})], MODEL)
    got = {r.name: r for r in registry.latest_approved(df).collect()}
    assert (got["m"].model_version, got["m"].f1, got["m"].primary_metric) == ("10", 0.0, "f1")
    assert (got["n"].model_name, got["n"].model_version, got["n"].roc_auc) == ("bootstrap-baseline", None, 0.0)
    with pytest.raises(Exception):
        registry.latest_approved(spark.createDataFrame([("m", "1", {"approval_status": "approved", "f1": "bad"})], MODEL)).collect()


def test_reuse_needs_the_same_lineage(spark):
    tags = {"approval_status": "approved", "lineage_status": "validated", "source_job_name": "j", "data_config": "d", "train_config": "t", "candidate_model_name": "rf"}
    models = spark.createDataFrame(
        [("m", "9", tags), ("m", "10", tags), ("m", "11", tags | {"source_job_name": "other"}), ("m", "12", tags | {"data_config": "x"}),
         ("m", "13", tags | {"lineage_status": "failed"})], MODEL)
    wanted = "release_id long, name string, source_job_name string, data_config string, train_config string, model_name string"
    releases = spark.createDataFrame([(1, "m", "j", "d", "t", "rf"), (2, "m", "j", None, None, None), (3, "m", "j", "d", "t", "svm"), (4, "m", "j", "d", "t", "")], wanted)
    got = {r.release_id: r.version for r in registry.reusable_versions(releases, models).collect()}
    assert got == {1: "10", 2: "12", 4: "10"}


def test_promotion_limits_are_inclusive(spark):
    candidates = spark.createDataFrame([(1, "m", 0.81), (2, "m", 0.75), (3, "n", 0.63), (4, "m", None), (5, "n", 0.7)], "candidate_id long, name string, score double")
    baselines = spark.createDataFrame([("m", 0.75)], "name string, f1 double")
    got = {r.candidate_id: (r.status, r.reasons) for r in registry.promotion(candidates, baselines, 0.01, 0.7).collect()}
    assert got[1] == ("promote", []) and got[2] == ("reject", ["improvement_below_threshold"])
    assert got[3] == ("reject", ["candidate_below_minimum_score"]) and got[5] == ("promote", [])
    assert got[4] == ("reject", ["candidate_below_minimum_score", "improvement_below_threshold"])
    allowed, refused = registry.promotable(registry.promotion(candidates, baselines, 0.01, 0.7))
    assert {r.candidate_id for r in allowed.collect()} == {1, 5}
    assert {r.refused_status for r in refused.collect()} == {"reject"}


def test_grid_samples_do_not_repeat(spark):
    names = [f"p{i}" for i in range(12)]
    big = {n: [str(j) for j in range(10)] for n in names}
    rows = [("s1", "rf", {"use_smote": ["true", "false"]}, {"p0": ["a", "b", "c"], "p1": ["x", None, "y"], "p2": [None]}), ("s2", "rf", {}, big), ("s3", "rf", {}, {})]
    spaces = spark.createDataFrame(rows, "sweep_id string, family string, shared map<string,array<string>>, space map<string,array<string>>")
    parameters = [*names, "use_smote"]
    got = search.sample_grid(spaces, parameters, 5000)
    every = search.expand_trials(spaces.where("sweep_id = 's1'"), parameters)
    wanted = sorted(r.t for r in every.select(search.trial_key(F.col("params")).alias("t")).collect())
    assert sorted(r.t for r in got.where("sweep_id = 's1'").select(search.trial_key(F.col("params")).alias("t")).collect()) == wanted
    large = got.where("sweep_id = 's2'").select(search.trial_key(F.col("params")).alias("t"))
    assert (large.count(), large.distinct().count()) == (5000, 5000)
    # Every choice of every parameter is about as frequent.
    share = got.where("sweep_id = 's2'").groupBy(F.col("params")["rf_p7"].alias("v")).count().collect()
    assert len(share) == 10 and all(350 < r["count"] < 650 for r in share)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    other = search.sample_grid(spaces, parameters, 50, seed=7).where("sweep_id = 's2'").select(search.trial_key(F.col("params")).alias("t"))
    assert other.intersect(large).count() == 0
    with pytest.raises(Exception, match="2\\*\\*62"):
        search.sample_grid(spark.createDataFrame([("s", "rf", {}, {f"p{i}": ["a"] * 100 for i in range(12)})], spaces.schema), names, 5).collect()


def _customers(spark, folder):
    rows = spark.range(60).selectExpr("id AS c_custkey", "'x' AS c_name", "CAST(id % 5 AS INT) AS c_nationkey", "1.0D AS c_acctbal", "'s' AS c_mktsegment")
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_grids_of_one_small_file_are_many_tasks(spark, tmp_path):
    from weirgate.plans import selection_plans

    found = selection_plans.plans.queries["trial_sample_grid"](spark, _customers(spark, tmp_path))
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    got = {r["sweep_id"]: r for r in found.collect()}
    assert len(got) == 60 and all(r["from_choices"] and r["trials"] == r["different"] for r in got.values())
    assert [got[i]["trials"] for i in range(3)] == [24, 12, 24]


def test_trials_of_one_small_file_are_many_tasks(spark, tmp_path):
    from weirgate.plans import selection_plans

    found = selection_plans.plans.queries["trial_sample"](spark, _customers(spark, tmp_path))
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    # Sweeps of the third family have an empty space; a sweep has two trials at most.
    assert sorted({(r["sweep_id"], r["trial_no"]) for r in found.collect()}) == [(i, n) for i in range(60) if i % 3 != 2 for n in (1, 2)]
