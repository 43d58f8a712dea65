import pytest
from pyspark.sql import functions as F

from weirgate.operators import gates, lineage

RELEASE = dict(
    release_id=1, release_status="succeeded", endpoint_name="e", deployment_name="d", deployment_state="Succeeded",
    traffic_updated=True, smoke_invoked=True, finalization_timed_out=False, failure_stage=None, canary_status="passed",
    capture_enabled=False, capture_status=None, runtime_contract=None, record_present=True,
    handoff_capture_path=None, deployment_capture_path=None,
)
TYPES = (
    "release_id long, release_status string, endpoint_name string, deployment_name string, deployment_state string, "
    "traffic_updated boolean, smoke_invoked boolean, finalization_timed_out boolean, failure_stage string, canary_status string, "
    "capture_enabled boolean, capture_status string, runtime_contract string, record_present boolean, "
    "handoff_capture_path string, deployment_capture_path string"
)
FACTS = "capture_path string, record_count long, schema_consistent boolean, predictions long, max_single_class_share double"


def releases(spark, **changes):
    return spark.createDataFrame([tuple((RELEASE | changes).values())], TYPES)


@pytest.mark.parametrize(
    "changes,status",
    [
        ({}, "ready_for_basic_monitoring_handoff"),
        ({"capture_enabled": True, "capture_status": "healthy"}, "ready_for_repo_owned_inference_capture_handoff"),
        ({"capture_enabled": True, "capture_status": "degraded"}, "capture_degraded_after_deploy"),
        ({"endpoint_name": None, "deployment_name": ""}, "not_deployed"),
        ({"endpoint_name": None, "deployment_name": None, "release_status": "failed", "failure_stage": "x"}, "deploy_failed_before_handoff"),
        ({"finalization_timed_out": True, "smoke_invoked": False}, "deploy_incomplete_or_timed_out"),
        ({"release_status": "failed", "failure_stage": "canary"}, "canary_failed_after_deploy"),
        ({"release_status": "failed", "traffic_updated": False}, "deploy_failed_before_handoff"),
        ({"canary_status": None}, "not_deployed"),
    ],
)
def test_handoff(spark, changes, status):
    assert gates.handoff_status(releases(spark, **changes)).first().handoff_status == status


def monitor(spark, facts=(), config=gates.MonitorConfig(max_single_class_share=0.7), policy=gates.RetrainingConfig(), **changes):
    seen = gates.monitor_status(releases(spark, **changes), spark.createDataFrame(list(facts), FACTS), config)
    return gates.retraining_policy(seen, policy).first()


PATH = {"handoff_capture_path": "p"}


@pytest.mark.parametrize(
    "facts,changes,want",
    [
        ([("p", 1, True, 4, 0.75)], PATH, ("degraded", "class_balance_exceeded", "caller_side", "retraining_candidate", "fixed_train")),
        ([("p", 1, True, 4, 0.7)], PATH, ("capture_backed", "healthy", "caller_side", "no_retraining_signal", None)),
        ([("p", 1, False, 4, 0.9)], PATH, ("limited_but_healthy", "disabled", "release_evidence_only", "no_retraining_signal", None)),
        ([], PATH | {"capture_enabled": True, "capture_status": "healthy"}, ("degraded", "expected_but_unavailable", "deployment_configured_but_unretrieved", "investigate_before_retraining", None)),
        ([], {"runtime_contract": "generated_runtime_still_in_control"}, ("limited_but_healthy", "not_available_for_this_runtime_contract", "release_evidence_only", "no_retraining_signal", None)),
        ([], {"smoke_invoked": False}, ("degraded", "disabled", "release_evidence_only", "investigate_before_retraining", None)),
        ([], {"record_present": False}, ("blocked", "not_evaluated", None, "investigate_before_retraining", None)),
    ],
)
def test_monitor_and_policy(spark, facts, changes, want):
    row = monitor(spark, facts, **changes)
    assert (row.monitor_status, row.capture_status, row.capture_evidence_source, row.trigger, row.recommended_training_path) == want
    assert row.signal_persistence == "single_event"


def test_policy_options(spark):
    facts = [("p", 1, True, 4, 0.75)]
    off = monitor(spark, facts, policy=gates.RetrainingConfig(enabled=False), **PATH)
    assert (off.trigger, off.policy_enabled, off.requires_dataset_freeze) == ("policy_disabled", False, False)
    silent = monitor(spark, facts, policy=gates.RetrainingConfig(path_recommendation_enabled=False), **PATH)
    assert (silent.recommended_training_path, silent.path_recommendation_reason_codes) == ("none", ["path_recommendation_disabled"])
    sweep = monitor(spark, facts, policy=gates.RetrainingConfig(model_sweep_for_drift_severity=("medium",)), **PATH)
    assert (sweep.recommended_training_path, sweep.path_recommendation_reason_codes) == ("model_sweep", ["drift_severity_medium"])
    seen = gates.monitor_status(releases(spark, **PATH), spark.createDataFrame(facts, FACTS), gates.MonitorConfig(max_single_class_share=0.7))
    again = gates.retraining_policy(seen.withColumn("signal", F.lit("repeated_signal")), gates.RetrainingConfig(), "signal").first()
    assert (again.recommended_training_path, again.signal_persistence) == ("model_sweep", "repeated_signal")
    decision = gates.retraining_decision(gates.retraining_policy(seen, gates.RetrainingConfig())).first()
    assert decision.recommendation_summary.capture_status == "class_balance_exceeded"
    assert decision.reason_codes == ["prediction_class_balance_exceeded"]


@pytest.mark.parametrize(
    "facts,path,status",
    [
        ([], None, "not_configured"), ([], "p", "missing"), ([("p", 2, True, 4, 0.5)], "p", "insufficient_records"),
        ([("p", 3, False, 4, 0.5)], "p", "schema_inconsistent"), ([("p", 3, True, 0, 0.0)], "p", "prediction_distribution_unavailable"),
        ([("p", 3, True, 4, 0.9)], "p", "class_balance_exceeded"), ([("p", 3, True, 4, 0.7)], "p", "healthy"),
    ],
)
def test_capture_status_order(spark, facts, path, status):
    targets = spark.createDataFrame([(1, path)], "release_id long, capture_path string")
    config = gates.MonitorConfig(min_capture_records=3, max_single_class_share=0.7)
    assert gates.capture_status(targets, spark.createDataFrame(facts, FACTS), config).first().observed_capture_status == status


def test_rollup_names(spark):
    df = spark.createDataFrame([("capture_backed",), ("limited_but_healthy",), ("degraded",), ("blocked",), (None,)], "s string")
    got = [r[0] for r in df.select(gates.handoff_rollup(F.col("s"), "capture_degraded_after_release")).collect()]
    assert got == ["capture_backed_monitoring_ready", "release_evidence_only_ready", "capture_degraded_after_release", "blocked", "blocked"]


@pytest.mark.parametrize(
    "raw,want",
    [("configs/data.yaml", "configs/data.yaml"), ("C:\\r\\configs\\a\\data.yaml", "configs/a/data.yaml"), ("/x/y.yaml", "y.yaml"),
     ("a/configs/b/configs/c.yaml", "configs/b/configs/c.yaml"), ("   ", None), (None, None), ("//", None)],
)
def test_paths(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "p string").select(lineage.normal_path(F.col("p"))).first()[0] == want


def test_lineage_without_manifests_is_unverified(spark):
    declared = spark.createDataFrame([(1, "j", "configs/data.yaml", "configs/train.yaml", False)], "release_id long, job_name string, data_config string, train_config string, allow_mismatch boolean")
    none = spark.createDataFrame([], "job_name string, train_present boolean, validation_present boolean, train_config string, data_config string")
    row = lineage.lineage_status(declared, none).first()
    assert row.lineage_status == "unverified" and row.errors == []
    assert row.warnings == ["train_manifest_unavailable", "validation_manifest_unavailable"]
