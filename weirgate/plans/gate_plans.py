"""Registry, lineage, promotion, monitoring and retraining rules over derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.operators import capture, gates, lineage, logs, registry
from weirgate.plans.common import Registry, rounded
from weirgate.sources.derived import CAPTURE_SQL, capture_lines, derived, derived_sql, model_versions
from weirgate.sources.tables import table

plans = Registry()

# --- registry --------------------------------------------------------------------------

_BASELINES_SQL = """
approved AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) AS place
             FROM model_versions WHERE lower(approval_status) = 'approved'),
baselines AS (
  SELECT n.name, CASE WHEN a.name IS NULL THEN 'bootstrap-baseline' ELSE n.name END AS model_name,
         a.version AS model_version, 'f1' AS primary_metric,
         CASE WHEN a.name IS NULL THEN 0.0 ELSE CAST(coalesce(a.f1, '0') AS DOUBLE) END AS f1,
         CASE WHEN a.name IS NULL THEN 0.0 ELSE CAST(coalesce(a.roc_auc, '0') AS DOUBLE) END AS roc_auc
  FROM (SELECT DISTINCT name FROM model_versions) n
  LEFT JOIN (SELECT * FROM approved WHERE place = 1) a ON n.name = a.name)"""


@plans.query("latest_approved", f"WITH {derived_sql('model_versions')}, {_BASELINES_SQL} SELECT * FROM baselines")
def latest_approved(spark, sf):
    return registry.latest_approved(model_versions(spark, sf))


@plans.query(
    "registry_listing",
    f"WITH {derived_sql('model_versions')} SELECT version, lower(approval_status) AS approval_status"
    " FROM model_versions WHERE name = 'model-7'",
)
def registry_listing(spark, sf):
    rows = registry.versions_of(model_versions(spark, sf), "model-7")
    return rows.select("version", F.lower(F.col("tags")["approval_status"]).alias("approval_status"))


@plans.query(
    "reusable_model",
    f"""WITH {derived_sql('model_versions')}, {derived_sql('candidates')}
    SELECT c.candidate_id AS release_id, c.name, CAST(max(CAST(m.version AS BIGINT)) AS VARCHAR) AS version
    FROM candidates c JOIN model_versions m ON c.name = m.name AND c.job_name = m.source_job_name
    WHERE m.approval_status = 'approved' AND m.lineage_status = 'validated'
      AND (c.candidate_id % 4 = 0 OR m.data_config = 'configs/data.yaml')
      AND (c.candidate_id % 2 = 0 OR m.candidate_model_name = 'logreg')
    GROUP BY c.candidate_id, c.name""",
)
def reusable_model(spark, sf):
    releases = derived(spark, sf, "candidates").selectExpr(
        "candidate_id AS release_id", "name", "job_name AS source_job_name",
        "CASE WHEN candidate_id % 4 <> 0 THEN 'configs/data.yaml' END AS data_config",
        "CAST(NULL AS STRING) AS train_config",
        "CASE WHEN candidate_id % 2 <> 0 THEN 'logreg' END AS model_name",
    )
    return registry.reusable_versions(releases, model_versions(spark, sf))


_PROMOTION_SQL = f"""WITH {derived_sql('model_versions')}, {derived_sql('candidates')}, {_BASELINES_SQL},
    scored AS (SELECT candidate_id, c.name, coalesce(score, 0.0) AS candidate_score, coalesce(b.f1, 0.0) AS baseline_score,
                      coalesce(score, 0.0) - coalesce(b.f1, 0.0) AS improvement
               FROM candidates c LEFT JOIN baselines b ON c.name = b.name),
    decided AS (
      SELECT candidate_id, name, round(candidate_score, 6) AS candidate_score, round(baseline_score, 6) AS baseline_score,
             round(improvement, 6) AS improvement,
             concat_ws(',', CASE WHEN candidate_score < 0.3 THEN 'candidate_below_minimum_score' END,
                            CASE WHEN improvement < 0.01 THEN 'improvement_below_threshold' END) AS reasons,
             CASE WHEN candidate_score < 0.3 OR improvement < 0.01 THEN 'reject' ELSE 'promote' END AS status
      FROM scored)"""


def _decisions(spark, sf):
    baselines = registry.latest_approved(model_versions(spark, sf))
    return registry.promotion(derived(spark, sf, "candidates"), baselines, 0.01, 0.3)


@plans.query("promotion_gate", f"{_PROMOTION_SQL} SELECT * FROM decided")
def promotion_gate(spark, sf):
    return rounded(_decisions(spark, sf).withColumn("reasons", F.concat_ws(",", "reasons")))


@plans.query(
    "promotable",
    f"""{_PROMOTION_SQL} SELECT name, count(*) FILTER (WHERE status = 'promote') AS allowed,
        count(*) FILTER (WHERE status <> 'promote') AS refused FROM decided GROUP BY name""",
)
def promotable(spark, sf):
    allowed, refused = registry.promotable(_decisions(spark, sf))
    both = allowed.select("name", F.lit(1).alias("ok")).unionAll(refused.select("name", F.lit(0)))
    return both.groupBy("name").agg(
        F.sum("ok").alias("allowed"), F.sum(1 - F.col("ok")).alias("refused")
    )


@plans.query(
    "model_tags",
    f"""WITH {derived_sql('candidates')}
    SELECT candidate_id, 'approved' AS approval_status, job_name AS source_job_name, 'f1' AS primary_metric,
           CASE WHEN score IS NULL THEN '0.0' ELSE CAST(score AS VARCHAR) END AS f1, '0.0' AS roc_auc,
           'promote' AS promotion_status, 'unknown' AS candidate_model_name, 'configs/data.yaml' AS data_config,
           CAST(candidate_id AS VARCHAR) AS git_commit
    FROM candidates""",
)
def model_tags(spark, sf):
    rows = derived(spark, sf, "candidates").select(
        "candidate_id", "job_name", F.lit("promote").alias("status"), F.lit(None).cast("string").alias("primary_metric"),
        F.map_filter(F.create_map(F.lit("f1"), F.col("score")), lambda k, v: v.isNotNull()).alias("metrics"),
        F.lit(None).cast("string").alias("model_name"),
        F.create_map(F.lit("data_config"), F.lit("configs/data.yaml"), F.lit("f1"), F.lit("stale"),
                     F.lit("git_commit"), F.col("candidate_id").cast("string")).alias("lineage"),
    )
    names = ["approval_status", "source_job_name", "primary_metric", "f1", "roc_auc", "promotion_status",
             "candidate_model_name", "data_config", "git_commit"]
    return registry.version_tags(rows).select("candidate_id", *[F.col("tags")[n].alias(n) for n in names])


# --- lineage ---------------------------------------------------------------------------

_NORMAL = """CASE WHEN strpos('/' || replace(trim({c}), chr(92), '/') || '/', '/configs/') > 0
    THEN ltrim(substr('/' || replace(trim({c}), chr(92), '/'), strpos('/' || replace(trim({c}), chr(92), '/') || '/', '/configs/')), '/')
    ELSE regexp_extract(replace(trim({c}), chr(92), '/'), '[^/]*$') END"""


@plans.query(
    "lineage_status",
    f"""WITH {derived_sql('declared_lineage')}, {derived_sql('job_manifests')},
    j AS (SELECT d.release_id, d.allow_mismatch, coalesce(m.train_present, false) AS tp, coalesce(m.validation_present, false) AS vp,
                 {_NORMAL.format(c='d.data_config')} AS dd, {_NORMAL.format(c='d.train_config')} AS dt,
                 CASE WHEN m.data_config IS NULL THEN NULL ELSE {_NORMAL.format(c='m.data_config')} END AS sd,
                 CASE WHEN m.train_config IS NULL THEN NULL ELSE {_NORMAL.format(c='m.train_config')} END AS st
          FROM declared_lineage d LEFT JOIN job_manifests m ON d.job_name = m.job_name),
    e AS (SELECT *, sd IS NOT NULL AND dd <> sd AND regexp_extract(dd, '[^/]*$') <> regexp_extract(sd, '[^/]*$') AS bd,
                 st IS NOT NULL AND dt <> st AND regexp_extract(dt, '[^/]*$') <> regexp_extract(st, '[^/]*$') AS bt FROM j),
    s AS (SELECT *, CASE WHEN (bd OR bt) AND allow_mismatch THEN 'mismatch_allowed' WHEN bd OR bt THEN 'failed'
                         WHEN sd IS NOT NULL OR st IS NOT NULL THEN 'validated' ELSE 'unverified' END AS lineage_status FROM e)
    SELECT release_id, lineage_status, CASE lineage_status WHEN 'mismatch_allowed' THEN 'override' ELSE lineage_status END AS validation_status,
           CASE WHEN lineage_status = 'failed' THEN concat_ws(',', CASE WHEN bd THEN 'data_config' END, CASE WHEN bt THEN 'train_config' END) ELSE '' END AS errors,
           concat_ws(',', CASE WHEN NOT tp THEN 'train_manifest_unavailable' END, CASE WHEN NOT vp THEN 'validation_manifest_unavailable' END,
                     CASE WHEN lineage_status = 'mismatch_allowed' AND bd THEN 'data_config' END,
                     CASE WHEN lineage_status = 'mismatch_allowed' AND bt THEN 'train_config' END) AS warnings,
           CASE WHEN lineage_status = 'failed' THEN dd ELSE coalesce(sd, dd) END AS data_config,
           CASE WHEN lineage_status = 'failed' THEN dt ELSE coalesce(st, dt) END AS train_config
    FROM s""",
)
def lineage_status(spark, sf):
    rows = lineage.lineage_status(derived(spark, sf, "declared_lineage"), derived(spark, sf, "job_manifests"))
    return rows.withColumns({c: F.concat_ws(",", c) for c in ("errors", "warnings")})


@plans.query(
    "dataset_inventory",
    f"""WITH {derived_sql('dataset_identifiers')}
    SELECT CASE WHEN trim(raw) LIKE 'azureml:%' AND trim(raw) NOT LIKE 'azureml://%' THEN 'azureml_asset'
                WHEN raw LIKE '%://%' THEN 'uri' ELSE 'local_path' END AS kind, count(*) AS datasets,
           count(DISTINCT trim(raw)) AS identifiers
    FROM dataset_identifiers GROUP BY 1""",
)
def dataset_inventory(spark, sf):
    rows = derived(spark, sf, "dataset_identifiers")
    return rows.groupBy(lineage.dataset_kind(F.col("raw")).alias("kind")).agg(
        F.count("*").alias("datasets"), F.count_distinct(F.trim("raw")).alias("identifiers")
    )


# --- handoff, capture, monitor ---------------------------------------------------------

HANDOFF_SQL = """
handoff AS (
  SELECT *, CASE
    WHEN release_status = 'failed' AND failure_stage IS NOT NULL AND endpoint_name IS NULL AND deployment_name IS NULL THEN 'deploy_failed_before_handoff'
    WHEN endpoint_name IS NULL AND deployment_name IS NULL THEN 'not_deployed'
    WHEN release_status = 'succeeded' AND deployment_state = 'Succeeded' AND traffic_updated AND smoke_invoked AND coalesce(canary_status, '') = 'passed' THEN
      CASE WHEN capture_enabled AND capture_status = 'healthy' THEN 'ready_for_repo_owned_inference_capture_handoff'
           WHEN capture_enabled AND capture_status = 'degraded' THEN 'capture_degraded_after_deploy'
           ELSE 'ready_for_basic_monitoring_handoff' END
    WHEN finalization_timed_out OR coalesce(failure_stage, '') = 'deployment_finalization_timeout' THEN 'deploy_incomplete_or_timed_out'
    WHEN release_status = 'failed' AND deployment_state = 'Succeeded' AND traffic_updated THEN 'canary_failed_after_deploy'
    WHEN release_status = 'failed' THEN 'deploy_failed_before_handoff'
    ELSE 'not_deployed' END AS handoff_status
  FROM releases)"""

_EVIDENCE = ("CASE handoff_status WHEN 'ready_for_repo_owned_inference_capture_handoff'"
             " THEN 'repo_owned_inference_capture' ELSE 'release_evidence_only' END")


@plans.query(
    "handoff_status",
    f"WITH {derived_sql('releases')}, {HANDOFF_SQL} SELECT release_id, handoff_status, {_EVIDENCE} AS evidence_level FROM handoff",
)
def handoff_status(spark, sf):
    return gates.handoff_status(derived(spark, sf, "releases")).select("release_id", "handoff_status", "evidence_level")


@plans.query(
    "release_records",
    f"""WITH {derived_sql('releases')}, {HANDOFF_SQL}
    SELECT release_id, release_status AS status, endpoint_name, failure_stage, canary_status AS validation_status,
           CASE WHEN coalesce(capture_status, '') = '' THEN CASE WHEN capture_enabled THEN 'unknown' ELSE 'disabled' END
                ELSE capture_status END AS capture_status,
           capture_enabled, handoff_status, {_EVIDENCE} AS evidence_level FROM handoff""",
)
def release_records(spark, sf):
    rows = gates.release_records(derived(spark, sf, "releases"))
    return rows.select(
        "release_id", "status", "deployment.endpoint_name", "failure.failure_stage", "canary_inference.validation_status",
        F.col("deployment_capture.status").alias("capture_status"), F.col("deployment_capture.enabled").alias("capture_enabled"),
        F.col("monitoring_handoff.status").alias("handoff_status"), "monitoring_handoff.evidence_level",
    )


CONFIG = gates.MonitorConfig(min_capture_records=3, expected_feature_count=2, max_single_class_share=0.45)

# Capture facts per path, as SQL.
FACTS_SQL = f"""{CAPTURE_SQL},
labels_by_path AS (SELECT user_id, label, count(*) AS n FROM capture_outputs GROUP BY user_id, label),
facts AS (
  SELECT concat('captures/dep-', r.user_id) AS capture_path, r.n AS record_count, ok AS schema_consistent,
         CAST(coalesce(p, 0) AS BIGINT) AS predictions, coalesce(m * 1.0 / p, 0.0) AS max_single_class_share
  FROM (SELECT user_id, count(*) AS n, bool_and(feature_count = 2) AS ok FROM capture_records GROUP BY user_id) r
  LEFT JOIN (SELECT user_id, sum(n) AS p, max(n) AS m FROM labels_by_path GROUP BY user_id) s ON r.user_id = s.user_id)"""


def _records(spark, sf):
    return capture.parse_capture_lines(capture_lines(spark, sf).withColumnRenamed("path", "capture_path"))


def capture_facts_of(spark, sf):
    return capture.capture_facts(_records(spark, sf), ["capture_path"], CONFIG.expected_feature_count)


def read_facts_of(spark, sf):
    """Facts of every path that was read, with or without records."""
    return capture.with_read_paths(capture_facts_of(spark, sf), capture_lines(spark, sf).withColumnRenamed("path", "capture_path"))


@plans.query(
    "capture_scan",
    f"""WITH {CAPTURE_SQL}
    SELECT concat(user_id, '-', chunk) AS request_id, concat('endpoint-', user_id % 5) AS endpoint_name,
           concat('dep-', user_id) AS deployment_name, CAST(user_id % 3 + 1 AS VARCHAR) AS model_version, row_count,
           nullif(feature_count, -1) AS feature_count, strftime(ts, '%Y-%m-%d %H:%M:%S') AS captured_at
    FROM capture_records""",
)
def capture_scan(spark, sf):
    return _records(spark, sf).select(
        "request_id", "endpoint_name", "deployment_name", "model_version", "row_count", "feature_count",
        F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("captured_at"),
    )


@plans.query(
    "capture_rejects",
    f"""WITH {CAPTURE_SQL}
    SELECT 'accepted' AS reason, count(*) AS n FROM capture_records
    UNION ALL SELECT 'blank', count(*) FILTER (WHERE user_id % 4 = 1) FROM capture_records
    UNION ALL SELECT 'not_object', count(*) FILTER (WHERE user_id % 4 <> 1) FROM capture_records""",
)
def capture_rejects(spark, sf):
    return capture.capture_rejects(capture_lines(spark, sf))


@plans.query(
    "prediction_distribution",
    f"""WITH {CAPTURE_SQL} SELECT concat('dep-', user_id) AS deployment_name, label, count(*) AS n
    FROM capture_outputs GROUP BY user_id, label""",
)
def prediction_distribution(spark, sf):
    return capture.prediction_distribution(_records(spark, sf), ["deployment_name"])


@plans.query(
    "capture_facts",
    f"WITH {FACTS_SQL} SELECT capture_path, record_count, schema_consistent, predictions,"
    " round(max_single_class_share, 6) AS max_single_class_share FROM facts",
)
def capture_facts(spark, sf):
    return rounded(capture_facts_of(spark, sf))


_CAPTURE_CASE = """CASE WHEN coalesce(capture_path, '') = '' THEN 'not_configured' WHEN record_count IS NULL THEN 'missing'
    WHEN record_count < 3 THEN 'insufficient_records' WHEN NOT schema_consistent THEN 'schema_inconsistent'
    WHEN predictions = 0 THEN 'prediction_distribution_unavailable'
    WHEN max_single_class_share > 0.45 THEN 'class_balance_exceeded' ELSE 'healthy' END"""


@plans.query(
    "capture_status",
    f"""WITH {derived_sql('releases')}, {FACTS_SQL},
    t AS (SELECT release_id, deployment_capture_path AS capture_path FROM releases)
    SELECT t.release_id, t.capture_path, {_CAPTURE_CASE.replace('capture_path', 't.capture_path')} AS observed_capture_status,
           coalesce(record_count, 0) AS capture_record_count
    FROM t LEFT JOIN facts f ON t.capture_path = f.capture_path""",
)
def capture_status(spark, sf):
    targets = derived(spark, sf, "releases").selectExpr("release_id", "deployment_capture_path AS capture_path")
    rows = gates.capture_status(targets, read_facts_of(spark, sf), CONFIG)
    return rows.select("release_id", "capture_path", "observed_capture_status", "capture_record_count")


MONITOR_SQL = f"""{derived_sql('releases')}, {HANDOFF_SQL}, {FACTS_SQL},
located AS (SELECT *, {_EVIDENCE} AS base_evidence,
                   CASE WHEN record_present THEN coalesce(handoff_capture_path, deployment_capture_path) END AS capture_path FROM handoff),
observed AS (
  SELECT l.*, record_count, {_CAPTURE_CASE.replace('capture_path', 'l.capture_path')} AS seen,
         coalesce(record_count, 0) AS capture_record_count,
         deployment_state = 'Succeeded' AS deployed, coalesce(canary_status, '') = 'passed' AND smoke_invoked AS canary
  FROM located l LEFT JOIN facts f ON l.capture_path = f.capture_path),
cased AS (
  SELECT *, CASE WHEN NOT record_present THEN 'blocked' WHEN seen = 'healthy' THEN 'backed'
                 WHEN seen = 'class_balance_exceeded' THEN 'unbalanced'
                 WHEN capture_enabled AND capture_status = 'healthy' THEN 'unretrieved'
                 WHEN deployed AND canary THEN 'limited' ELSE 'incomplete' END AS k FROM observed),
monitored AS (
  SELECT release_id, record_present, k,
         CASE k WHEN 'blocked' THEN 'blocked' WHEN 'backed' THEN 'capture_backed' WHEN 'limited' THEN 'limited_but_healthy' ELSE 'degraded' END AS monitor_status,
         CASE k WHEN 'blocked' THEN 'none' WHEN 'backed' THEN 'repo_owned_inference_capture' ELSE base_evidence END AS evidence_level,
         CASE k WHEN 'blocked' THEN 'blocked' ELSE handoff_status END AS monitoring_handoff_status,
         CASE k WHEN 'blocked' THEN 'unknown' ELSE coalesce(runtime_contract, 'unknown') END AS runtime_contract,
         CASE k WHEN 'blocked' THEN 'not_evaluated' WHEN 'backed' THEN 'healthy' WHEN 'unbalanced' THEN 'class_balance_exceeded'
                WHEN 'unretrieved' THEN 'expected_but_unavailable'
                WHEN 'limited' THEN CASE WHEN runtime_contract = 'generated_runtime_still_in_control' THEN 'not_available_for_this_runtime_contract'
                                         ELSE coalesce(capture_status, 'disabled') END
                ELSE coalesce(capture_status, 'disabled') END AS capture_status,
         CASE k WHEN 'blocked' THEN NULL WHEN 'backed' THEN 'caller_side' WHEN 'unbalanced' THEN 'caller_side'
                WHEN 'unretrieved' THEN 'deployment_configured_but_unretrieved' ELSE 'release_evidence_only' END AS capture_evidence_source,
         CASE k WHEN 'blocked' THEN NULL WHEN 'backed' THEN 'retrieved' WHEN 'unbalanced' THEN 'retrieved'
                WHEN 'unretrieved' THEN 'missing' ELSE 'not_run' END AS caller_capture_status,
         capture_record_count FROM cased)"""

_MONITOR_COLUMNS = [
    "release_id", "monitor_status", "evidence_level", "monitoring_handoff_status", "runtime_contract",
    "capture_status", "capture_evidence_source", "caller_capture_status", "capture_record_count",
]


def monitored(spark, sf):
    return gates.monitor_status(derived(spark, sf, "releases"), read_facts_of(spark, sf), CONFIG)


@plans.query("monitor_status", f"WITH {MONITOR_SQL} SELECT {', '.join(_MONITOR_COLUMNS)} FROM monitored")
def monitor_status(spark, sf):
    return monitored(spark, sf).select(*_MONITOR_COLUMNS)


POLICY_SQL = f"""{MONITOR_SQL},
policed AS (
  SELECT *, CASE WHEN NOT record_present THEN 'n' WHEN k = 'unbalanced' THEN 'c' WHEN monitor_status IN ('degraded', 'blocked') THEN 'i' ELSE 'q' END AS d
  FROM monitored),
policy AS (
  SELECT release_id, monitor_status, capture_status, evidence_level,
         CASE d WHEN 'c' THEN 'retraining_candidate' WHEN 'q' THEN 'no_retraining_signal' ELSE 'investigate_before_retraining' END AS trigger,
         CASE d WHEN 'n' THEN 'release_record_missing' WHEN 'c' THEN 'prediction_class_balance_exceeded'
                WHEN 'i' THEN CASE WHEN capture_status = 'expected_but_unavailable' THEN 'capture_expected_but_unretrieved' ELSE 'monitor_status_degraded' END
                ELSE concat(CASE monitor_status WHEN 'capture_backed' THEN 'capture_backed_healthy' ELSE 'release_evidence_healthy' END,
                            CASE WHEN runtime_contract = 'repo_owned_scoring_proven' AND evidence_level = 'repo_owned_inference_capture'
                                 THEN ',repo_owned_runtime_confirmed' ELSE '' END) END AS reason_codes,
         CASE d WHEN 'c' THEN 'fixed_train' END AS recommended_training_path,
         CASE d WHEN 'c' THEN 'fixed_train' ELSE 'none' END AS path_recommendation,
         CASE d WHEN 'c' THEN 'bounded_refresh_candidate' WHEN 'q' THEN 'no_retraining_signal' ELSE 'investigate_before_retraining' END AS path_recommendation_reason_codes,
         CASE d WHEN 'n' THEN 'high' WHEN 'q' THEN 'low' ELSE 'medium' END AS drift_severity,
         CASE d WHEN 'n' THEN 'weak' WHEN 'q' THEN 'strong' ELSE 'moderate' END AS policy_confidence,
         d <> 'q' AS requires_dataset_freeze, d IN ('n', 'i') AS requires_human_review
  FROM policed)"""


@plans.query(
    "retraining_policy",
    f"""WITH {POLICY_SQL} SELECT release_id, trigger, reason_codes, recommended_training_path, path_recommendation,
        path_recommendation_reason_codes, drift_severity, policy_confidence, requires_dataset_freeze, requires_human_review FROM policy""",
)
def retraining_policy(spark, sf):
    rows = gates.retraining_policy(monitored(spark, sf), gates.RetrainingConfig())
    return rows.select(
        "release_id", "trigger", F.concat_ws(",", "reason_codes").alias("reason_codes"), "recommended_training_path",
        "path_recommendation", F.concat_ws(",", "path_recommendation_reason_codes").alias("path_recommendation_reason_codes"),
        "drift_severity", "policy_confidence", "requires_dataset_freeze", "requires_human_review",
    )


@plans.query(
    "retraining_decision",
    f"""WITH {POLICY_SQL} SELECT release_id, trigger, reason_codes, monitor_status, capture_status, evidence_level FROM policy""",
)
def retraining_decision(spark, sf):
    rows = gates.retraining_decision(gates.retraining_policy(monitored(spark, sf), gates.RetrainingConfig()))
    s = "recommendation_summary"
    return rows.select(
        "release_id", "trigger", F.concat_ws(",", f"{s}.reason_codes").alias("reason_codes"),
        f"{s}.monitor_status", f"{s}.capture_status", f"{s}.evidence_level",
    )


@plans.query(
    "handoff_rollup",
    f"""WITH {MONITOR_SQL}
    SELECT CASE monitor_status WHEN 'capture_backed' THEN 'capture_backed_monitoring_ready' WHEN 'limited_but_healthy' THEN 'release_evidence_only_ready'
                WHEN 'degraded' THEN 'needs_attention' ELSE 'blocked' END AS handoff, count(*) AS releases
    FROM monitored GROUP BY 1""",
)
def handoff_rollup(spark, sf):
    rows = monitored(spark, sf)
    return rows.groupBy(gates.handoff_rollup(F.col("monitor_status")).alias("handoff")).agg(F.count("*").alias("releases"))


@plans.query(
    "signal_persistence",
    f"""WITH {derived_sql('monitor_history')}
    SELECT deployment, run_id, CASE WHEN sum(CASE WHEN fired THEN 1 ELSE 0 END) OVER w = 3 THEN 'repeated_signal' ELSE 'single_event' END AS signal_persistence
    FROM monitor_history WINDOW w AS (PARTITION BY deployment ORDER BY run_at, run_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def signal_persistence(spark, sf):
    rows = capture.signal_persistence(derived(spark, sf, "monitor_history"), "deployment", ["run_at", "run_id"], "fired", 3, chunk_rows=20)
    return rows.select("deployment", "run_id", "signal_persistence")


# --- evidence, retraining path ---------------------------------------------------------

@plans.query(
    "capture_evidence",
    """SELECT concat('2024/', user_id, '/', event_id, '.jsonl') AS path, length(props) + 100 AS bytes
       FROM events WHERE event_id % 5 IN (1, 2) AND event_id % 3 <> 0""",
)
def capture_evidence(spark, sf):
    files = derived(spark, sf, "capture_files").where("CAST(regexp_extract(path, '([0-9]+).jsonl', 1) AS BIGINT) % 3 <> 0")
    found, _ = capture.exact_evidence(derived(spark, sf, "capture_manifests"), files)
    return found


@plans.query(
    "capture_evidence_missing",
    """SELECT event_id AS manifest_id, concat('2024/', user_id, '/', event_id, '.jsonl') AS path
       FROM events WHERE event_id % 5 IN (1, 2) AND event_id % 3 = 0""",
)
def capture_evidence_missing(spark, sf):
    files = derived(spark, sf, "capture_files").where("CAST(regexp_extract(path, '([0-9]+).jsonl', 1) AS BIGINT) % 3 <> 0")
    _, absent = capture.exact_evidence(derived(spark, sf, "capture_manifests"), files)
    return absent.select("manifest_id", "path")


@plans.query(
    "path_selection",
    f"""WITH {derived_sql('decisions')}, {derived_sql('candidate_manifests')}, {derived_sql('validations')},
    j AS (SELECT d.candidate_id, coalesce(v.status, 'unknown') AS validation_status,
                 CASE WHEN recommended_training_path IN ('fixed_train', 'model_sweep') THEN recommended_training_path
                      WHEN training_path_recommendation IN ('fixed_train', 'model_sweep') THEN training_path_recommendation END AS selected_path
          FROM decisions d LEFT JOIN (SELECT * FROM candidate_manifests WHERE candidate_id % 7 <> 0) m ON d.candidate_id = m.candidate_id
                           LEFT JOIN validations v ON d.candidate_id = v.candidate_id)
    SELECT *, CASE WHEN validation_status <> 'passed' OR selected_path IS NULL THEN 'blocked'
                   WHEN selected_path = 'model_sweep' THEN 'prepared_hpo_handoff' ELSE 'dry_run_ready' END AS status FROM j""",
)
def path_selection(spark, sf):
    return gates.select_path(
        derived(spark, sf, "decisions"),
        derived(spark, sf, "candidate_manifests").where("candidate_id % 7 <> 0"),
        derived(spark, sf, "validations"),
    )


@plans.query(
    "candidate_opening",
    f"""WITH {derived_sql('decisions')}
    SELECT CASE trigger WHEN 'no_retraining_signal' THEN 'no_candidate_opened' WHEN 'retraining_candidate' THEN 'candidate_opened'
                ELSE 'investigation_required' END AS opening_status, count(*) AS n FROM decisions GROUP BY 1""",
)
def candidate_opening(spark, sf):
    rows = gates.candidate_opening(derived(spark, sf, "decisions"))
    return rows.groupBy("opening_status").agg(F.count("*").alias("n"))


# --- logs ------------------------------------------------------------------------------

_LINES_SQL = f"""{derived_sql('deployment_logs')},
lines AS (SELECT deployment, chunk, trim(unnest(string_split(text, chr(10)))) AS line FROM deployment_logs)"""
_MARKED = "(" + " OR ".join(f"contains(line, '{m}')" for m in logs.FAILURE_MARKERS) + ")"


@plans.query("marker_lines", f"WITH {_LINES_SQL} SELECT deployment, chunk, line FROM lines WHERE {_MARKED}")
def marker_lines(spark, sf):
    return logs.marker_lines(derived(spark, sf, "deployment_logs")).select("deployment", "chunk", "line")


@plans.query(
    "document_markers",
    """SELECT lang, count(*) AS line_count FROM (
         SELECT lang, trim(unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM documents)
       WHERE line <> '' AND (contains(line, 'http') OR contains(line, '@')) GROUP BY lang""",
)
def document_markers(spark, sf):
    lines = logs.marker_lines(table(spark, sf, "documents").select("lang", "text"), ("http", "@"))
    return lines.groupBy("lang").agg(F.count("*").alias("line_count"))


@plans.query(
    "runtime_contract",
    f"""WITH {derived_sql('deployment_logs')}
    SELECT deployment, CASE WHEN run THEN 'repo_owned_scoring_proven' WHEN clue THEN 'generated_runtime_still_in_control' ELSE 'inconclusive' END AS runtime_contract,
           CASE WHEN run THEN 'REPO_OWNED_SCORER_RUN=' ELSE '' END AS markers, run AS observed
    FROM (SELECT deployment, bool_or(contains(text, 'REPO_OWNED_SCORER_RUN=')) AS run, bool_or(contains(text, 'ERROR:entry_module:')) AS clue
          FROM deployment_logs GROUP BY deployment)""",
)
def runtime_contract(spark, sf):
    rows = logs.runtime_contract(derived(spark, sf, "deployment_logs"))
    return rows.withColumn("markers", F.concat_ws(",", "markers"))


@plans.query(
    "failure_from_logs",
    f"""WITH {_LINES_SQL}, {derived_sql('failures')},
    marked AS (SELECT * FROM lines WHERE {_MARKED}),
    found AS (SELECT deployment, count(*) AS n, min_by(line, chunk) FILTER (WHERE line LIKE 'ValueError:%') AS v FROM marked GROUP BY deployment)
    SELECT f.deployment,
           CASE WHEN v IS NOT NULL THEN 'ValueError' ELSE CASE CAST(substr(f.deployment, 5) AS BIGINT) % 4 WHEN 0 THEN 'KeyError' WHEN 2 THEN 'OSError' ELSE 'RuntimeError' END END AS error_type,
           CASE WHEN v IS NOT NULL THEN substr(v, 13) ELSE CASE CAST(substr(f.deployment, 5) AS BIGINT) % 4
                WHEN 0 THEN concat('column ', substr(f.deployment, 5), ': missing') WHEN 1 THEN 'plain failure' WHEN 2 THEN 'disk' ELSE ':' END END AS error_message,
           coalesce(n, 0) AS excerpt_lines
    FROM failures f LEFT JOIN found o ON f.deployment = o.deployment""",
)
def failure_from_logs(spark, sf):
    return logs.enrich_failures(derived(spark, sf, "failures"), derived(spark, sf, "deployment_logs"))
