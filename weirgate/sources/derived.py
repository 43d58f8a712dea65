"""Lifecycle tables derived row by row from the given tables.

The given data has no trials, releases or logs, so each is a projection of a large table
and grows with it. The expressions are plain SQL that both engines read, so the
correctness check needs no second definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.sources.tables import table

# name -> (source table, {column: expression})
ROWWISE: dict[str, tuple[str, dict[str, str]]] = {
    # Trials of sweeps; prices give many ties, small quantities a missing second metric.
    "trials": (
        "lineitem",
        {
            "sweep_id": "l_orderkey",
            "model_name": "CASE l_linenumber % 4 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg'"
            " WHEN 2 THEN 'xgboost' ELSE 'svm' END",
            "run_id": "concat('run-', l_partkey, '-', l_suppkey, '-', l_linenumber)",
            "seq": "l_partkey * 10 + l_linenumber",
            "f1": "l_discount * 10",
            "roc_auc": "CASE WHEN l_quantity >= 5 THEN l_tax * 10 END",
        },
    ),
    # Registered model versions; tags as columns here, as a map in the library.
    "model_versions": (
        "orders",
        {
            "name": "concat('model-', o_custkey)",
            "version": "CAST(o_orderkey AS STRING)",
            "approval_status": "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'approved' ELSE 'candidate' END",
            "f1": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('0.', lpad(CAST(o_orderkey % 97 AS STRING), 2, '0')) END",
            "roc_auc": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('0.', lpad(CAST(o_orderkey % 89 AS STRING), 2, '0')) END",
            "source_job_name": "concat('job-', o_custkey)",
            "lineage_status": "CASE WHEN o_orderpriority < '4' THEN 'validated' ELSE 'unverified' END",
            "data_config": "CASE WHEN o_orderkey % 3 = 0 THEN 'configs/data_smoke.yaml' ELSE 'configs/data.yaml' END",
            "candidate_model_name": "CASE o_orderkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'xgboost' END",
        },
    ),
    # Candidates waiting for promotion.
    "candidates": (
        "orders",
        {
            "candidate_id": "o_orderkey",
            "name": "concat('model-', o_custkey)",
            "score": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE (o_orderkey * 7 % 97) / CAST(100 AS DOUBLE) END",
            "job_name": "concat('job-', o_custkey)",
        },
    ),
    "releases": (
        "orders",
        {
            "release_id": "o_orderkey",
            "release_status": "CASE WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'succeeded' END",
            "endpoint_name": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('endpoint-', o_custkey % 5) END",
            "deployment_name": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('dep-', o_custkey) END",
            "deployment_state": "CASE o_orderstatus WHEN 'P' THEN 'Failed' ELSE 'Succeeded' END",
            "traffic_updated": "o_orderkey % 3 <> 0",
            "smoke_invoked": "o_orderkey % 5 <> 0",
            "finalization_timed_out": "o_orderkey % 13 = 0",
            "failure_stage": "CASE WHEN o_orderkey % 4 <> 0 THEN NULL WHEN o_orderkey % 16 = 0"
            " THEN 'deployment_finalization_timeout' ELSE 'canary' END",
            "canary_status": "CASE o_orderpriority WHEN '1-URGENT' THEN 'failed' WHEN '5-LOW' THEN NULL ELSE 'passed' END",
            "capture_enabled": "o_orderkey % 2 = 0",
            "capture_status": "CASE o_orderkey % 6 WHEN 0 THEN 'healthy' WHEN 1 THEN 'degraded' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE 'healthy' END",
            "runtime_contract": "CASE o_orderkey % 3 WHEN 0 THEN 'repo_owned_scoring_proven' WHEN 1 THEN 'generated_runtime_still_in_control' ELSE NULL END",
            "record_present": "o_orderkey % 23 <> 0",
            "handoff_capture_path": "CASE WHEN o_orderkey % 10 < 3 THEN concat('captures/dep-', o_custkey) END",
            "deployment_capture_path": "CASE WHEN o_orderkey % 10 BETWEEN 2 AND 6 THEN concat('captures/dep-', o_custkey) END",
        },
    ),
    # Declared config paths against the manifests of the source job.
    "declared_lineage": (
        "orders",
        {
            "release_id": "o_orderkey",
            "job_name": "concat('job-', o_custkey)",
            "data_config": "CASE o_orderkey % 4 WHEN 0 THEN 'configs/data.yaml' WHEN 1 THEN concat('C:', chr(92), 'repo', chr(92), 'configs', chr(92), 'data.yaml')"
            " WHEN 2 THEN '/tmp/x/data_smoke.yaml' ELSE ' /a/configs/sub/data.yaml ' END",
            "train_config": "CASE o_orderkey % 3 WHEN 0 THEN 'configs/train.yaml' WHEN 1 THEN 'train_smoke.yaml' ELSE 'repo/configs/train.yaml' END",
            "allow_mismatch": "o_orderkey % 5 = 0",
        },
    ),
    "job_manifests": (
        "customer",
        {
            "job_name": "concat('job-', c_custkey)",
            "train_present": "c_custkey % 4 <> 0",
            "validation_present": "c_custkey % 5 <> 0",
            "train_config": "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'x/configs/train.yaml' ELSE 'configs/train_smoke.yaml' END",
            "data_config": "CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE 'configs/data.yaml' END",
        },
    ),
    # Retraining decisions, candidate manifests and validation summaries.
    "decisions": (
        "orders",
        {
            "candidate_id": "o_orderkey",
            "trigger": "CASE o_orderkey % 5 WHEN 0 THEN 'no_retraining_signal' WHEN 1 THEN 'investigate_before_retraining'"
            " WHEN 2 THEN 'policy_disabled' ELSE 'retraining_candidate' END",
            "recommended_training_path": "CASE o_orderkey % 4 WHEN 0 THEN 'fixed_train' WHEN 1 THEN 'model_sweep' WHEN 2 THEN 'none' ELSE NULL END",
        },
    ),
    "candidate_manifests": (
        "orders",
        {
            "candidate_id": "o_orderkey",
            "training_path_recommendation": "CASE o_custkey % 3 WHEN 0 THEN 'fixed_train' WHEN 1 THEN 'model_sweep' ELSE 'other' END",
        },
    ),
    "validations": (
        "orders",
        {
            "candidate_id": "o_orderkey",
            "status": "CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'passed' END",
        },
    ),
    "winner_summaries": (
        "orders",
        {"run_id": "o_orderkey", "family": "CASE o_orderkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'xgboost' END"},
    ),
    "winner_manifests": (
        "orders",
        {"run_id": "o_orderkey", "family": "CASE WHEN o_custkey % 50 = 0 THEN 'rf' WHEN o_orderkey % 3 = 0 THEN 'rf' WHEN o_orderkey % 3 = 1 THEN 'logreg' ELSE 'xgboost' END"},
    ),
    "winner_train_configs": (
        "orders",
        {"run_id": "o_orderkey", "family": "CASE WHEN o_custkey % 40 = 0 THEN 'logreg' WHEN o_orderkey % 3 = 0 THEN 'rf' WHEN o_orderkey % 3 = 1 THEN 'logreg' ELSE 'xgboost' END"},
    ),
    # What callers wrote down, and what arrived.
    "capture_manifests": (
        "events",
        {
            "manifest_id": "event_id",
            "capture_path": "CASE event_id % 5 WHEN 0 THEN NULL"
            " WHEN 1 THEN concat('azureml://datastores/store/paths/2024/', user_id, '/', event_id, '.jsonl')"
            " WHEN 2 THEN concat('azureblob://account/box/2024/', user_id, '/', event_id, '.jsonl')"
            " WHEN 3 THEN concat('ftp://host/2024/', event_id, '.jsonl')"
            " ELSE concat('azureml://datastores/store/2024/', event_id) END",
        },
    ),
    "capture_files": (
        "events",
        {"path": "concat('2024/', user_id, '/', event_id, '.jsonl')", "bytes": "length(props) + 100"},
    ),
    "dataset_identifiers": (
        "documents",
        {
            "dataset_id": "doc_id",
            "raw": "CASE doc_id % 5 WHEN 0 THEN concat(' azureml:', source, ':1') WHEN 1 THEN concat('azureml://datastores/', source)"
            " WHEN 2 THEN concat('https://host/', source, '.csv') WHEN 3 THEN concat('data/', source, '.csv ') ELSE concat('wasbs://box/', lang) END",
        },
    ),
    # Two log lines per event, glued by a line break, the second with padding.
    "deployment_logs": (
        "events",
        {
            "deployment": "concat('dep-', user_id)",
            "chunk": "event_id",
            "text": "concat(CASE event_type WHEN 'error' THEN concat('ValueError: row ', event_id, ' must be numeric')"
            " WHEN 'click' THEN concat('  INFO scored ', event_id)"
            " WHEN 'view' THEN CASE WHEN user_id % 3 = 0 THEN 'REPO_OWNED_SCORER_RUN=ok' ELSE 'idle' END"
            " WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'ERROR:entry_module: broken' ELSE 'waiting' END"
            " ELSE '' END, chr(10), '   ', CASE WHEN event_id % 9 = 0 THEN 'app RuntimeError: late' ELSE '' END, ' ')",
        },
    ),
    "failures": (
        "customer",
        {
            "deployment": "concat('dep-', c_custkey)",
            "error_text": "CASE c_custkey % 4 WHEN 0 THEN concat('Traceback', chr(10), 'KeyError: column ', c_custkey, ': missing', chr(10), ' ')"
            " WHEN 1 THEN 'plain failure' WHEN 2 THEN concat(chr(10), '  OSError: disk  ', chr(10)) ELSE ': ' END",
        },
    ),
    # Monitor runs over time.
    "monitor_history": (
        "events",
        {
            "deployment": "concat('dep-', user_id)",
            "run_at": "ts",
            "run_id": "event_id",
            "fired": "event_type IN ('error', 'signup')",
        },
    ),
    "run_log": (
        "events",
        {"run_id": "event_id", "step": "event_type", "k": "CAST(event_id % 100 AS STRING)", "user": "CAST(user_id AS STRING)"},
    ),
}

# Request bodies; every kind of defect occurs. Ten features are expected to be three here.
REQUEST_BODY = (
    "CASE o_orderkey % 12"
    " WHEN 0 THEN concat('{\"input_data\": [[', o_custkey, ', 1.5, -2]]}')"
    " WHEN 1 THEN concat('{\"input_data\": [[', o_custkey, ', 2, 3], [4, 5.25, ', o_orderkey, ']]}')"
    " WHEN 2 THEN '{\"input_data\": [[1, 2]]}'"
    " WHEN 3 THEN '{\"input_data\": [[1, 2, 3], [1, true, 3]]}'"
    " WHEN 4 THEN '{\"input_data\": [[1, 2, \"x\"]]}'"
    " WHEN 5 THEN '{\"rows\": 1}'"
    " WHEN 6 THEN '{\"input_data\": []}'"
    " WHEN 7 THEN '[1, 2, 3]'"
    " WHEN 8 THEN '{\"input_data\": [[1, 2, 3], 7]}'"
    " WHEN 9 THEN '{\"input_data\": [[1, null, 3]]}'"
    " WHEN 10 THEN '{\"input_data\": 5}'"
    " ELSE 'not json' END"
)
ROWWISE["requests"] = (
    "orders",
    {"request_id": "o_orderkey", "deployment": "concat('dep-', o_custkey)", "body": REQUEST_BODY},
)


def derived(spark: SparkSession, directory: str, name: str) -> DataFrame:
    source, columns = ROWWISE[name]
    return table(spark, directory, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def derived_sql(name: str) -> str:
    """The same table as a SQL common table expression."""
    source, columns = ROWWISE[name]
    body = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"{name} AS (SELECT {body} FROM {source})"


def trials(spark: SparkSession, directory: str) -> DataFrame:
    """Trials with their metrics as an open map; unreported metrics are absent."""
    rows = derived(spark, directory, "trials")
    metrics = F.create_map(F.lit("f1"), F.col("f1"), F.lit("roc_auc"), F.col("roc_auc"))
    return rows.select(
        "sweep_id", "model_name", "run_id", "seq", F.map_filter(metrics, lambda k, v: v.isNotNull()).alias("metrics")
    )


def model_versions(spark: SparkSession, directory: str) -> DataFrame:
    """Registered versions with a string tag map; absent tags are absent."""
    rows = derived(spark, directory, "model_versions")
    names = [c for c in rows.columns if c not in ("name", "version")]
    tags = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))])
    return rows.select("name", "version", F.map_filter(tags, lambda k, v: v.isNotNull()).alias("tags"))


# A captured request is the events of one user within a fixed run of event ids, so a
# request is bounded however active a user is.
REQUEST_SPAN = 1024

# Raw JSON token of a prediction, per event type: the same class in several spellings.
OUTPUT_TOKENS = {"click": "0", "view": "1", "purchase": '"1"', "signup": "true", "error": "0.0"}


def capture_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Capture files as text lines (path, line), with blank and non-object lines mixed in."""
    events = table(spark, directory, "events")
    token = F.lit("null")
    for kind, text in OUTPUT_TOKENS.items():
        token = F.when((F.col("event_type") == kind) & (F.col("event_id") % 50 != 0), F.lit(text)).otherwise(token)
    chunk = F.floor(F.col("event_id") / REQUEST_SPAN).cast("long")
    requests = events.groupBy("user_id", chunk.alias("chunk")).agg(
        F.min("ts").alias("ts"),
        F.count(F.lit(1)).alias("row_count"),
        F.array_sort(F.collect_list(F.struct("event_id", token.alias("token")))).alias("rows"),
    )
    feature_count = (
        F.when(F.col("user_id") % 10 == 3, F.lit(',"feature_count":"2"'))
        .when(F.col("user_id") % 10 == 4, F.lit(""))
        .when((F.col("user_id") % 10 == 5) & (F.col("chunk") % 2 == 1), F.lit(',"feature_count":3'))
        .otherwise(F.lit(',"feature_count":2'))
    )
    outputs = F.array_join(F.transform("rows", lambda r: r["token"]), ",")
    line = F.concat(
        F.lit('{"timestamp_utc":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('","request_id":"'), F.col("user_id"), F.lit("-"), F.col("chunk"),
        F.lit('","endpoint_name":"endpoint-'), (F.col("user_id") % 5).cast("string"),
        F.lit('","deployment_name":"dep-'), F.col("user_id"),
        F.lit('","model_name":"churn","model_version":"'), (F.col("user_id") % 3 + 1).cast("string"),
        F.lit('","row_count":'), F.col("row_count"), F.lit(',"captured_row_count":'), F.col("row_count"),
        feature_count, F.when(F.col("user_id") % 10 == 6, F.lit("")).otherwise(F.concat(F.lit(',"outputs":['), outputs, F.lit("]"))),
        F.lit("}"),
    )
    noise = F.when(F.col("user_id") % 4 == 0, F.lit("[1,2]")).when(F.col("user_id") % 4 == 1, F.lit("   ")).otherwise(F.lit('"text"'))
    return requests.select(
        F.concat(F.lit("captures/dep-"), F.col("user_id")).alias("path"),
        F.explode(F.array(line, noise)).alias("line"),
    )


CAPTURE_SQL = f"""
capture_rows AS (
  SELECT *, event_id // {REQUEST_SPAN} AS chunk,
         CASE WHEN event_id % 50 = 0 THEN 'None' ELSE
           CASE event_type WHEN 'click' THEN '0' WHEN 'view' THEN '1' WHEN 'purchase' THEN '1'
                           WHEN 'signup' THEN 'True' ELSE '0.0' END END AS label
  FROM events
),
capture_records AS (
  SELECT user_id, chunk, min(ts) AS ts, count(*) AS row_count,
         CASE WHEN user_id % 10 = 4 THEN -1 WHEN user_id % 10 = 5 AND chunk % 2 = 1 THEN 3 ELSE 2 END AS feature_count
  FROM capture_rows GROUP BY user_id, chunk
),
capture_outputs AS (SELECT * FROM capture_rows WHERE user_id % 10 <> 6)"""
