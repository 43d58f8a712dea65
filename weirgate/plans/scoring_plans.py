"""Requests, scoring, capture records and run logs over derived tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weirgate.operators import capture, requests
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import uniform_sql
from weirgate.sinks.tables import run_log
from weirgate.sources.derived import derived, derived_sql
from weirgate.sources.files import split_requests
from weirgate.sources.tables import table

plans = Registry()

WIDTH = 3


@plans.query(
    "request_scan",
    """SELECT CASE WHEN o_orderkey % 12 = 7 THEN 'not_object' WHEN o_orderkey % 12 = 11 THEN 'not_json' ELSE 'object' END AS kind,
              count(*) AS n FROM orders GROUP BY 1""",
)
def request_scan(spark, sf):
    good, bad = split_requests(derived(spark, sf, "requests"))
    both = good.select(F.lit("object").alias("kind")).unionAll(bad.select(F.col("reason").alias("kind")))
    return both.groupBy("kind").agg(F.count("*").alias("n"))


@plans.query(
    "payload_validate",
    """SELECT o_orderkey AS request_id, CASE WHEN k <= 1 THEN 'passed' ELSE 'failed' END AS status,
              CASE k WHEN 2 THEN 'wrong_feature_count' WHEN 3 THEN 'not_numeric' WHEN 4 THEN 'not_numeric' WHEN 5 THEN 'input_data_missing'
                     WHEN 6 THEN 'input_data_empty' WHEN 7 THEN 'not_object' WHEN 8 THEN 'row_not_list' WHEN 9 THEN 'not_numeric'
                     WHEN 10 THEN 'input_data_empty' WHEN 11 THEN 'not_json' END AS error,
              CASE k WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 0 WHEN 8 THEN 1 WHEN 9 THEN 0 END AS error_row,
              CASE k WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 9 THEN 1 END AS error_column
       FROM (SELECT o_orderkey, o_orderkey % 12 AS k FROM orders)""",
)
def payload_validate(spark, sf):
    rows = requests.validate_requests(derived(spark, sf, "requests"), WIDTH)
    return rows.select("request_id", "status", "error", "error_row", "error_column")


ALIGNED_SQL = """
aligned AS (
  SELECT o_orderkey AS request_id, o_custkey, 0 AS pos, CAST(o_custkey AS DOUBLE) AS feature_0,
         CASE WHEN o_orderkey % 12 = 0 THEN 1.5 ELSE 2.0 END AS feature_1, CASE WHEN o_orderkey % 12 = 0 THEN -2.0 ELSE 3.0 END AS feature_2
  FROM orders WHERE o_orderkey % 12 IN (0, 1)
  UNION ALL SELECT o_orderkey, o_custkey, 1, 4.0, 5.25, CAST(o_orderkey AS DOUBLE) FROM orders WHERE o_orderkey % 12 = 1)"""


@plans.query(
    "align_features",
    f"WITH {ALIGNED_SQL} SELECT request_id, pos, feature_0, CAST(feature_1 AS DOUBLE) AS feature_1, CAST(feature_2 AS DOUBLE) AS feature_2 FROM aligned",
)
def align_features(spark, sf):
    valid = requests.validate_requests(derived(spark, sf, "requests"), WIDTH)
    return requests.align_features(valid, expected=WIDTH).drop("deployment")


_WEIGHTS, _BIAS = [0.001, -0.2, 0.0001], -0.3
SCORED_SQL = f"""{ALIGNED_SQL},
scored AS (SELECT *, CASE WHEN -0.3 + feature_0 * 0.001 + feature_1 * -0.2 + feature_2 * 0.0001 > 0 THEN 1 ELSE 0 END AS prediction FROM aligned),
answers AS (SELECT request_id, o_custkey, '[' || string_agg(prediction, ',' ORDER BY pos) || ']' AS response, count(*) AS n FROM scored GROUP BY request_id, o_custkey)"""


def _scored(spark, sf):
    return requests.linear_scores(
        requests.validate_requests(derived(spark, sf, "requests"), WIDTH), _WEIGHTS, _BIAS
    )


@plans.query("batch_score", f"WITH {SCORED_SQL} SELECT request_id, response, response AS preview, response AS outputs FROM answers")
def batch_score(spark, sf):
    response = F.to_json("outputs")
    return _scored(spark, sf).select(
        "request_id", response.alias("response"), requests.preview(response).alias("preview"),
        requests.response_outputs(response).alias("outputs"),
    )


@plans.query(
    "response_outputs",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '[1,2]' WHEN 1 THEN '[{"a":1}]' WHEN 2 THEN '[3]' ELSE '["plain ' || lang || '"]' END AS outputs,
              CASE WHEN length(text) <= 500 THEN length(text) ELSE 503 END AS preview_length,
              CASE WHEN length(text) <= 500 THEN text ELSE left(text, 500) || '...' END AS preview
       FROM documents""",
)
def response_outputs(spark, sf):
    response = F.expr("CASE doc_id % 4 WHEN 0 THEN '[1,2]' WHEN 1 THEN '{\"a\":1}' WHEN 2 THEN '3' ELSE concat('plain ', lang) END")
    text = requests.preview(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", requests.response_outputs(response).alias("outputs"), F.length(text).cast("long").alias("preview_length"), text.alias("preview"),
    )


@plans.query(
    "canary_record",
    f"""WITH {SCORED_SQL} SELECT request_id, n AS row_count, 3 AS feature_count, 'passed' AS validation_status,
        concat('dep-', o_custkey) AS deployment_name, response AS preview FROM answers""",
)
def canary_record(spark, sf):
    rows = _scored(spark, sf).select(
        "request_id", "rows", F.lit("endpoint").alias("endpoint_name"), F.col("deployment").alias("deployment_name"),
        F.lit("churn").alias("model_name"), F.lit("1").alias("model_version"), F.to_json("outputs").alias("response"),
    )
    return requests.canary_records(rows).select(
        "request_id", "payload.row_count", "payload.feature_count", "payload.validation_status",
        "endpoint.deployment_name", "response.preview",
    )


# A scored row per event; a request is one user's events in a run of 64 event ids.
_EVENT_ROWS_SQL = """
rows_of AS (
  SELECT concat(user_id, '-', event_id // 64) AS request_id, user_id, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_id // 64 ORDER BY event_id) - 1 AS pos,
         CASE WHEN value > 10 THEN 1 ELSE 0 END AS prediction, min(ts) OVER (PARTITION BY user_id, event_id // 64) AS ts
  FROM events)"""


def scored_events(spark, sf):
    """Event rows as scored requests; the span of a request bounds its rows."""
    span = F.floor(F.col("event_id") / 64).cast("long")
    inside = Window.partitionBy("user_id", "span")
    rows = table(spark, sf, "events").withColumn("span", span)
    return rows.select(
        F.min("ts").over(inside).cast("timestamp").alias("timestamp_utc"),
        F.concat_ws("-", "user_id", "span").alias("request_id"),
        F.concat(F.lit("endpoint-"), F.col("user_id") % 5).alias("endpoint_name"),
        F.concat(F.lit("dep-"), F.col("user_id")).alias("deployment_name"),
        F.lit("churn").alias("model_name"),
        F.lit("1").alias("model_version"),
        (F.row_number().over(inside.orderBy("event_id")) - 1).alias("pos"),
        F.col("value").alias("feature_0"),
        F.get_json_object("props", "$.k").cast("double").alias("feature_1"),
        (F.col("value") > 10).cast("int").alias("prediction"),
    )


@plans.query(
    "capture_record",
    f"""WITH {_EVENT_ROWS_SQL}
    SELECT request_id, count(*) AS row_count, least(count(*), 2) AS captured_row_count, 2 AS feature_count,
           string_agg(prediction, ',' ORDER BY pos) FILTER (WHERE pos < 2) AS outputs,
           string_agg(printf('%.2f', value), ',' ORDER BY pos) FILTER (WHERE pos < 2) AS inputs
    FROM rows_of GROUP BY request_id""",
)
def capture_record(spark, sf):
    records = capture.capture_records(scored_events(spark, sf), ["feature_0", "feature_1"], capture.CaptureSettings(max_rows_per_request=2))
    return records.select(
        "request_id", "row_count", "captured_row_count", "feature_count", F.concat_ws(",", F.col("outputs").cast("array<string>")).alias("outputs"),
        F.concat_ws(",", F.transform("inputs", lambda r: F.format_string("%.2f", r["feature_0"]))).alias("inputs"),
    )


@plans.query(
    "capture_redacted",
    f"""WITH {_EVENT_ROWS_SQL}
    SELECT request_id, least(count(*), 3) AS captured_row_count, concat('[', rtrim(repeat('{{"feature_count":2.0}},', CAST(least(count(*), 3) AS INTEGER)), ','), ']') AS inputs
    FROM rows_of GROUP BY request_id""",
)
def capture_redacted(spark, sf):
    settings = capture.CaptureSettings(max_rows_per_request=3, redact_inputs=True, capture_outputs=False)
    records = capture.capture_records(scored_events(spark, sf), ["feature_0", "feature_1"], settings)
    return records.select("request_id", "captured_row_count", F.to_json("inputs").alias("inputs"))


@plans.query(
    "capture_sample",
    f"""SELECT event_id, user_id FROM events WHERE {uniform_sql(42, "event_id")} < 0.25""",
)
def capture_sample(spark, sf):
    return capture.sampled(table(spark, sf, "events").select("event_id", "user_id"), 0.25, "event_id")


@plans.query(
    "capture_partitions",
    """SELECT concat_ws('/', 'captures', strftime(ts, '%Y/%m/%d'), concat('endpoint-', user_id % 5), concat('dep-', user_id)) AS location,
              count(*) AS records, CAST(sum(length(props)) AS BIGINT) AS bytes, min(concat_ws('/', 'captures', strftime(ts, '%Y/%m/%d'),
                concat('endpoint-', user_id % 5), concat('dep-', user_id), CASE WHEN event_id % 2 = 0 THEN 's1' END, concat(event_id, '.jsonl'))) AS first_path
       FROM events GROUP BY 1""",
)
def capture_partitions(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    rows = table(spark, sf, "events").select(
        F.concat_ws("/", F.lit("captures"), capture.capture_partition(iso), F.concat(F.lit("endpoint-"), F.col("user_id") % 5),
                    F.concat(F.lit("dep-"), F.col("user_id"))).alias("location"),
        capture.capture_relative_path(
            F.lit("captures"), F.concat(F.lit("endpoint-"), F.col("user_id") % 5), F.concat(F.lit("dep-"), F.col("user_id")), iso,
            F.col("event_id").cast("string"), F.expr("CASE WHEN event_id % 2 = 0 THEN 's1' ELSE '' END"),
        ).alias("path"),
        F.length("props").alias("bytes"),
    )
    return rows.groupBy("location").agg(
        F.count("*").alias("records"), F.sum("bytes").alias("bytes"), F.min("path").alias("first_path")
    )


@plans.query(
    "run_log_redacted",
    f"""WITH {derived_sql('run_log')}
    SELECT run_id, CASE WHEN run_id % 2 = 0 THEN 'k,step' ELSE 'k,step,user' END AS keys, 'plain' AS nested,
           concat('{{"a":{{"b":[{{"c":{{"k":"', k, '"}}}},', run_id, ',[]]}},"step":"', step, '"}}') AS tree FROM run_log""",
)
def run_log_redacted(spark, sf):
    rows = derived(spark, sf, "run_log").select(
        "run_id",
        F.map_from_entries(F.array(
            *[
                F.struct(key.alias("key"), value.alias("value"))
                for key, value in (
                    (F.lit("step"), F.col("step")),
                    (F.lit("k"), F.col("k")),
                    (F.lit("API_KEY"), F.col("user")),
                    (F.lit("monkey"), F.col("user")),
                    (F.when(F.col("run_id") % 2 == 0, "userToken").otherwise("user"), F.col("user")),
                )
            ]
        )).alias("params"),
        F.create_map(F.lit("outer"), F.create_map(F.lit("plain"), F.lit("1"), F.lit("db_password"), F.lit("x")),
                     F.lit("connection_string_map"), F.create_map(F.lit("plain"), F.lit("2"))).alias("config"),
        # Four levels and lists, with marked keys at each.
        F.to_json(F.struct(
            F.struct(
                F.array(
                    F.parse_json(F.to_json(F.struct(
                        F.struct("k", F.col("user").alias("client_SECRET")).alias("c"), F.col("user").alias("access_token"),
                    ))),
                    F.parse_json(F.col("run_id").cast("string")),
                    F.parse_json(F.to_json(F.array(F.map_from_arrays(F.array(F.lit("unused")), F.array("user"))))),
                ).alias("b"),
                F.array(F.lit(1)).alias("passwords"),
            ).alias("a"),
            F.struct(F.col("k").alias("all")).alias("connection_string"),
            F.col("step"),
        )).alias("tree"),
    )
    cleaned = run_log(rows, ["params"], ["config"], ["tree"])
    return cleaned.select(
        "run_id", F.array_join(F.sort_array(F.map_keys("params")), ",").alias("keys"),
        F.array_join(F.flatten(F.transform(F.map_values("config"), lambda m: F.map_keys(m))), ",").alias("nested"),
        F.regexp_replace("tree", r"\{\"unused\":\"[^\"]*\"\}", "").alias("tree"),
    )


@plans.query(
    "union_by_name",
    """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status, NULL AS segment FROM orders
       UNION ALL SELECT c_custkey, c_acctbal, NULL, c_mktsegment FROM customer""",
)
def union_by_name(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS status")
    customers = table(spark, sf, "customer").selectExpr("c_mktsegment AS segment", "c_acctbal AS amount", "c_custkey AS id")
    return orders.unionByName(customers, allowMissingColumns=True)


@plans.query(
    "sorted_means",
    """SELECT l_returnflag, round(avg(l_discount), 6) AS mean_metric FROM lineitem GROUP BY l_returnflag ORDER BY 2""",
)
def sorted_means(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.avg("l_discount").alias("mean_metric"))
    return rounded(rows.orderBy("mean_metric"))
