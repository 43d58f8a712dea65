import json
import random

import pytest
from pyspark.sql import functions as F

from weirgate.operators import capture, logs, requests


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_labels_keep_their_python_spelling(spark):
    text = json.dumps({"outputs": [0, 0.0, "0", True, False, None, 1.5, "a b"]})
    records = capture.parse_capture_lines(lines(spark, text))
    assert records.first().labels == ["0", "0.0", "0", "True", "False", "None", "1.5", "a b"]
    got = {r.label: r.n for r in capture.prediction_distribution(records.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert got["0"] == 2 and got["0.0"] == 1


def test_lines_that_are_no_records(spark):
    df = lines(spark, "", "  ", "[1]", '"x"', "3", '{"feature_count": "2", "outputs": 5}', '{"outputs": []}')
    rows = capture.parse_capture_lines(df).collect()
    assert [(r.feature_count, r.labels) for r in rows] == [(2, None), (None, [])]
    counts = {r.reason: r.n for r in capture.capture_rejects(df).collect()}
    assert counts == {"blank": 2, "not_object": 3, "accepted": 2}
    broken = lines(spark, '{"a": ')
    with pytest.raises(Exception, match="not JSON"):
        capture.parse_capture_lines(broken).collect()
    assert capture.parse_capture_lines(broken, strict=False).count() == 0


def test_facts_per_group(spark):
    texts = ['{"feature_count": 2, "outputs": [0, 0]}', '{"feature_count": 2, "outputs": [0, 1]}', '{"outputs": [1]}', '{"feature_count": 2}']
    df = spark.createDataFrame([("a", texts[0]), ("a", texts[1]), ("b", texts[2]), ("c", texts[3])], "g string, line string")
    got = {r.g: tuple(r)[1:] for r in capture.capture_facts(capture.parse_capture_lines(df), ["g"], 2).collect()}
    assert got == {"a": (2, True, 4, 0.75), "b": (1, False, 1, 1.0), "c": (1, True, 0, 0.0)}


def test_sampling_limits(spark):
    df = spark.range(4000).withColumnRenamed("id", "request_id")
    assert capture.sampled(df, 0.0).count() == 0 and capture.sampled(df, -1).count() == 0
    assert capture.sampled(df, 1.0).count() == 4000
    some = {r.request_id for r in capture.sampled(df, 0.3).collect()}
    assert 1000 < len(some) < 1400 and some == {r.request_id for r in capture.sampled(df, 0.3).collect()}
    # The number must be strictly below the rate.
    from weirgate.functions.columns import uniform

    u = df.where("request_id = 7").select(uniform(42, F.col("request_id"))).first()[0]
    assert capture.sampled(df.where("request_id = 7"), u).count() == 0


SCORED = "timestamp_utc timestamp, request_id string, endpoint_name string, deployment_name string, model_name string, model_version string, pos int, a double, b double, prediction int"


def scored(spark, n=2):
    import datetime

    return spark.createDataFrame(
        [(datetime.datetime(2024, 5, 6), "r", "e", "d", "m", "1", i, float(i), 2.0 * i, i % 2) for i in range(n)], SCORED
    )


def test_records_are_bounded_and_redacted(spark):
    settings = capture.CaptureSettings(max_rows_per_request=1, redact_inputs=True)
    row = capture.capture_records(scored(spark), ["a", "b"], settings).first()
    assert (row.row_count, row.captured_row_count, row.feature_count) == (2, 1, 2)
    assert row.inputs == [{"feature_count": 2.0}] and row.outputs == [0]
    full = capture.capture_records(scored(spark, 9), ["a", "b"], capture.CaptureSettings()).first()
    assert [r["a"] for r in full.inputs] == [0, 1, 2, 3, 4] and full.outputs == [0, 1, 0, 1, 0] and full.row_count == 9
    bare = capture.capture_records(scored(spark), ["a"], capture.CaptureSettings(capture_inputs=False, capture_outputs=False))
    assert "inputs" not in bare.columns and "outputs" not in bare.columns


def test_blob_paths(spark):
    df = spark.createDataFrame(
        [("azureml://s/w/paths/a/paths/b.jsonl",), ("azureblob://acc/box/x/y.jsonl",), ("azureblob://acc/box",), ("file:/x",), (None,)], "u string")
    got = [r[0] for r in df.select(capture.capture_blob_path(F.col("u"), strict=False)).collect()]
    assert got == ["a/paths/b.jsonl", "x/y.jsonl", None, None, None]
    with pytest.raises(Exception, match="unsupported capture URI"):
        df.select(capture.capture_blob_path(F.col("u"))).collect()


def test_relative_paths(spark):
    row = spark.createDataFrame([("2024-05-06T01:02:03Z", "r1")], "t string, r string").select(
        capture.capture_relative_path(F.lit(""), F.lit("e"), F.lit("d"), F.col("t"), F.col("r"), F.lit(None).cast("string")),
        capture.capture_relative_path(F.lit("p"), F.lit("e"), F.lit("d"), F.col("t"), F.col("r"), F.lit("s")),
    ).first()
    assert tuple(row) == ("2024/05/06/e/d/r1.jsonl", "p/2024/05/06/e/d/s/r1.jsonl")


def test_persistence_equals_a_plain_scan(spark):
    source = random.Random(4)
    rows = [("hot", i, source.random() < 0.6) for i in range(400)] + [("cold", i, True) for i in range(2)]
    df = spark.createDataFrame(rows, "d string, at long, fired boolean").repartition(5)
    for runs in (1, 3):
        out = capture.signal_persistence(df, "d", ["at"], "fired", runs, chunk_rows=16).collect()
        assert len(out) == len(rows)
        history = {d: [f for dd, _, f in rows if dd == d] for d in ("hot", "cold")}
        for r in out:
            last = history[r.d][max(0, r.at - runs + 1): r.at + 1]
            assert r.signal_persistence == ("repeated_signal" if len(last) == runs and all(last) else "single_event")


# --- requests --------------------------------------------------------------------------


def check(spark, payload, expected=10):
    body = payload if isinstance(payload, str) else json.dumps(payload)
    return requests.validate_requests(spark.createDataFrame([(1, body)], "request_id long, body string"), expected).first()


def test_request_defects(spark):
    ok = check(spark, {"input_data": [[1, 2.5, -3, 0, 1e3, 6, 7, 8, 9, 10]]})
    assert ok.status == "passed" and ok.rows[0][1] == 2.5 and ok.rows[0][4] == 1000.0
    row = list(range(10))
    for payload, want in [
        ({"input_data": [row[:9]]}, ("wrong_feature_count", 0, None)),
        ({"input_data": [row, ["0", *row[1:]]]}, ("not_numeric", 1, 0)),
        ({"input_data": [[0, True, *row[2:]]]}, ("not_numeric", 0, 1)),
        ({"input_data": [row, 3]}, ("row_not_list", 1, None)),
        ({"input_data": []}, ("input_data_empty", None, None)),
        ({"input_data": None}, ("input_data_empty", None, None)),
        ({"x": 1}, ("input_data_missing", None, None)),
        ([row], ("not_object", None, None)),
        ("{", ("not_json", None, None)),
    ]:
        got = check(spark, payload)
        assert (got.error, got.error_row, got.error_column) == want, payload
        assert got.rows is None and got.status == "failed"


def test_scoring_keeps_the_order_of_rows(spark):
    from pyspark.ml.feature import SQLTransformer

    bodies = spark.createDataFrame([(1, '{"input_data": [[3, 0], [1, 0], [2, 0]]}'), (2, "[]")], "request_id long, body string")
    aligned = requests.align_features(requests.validate_requests(bodies, 2), ["p", "q"])
    assert aligned.columns == ["request_id", "pos", "p", "q"]
    model = SQLTransformer(statement="SELECT *, p * 10 AS y FROM __THIS__")
    out = requests.responses(requests.score_rows(aligned, model), ["request_id"]).collect()
    assert [(r.request_id, r.outputs) for r in out] == [(1, [30.0, 10.0, 20.0])]


def test_response_texts(spark):
    df = spark.createDataFrame([("[1, 2]",), ('{"a": 1}',), ("oops \"q\"",), ("x" * 501,)], "r string")
    got = [tuple(r) for r in df.select(requests.response_outputs(F.col("r")), requests.preview(F.col("r"))).collect()]
    assert got[0] == ("[1, 2]", "[1, 2]") and got[1][0] == '[{"a": 1}]'
    assert json.loads(got[2][0]) == ['oops "q"'] and got[3][1] == "x" * 500 + "..."


# --- logs ------------------------------------------------------------------------------


def test_failures_from_text_and_logs(spark):
    failures = spark.createDataFrame(
        [("a", "x\n  KeyError: k: v \n\n"), ("b", "nothing"), ("c", ": y"), ("d", "E: "), ("e", "TypeError: t")], "deployment string, error_text string")
    text = [("e", 2, "ValueError: second"), ("e", 1, "noise\n  ValueError: first \nlater ValueError: not at start"), ("a", 1, "app TypeError: x")]
    log = spark.createDataFrame(text, "deployment string, chunk int, text string")
    got = {r.deployment: tuple(r)[1:] for r in logs.enrich_failures(failures, log).collect()}
    assert got == {
        "a": ("KeyError", "k: v", 1), "b": ("RuntimeError", "nothing", 0), "c": ("RuntimeError", ": y", 0),
        "d": ("RuntimeError", "E:", 0), "e": ("ValueError", "first", 3),
    }


def test_runtime_contract(spark):
    log = spark.createDataFrame(
        [("a", "x REPO_OWNED_SCORER_INIT=1"), ("a", "inputs_collector is not defined"), ("b", "outputs_collector is not defined"), ("c", ""), ("c", None)],
        "deployment string, text string")
    got = {r.deployment: (r.runtime_contract, r.markers) for r in logs.runtime_contract(log).collect()}
    assert got == {
        "a": ("repo_owned_scoring_proven", ["REPO_OWNED_SCORER_INIT="]), "b": ("generated_runtime_still_in_control", []), "c": ("inconclusive", []),
    }
