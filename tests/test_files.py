import json

import pytest
from pyspark.sql import functions as F

from tests.test_capture import scored
from weirgate.operators import capture, prep
from weirgate.operators.select import family_report
from weirgate.sinks import tables as sinks
from weirgate.sources import artifacts, files

CHURN_ROWS = [
    f"{i},{20000000 + i},S{i},{'' if i == 3 else 600 + i},{['France', 'Germany', 'Spain'][i % 3]},{['Female', 'Male'][i % 2]},{30 + i},5,{1000.5 * i},2,1,0,72000.00,{i % 2}"
    for i in range(20)
]
HEADER = "RowNumber,CustomerId,Surname,CreditScore,Geography,Gender,Age,Tenure,Balance,NumOfProducts,HasCrCard,IsActiveMember,EstimatedSalary,Exited"


def write(path, *texts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(texts) + "\n")
    return str(path)


def test_csv_file_with_schema(spark, tmp_path):
    path = write(tmp_path / "churn.csv", HEADER, *CHURN_ROWS)
    df = files.read_table(spark, path, files.CHURN_SCHEMA)
    assert len(df.columns) == 14 and df.count() == 20
    assert df.where("CreditScore is null").count() == 1
    assert dict(df.dtypes)["Balance"] == "double" and dict(df.dtypes)["CustomerId"] == "bigint"


def test_csv_inference_and_missing_texts(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,c,d", "1,NA,x,", "2,1.5,N/A,", "n/a,nan,None,<NA>")
    df = files.read_table(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "double"}
    assert df.where("a is null and c is null and b is null and d is null").count() == 1


def test_directory_is_united_by_name(spark, tmp_path):
    write(tmp_path / "d" / "2.csv", "b,a", "x,1")
    write(tmp_path / "d" / "1.csv", "a,b,c", "2,y,9")
    write(tmp_path / "d" / "notes.txt", "ignored")
    rows = files.read_table(spark, str(tmp_path / "d")).collect()
    assert sorted((r.a, r.b, r.c) for r in rows) == [(1, "x", None), (2, "y", 9)] or sorted(
        [(r.a, r.b) for r in rows]
    ) == [(1, "x"), (2, "y")]
    assert {r.a: r.c for r in rows} == {1: None, 2: 9}


def test_source_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such path"):
        files.read_table(spark, str(tmp_path / "absent.csv"))
    other = write(tmp_path / "t.txt", "a", "1")
    with pytest.raises(ValueError, match="not a .csv"):
        files.read_table(spark, other)
    assert files.read_table(spark, other, strict_suffix=False).first().a == 1
    write(tmp_path / "e" / "x.txt", "a")
    with pytest.raises(FileNotFoundError, match="no .csv files"):
        files.read_table(spark, str(tmp_path / "e"))
    bad = write(tmp_path / "bad.csv", "a", "x")
    with pytest.raises(Exception):
        files.read_table(spark, bad, "a int").collect()


def test_prepared_data_round_trip(spark, tmp_path):
    df = files.read_table(spark, write(tmp_path / "churn.csv", HEADER, *CHURN_ROWS), files.CHURN_SCHEMA)
    done = prep.prepare(df, target="Exited", key="CustomerId", drop=["RowNumber", "CustomerId", "Surname"], categorical=["Geography", "Gender"])
    out = str(tmp_path / "prepared")
    sinks.write_prepared(done, out, csv=str(tmp_path / "csv"))
    back = files.read_prepared(spark, f"{out}/data")
    assert back.count() == 20 and {r.split for r in back.select("split").distinct().collect()} == {"train", "test"}
    assert sinks.read_scaler(spark, out) == done.scaler
    assert spark.read.parquet(f"{out}/encoders").count() == done.encoders.count()
    meta = spark.read.parquet(f"{out}/metadata").first()
    assert len(meta.feature_names) == 10 and len(meta.encoded_columns) == 2 and len(meta.scaled_columns) == 8
    assert meta.dropped_columns == ["RowNumber", "CustomerId", "Surname"]
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 20
    back.where("split = 'train'").write.partitionBy("split").parquet(str(tmp_path / "half"))
    with pytest.raises(FileNotFoundError, match="test"):
        files.read_prepared(spark, str(tmp_path / "half"))


def test_captures_are_written_once(spark, tmp_path):
    records = capture.capture_records(scored(spark), ["a", "b"], capture.CaptureSettings())
    path = str(tmp_path / "captures")
    sinks.write_captures(records, path)
    assert (tmp_path / "captures/year=2024/month=05/day=06/endpoint=e/deployment=d").is_dir()
    with pytest.raises(FileExistsError, match="captured before"):
        sinks.write_captures(records, path)
    sinks.write_captures(records.withColumn("request_id", F.lit("r2")), path)
    assert spark.read.json(path).count() == 2
    later = records.withColumn("timestamp_utc", F.col("timestamp_utc") + F.expr("INTERVAL 3 DAYS"))
    # Another day is another folder, so the same id may come again there, and then not twice.
    sinks.write_captures(later, path)
    with pytest.raises(FileExistsError, match="captured before"):
        sinks.write_captures(later, path)
    assert spark.read.json(path).count() == 3


def test_capture_files_are_found_below_a_root(spark, tmp_path):
    write(tmp_path / "c/2024/a.jsonl", '{"feature_count": 1, "outputs": [1]}', "")
    write(tmp_path / "c/b.jsonl", '{"feature_count": 1}')
    write(tmp_path / "c/x.json", "{broken")
    lines = files.read_capture_lines(spark, str(tmp_path / "c"))
    assert capture.parse_capture_lines(lines).count() == 2
    single = files.read_capture_lines(spark, str(tmp_path / "c/b.jsonl"))
    assert single.count() == 1


def test_requests_are_split_into_objects_and_others(spark, tmp_path):
    path = write(tmp_path / "r.txt", '{"input_data": []}', "[1]", "oops")
    good, bad = files.read_requests(spark, path)
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["not_json", "not_object"]


def test_candidate_files(spark, tmp_path):
    a = write(tmp_path / "a.json", '{"model_name": "rf",', ' "run_id": "1", "f1": 0.5, "roc_auc": "0.75"}')
    got = artifacts.read_candidate_metrics(spark, [a, "", str(tmp_path / "absent.json")]).first()
    assert (got.model_name, got.metrics) == ("rf", {"f1": 0.5, "roc_auc": 0.75})
    assert artifacts.read_candidate_metrics(spark, [str(tmp_path / "absent.json")]).count() == 0
    bad = write(tmp_path / "bad.json", '{"model_name": "rf", "run_id": "1", "f1": "high"}')
    with pytest.raises(Exception):
        artifacts.read_candidate_metrics(spark, [bad]).collect()


def test_manifest_files(spark, tmp_path):
    write(tmp_path / "m/s1/rf/train/step.json", json.dumps({"status": "finished", "warnings": ["t"]}))
    write(tmp_path / "m/s1/rf/hpo/step.json", json.dumps({"status": "partial", "warnings": ["h1", "h2"]}))
    manifests = artifacts.read_manifests(spark, str(tmp_path / "m"))
    seen = spark.createDataFrame([("s1", "svm", "r", {})], "sweep_id string, model_name string, run_id string, metrics map<string,double>")
    got = {r.model_name: (r.hpo_status, r.train_status, r.warnings) for r in family_report(seen, manifests).collect()}
    assert got == {"rf": ("partial", "finished", ["h1", "h2", "t"]), "svm": ("missing", "missing", [])}


def test_run_log_drops_secrets_and_has_stable_sections(spark, tmp_path):
    rows = spark.createDataFrame([("r", {"a": "1", "Api_Token": "x", "monkey": "y"})], "run_id string, params map<string,string>")
    row = sinks.manifest_rows(rows, "train", "fixed_train").first()
    assert row.params == {"a": "1"} and row.status == "partial" and row.outputs == {} and row.warnings == []
    sinks.append_summary(rows, str(tmp_path / "s"), "run-1", "monitor")
    sinks.append_summary(rows, str(tmp_path / "s"), "run-2", "monitor")
    assert spark.read.json(str(tmp_path / "s")).count() == 2
