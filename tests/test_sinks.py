"""Two-phase writing, filters of request ids, and secrets at any depth."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weirgate.functions.redact import without_nested_secrets
from weirgate.sinks import tables as sinks
from weirgate.sinks.writers import spark_files, staged_files

WRITERS = [spark_files, staged_files]


def visible(root):
    return [p for p in Path(root).rglob("*") if p.is_file() and not any(x[0] in "_." for x in p.relative_to(root).parts)]


def frame(spark, n=50, parts=4):
    return spark.range(n).repartition(parts).select(
        "id", (F.col("id") % 3).cast("string").alias("k"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 1.5).alias("x"),
        F.timestamp_seconds("id").alias("t"), F.concat(F.lit("a b,\"é/="), F.col("id")).alias("s"),
    )


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
@pytest.mark.parametrize("by", [[], ["k"], ["s"]])
def test_both_writers_write_the_same(spark, tmp_path, format, by):
    df = frame(spark, 20)
    back = []
    for writer in WRITERS:
        path = str(tmp_path / writer.__name__)
        writer(df, path, format=format, mode="overwrite", partition_by=by)
        writer(df.where("id < 3"), path, format=format, partition_by=by)
        read = spark.read.schema(df.schema).option("header", True).format(format).load(path)
        back.append(sorted(read.select("id", "k", "x", "s").collect()))
    assert back[0] == back[1] and len(back[0]) == 23


def test_overwrite_replaces_and_keeps_nothing_hidden(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (40, 10):
        staged_files(frame(spark, n), path, mode="overwrite", partition_by=["k"])
    assert spark.read.parquet(path).count() == 10
    assert not [p for p in Path(path).iterdir() if p.name.startswith("_staging")]


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    staged_files(frame(spark, 10), path)
    before = set(visible(path))
    # Some tasks end well before one fails.
    bad = frame(spark, 1000, 8).withColumn("x", F.when(F.col("id") == 700, F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        staged_files(bad, path, mode="overwrite")
    assert set(visible(path)) == before and spark.read.parquet(path).count() == 10
    # Tasks that run on after the failure clear away what they make.
    for _ in range(50):
        hidden = [p.name for p in Path(path).iterdir() if p.name.startswith("_")]
        if not hidden:
            break
        time.sleep(0.2)
    assert hidden == []


def records(spark, ids, day=1):
    return spark.createDataFrame([(f"r{i}",) for i in ids], "request_id string").select(
        "request_id", F.lit(f"2024-01-{day:02d} 10:00:00").cast("timestamp").alias("timestamp_utc"),
        F.lit("e").alias("endpoint_name"), F.concat(F.lit("d"), F.length("request_id")).alias("deployment_name"), F.lit(1).alias("row_count"),
    )


@pytest.mark.parametrize("writer", WRITERS)
def test_old_records_are_read_only_for_a_hit(spark, tmp_path, monkeypatch, writer):
    path = str(tmp_path / "c")
    sinks.write_captures(records(spark, range(300)), path, writer=writer)
    reads = []
    real = sinks._records_at
    monkeypatch.setattr(sinks, "_records_at", lambda *a: reads.append(a[2]) or real(*a))
    # New ids, and old ids of another day, meet the filters only.
    sinks.write_captures(records(spark, range(1000, 1300)), path, writer=writer)
    sinks.write_captures(records(spark, range(300), day=2), path, writer=writer)
    assert reads == []
    with pytest.raises(FileExistsError, match="r7 "):
        sinks.write_captures(records(spark, [5000, 7]), path, writer=writer)
    assert reads == [["2024-01-01"]]
    assert spark.read.json(path).count() == 900
    sinks.merge_filters(spark, path, writer=writer)
    with pytest.raises(FileExistsError):
        sinks.write_captures(records(spark, [1001]), path, writer=writer)


def test_captures_without_filters_get_them(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_captures(records(spark, range(20)), path, refuse_existing=False)
    with pytest.raises(FileExistsError):
        sinks.write_captures(records(spark, [3]), path)
    sinks.write_captures(records(spark, [30]), path)
    assert spark.read.json(path).count() == 21


def test_filters_merge_and_seldom_lie(spark):
    old = sinks.capture_layout(records(spark, range(20_000)))
    halves = [sinks.request_filter(old.where(c), blocks=1024) for c in ("hash(request_id) % 2 = 0", "hash(request_id) % 2 <> 0")]
    merged = halves[0].union(halves[1])
    assert sinks.maybe_captured(old, merged, blocks=1024).count() == 20_000
    new = sinks.capture_layout(records(spark, range(20_000, 40_000)))
    assert sinks.maybe_captured(new, merged, blocks=1024).count() < 2000


TREE = {
    "a": 1, "api_key": "x", "list": [1, {"Token": "x", "deep": {"er": [{"password": 1, "fine": [[{"my_secret": 2, "z": None}]]}]}}, "text"],
    "connection_string": {"all": "of it"}, "quo\"te": "v{[\"", "empty": {}, "none": [], "é": 1.5,
}
LEFT = {
    "a": 1, "list": [1, {"deep": {"er": [{"fine": [[{"z": None}]]}]}}, "text"], "quo\"te": "v{[\"", "empty": {}, "none": [], "é": 1.5,
}


def test_secrets_go_at_any_depth(spark):
    rows = [(1, json.dumps(TREE)), (2, json.dumps([TREE, [TREE]])), (3, "5"), (4, None), (5, "{broken"), (6, '"key"')]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("v", F.try_parse_json("t"))
    got = without_nested_secrets(df, ["t", "v"]).withColumn("v", F.to_json("v")).collect()
    wanted = {1: LEFT, 2: [LEFT, [LEFT]], 3: 5, 4: None, 5: None, 6: "key"}
    for row in got:
        for text in (row.t, row.v):
            assert (json.loads(text) if text is not None else None) == wanted[row.id]


def test_secrets_go_in_one_pass(spark):
    # Nothing is read while the work is described.
    broken = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("t"))
    assert without_nested_secrets(broken, ["t"]).columns == ["t"]
    texts = ['{"a":1,"key":2}', '{"key":{"b":[1,"}"]},"token":1}', '[{"a\\\\key":1,"b":"key,"},{"\\token":1,"z":1e5}]', '{"k\\u0065y":1}', "1e5"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = [r["t"] for r in without_nested_secrets(df, ["t"]).orderBy("id").collect()]
    assert got == ['{"a":1}', "{}", '[{"b":"key,"},{"\\token":1,"z":100000}]', "{}", "100000.0"]
