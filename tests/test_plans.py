"""Shape of the physical plans: what must hold whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weirgate.operators import capture, gates, select
from weirgate.sources.derived import capture_lines, derived, trials
from weirgate.sources.tables import churn_view, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_rows_are_read(spark):
    text = plan(table(spark, SF, "lineitem").where("l_quantity > 40").groupBy("l_returnflag").count())
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text
    assert "GreaterThan(l_quantity,40.0)" in text
    labels = plan(entry.queries()["confusion_metrics"](spark, SF))
    assert "text" not in re.findall(r"ReadSchema: struct<[^>]*>", labels)[0]


def test_churn_view_shuffles_orders_on_the_customer_only(spark):
    text = plan(churn_view(spark, SF).groupBy("geography").agg(F.avg("exited")))
    assert re.search(r"hashpartitioning\(o_custkey#\d+L, \d+\)", text)


@pytest.mark.parametrize(
    "name",
    ["label_rate_by_group", "missing_fraction", "select_winner", "best_f1", "promotion_gate", "lineage_status", "monitor_status",
     "retraining_policy", "capture_evidence", "path_selection", "failure_from_logs", "payload_validate", "reusable_model"],
)
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_rules_are_row_wise(spark):
    text = plan(gates.handoff_status(derived(spark, SF, "releases")))
    assert "Exchange" not in text and "Python" not in text


def test_capture_facts_parse_once_and_combine_before_the_shuffle(spark):
    records = capture.parse_capture_lines(capture_lines(spark, SF).withColumnRenamed("path", "p"))
    text = plan(capture.capture_facts(records, ["p"], 2))
    assert text.count("posexplode") >= 1 and text.count("Scan parquet") == 1
    assert "partial_count" in text


def test_winner_selection_keeps_partial_aggregation(spark):
    text = plan(select.select_winner(trials(spark, SF)))
    assert "partial_max" in text and "Window" not in text
