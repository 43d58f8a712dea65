"""Sources and sinks over files written from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirgate.operators import prep
from weirgate.operators.select import family_report
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import with_churn
from weirgate.session import ensure_checkpoint_dir
from weirgate.sinks import tables as sinks
from weirgate.sinks.writers import spark_files, staged_files
from weirgate.sources import artifacts, files
from weirgate.sources.tables import CHURN_TARGET, churn_view, table

plans = Registry()


def _folder(spark) -> str:
    """A fresh folder beside the checkpoints, where every executor can write."""
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


@plans.query(
    "csv_round_trip",
    """SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total,
              count(*) FILTER (WHERE o_orderstatus = 'F') AS with_priority, min(o_orderkey) AS first_key
       FROM orders GROUP BY 1""",
)
def csv_round_trip(spark, sf):
    """Orders as CSV files of two headers in one directory, united by name with inferred types."""
    folder = _folder(spark)
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    spark_files(orders.where("o_orderstatus = 'F'").select("o_orderpriority", *columns), f"{folder}/csv", format="csv")
    staged_files(orders.where("o_orderstatus <> 'F'").select(*columns), f"{folder}/csv", format="csv")
    back = files.read_table(spark, f"{folder}/csv")
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count("o_orderpriority").alias("with_priority"), F.min("o_orderkey").alias("first_key"),
    )


@plans.query(
    "prepared_round_trip",
    with_churn(
        """SELECT writer, count(*) AS n, CAST(sum(exited) AS BIGINT) AS label, count(DISTINCT customer_id) AS keys, 2 AS splits, true AS scaler_kept,
                  count(*) AS csv_rows, 8 AS features
           FROM churn, (VALUES ('spark'), ('staged')) AS w(writer) GROUP BY writer"""
    ),
)
def prepared_round_trip(spark, sf):
    """The prepared churn table through both writers and back."""
    churn = churn_view(spark, sf).drop("surname", "credit_score", "age").na.fill(0)
    done = prep.prepare(churn, target=CHURN_TARGET, key="customer_id", categorical=["geography", "segment"])
    out = None
    for name, writer in (("spark", spark_files), ("staged", staged_files)):
        folder = _folder(spark)
        sinks.write_prepared(done, f"{folder}/prepared", csv=f"{folder}/csv", writer=writer)
        back = files.read_prepared(spark, f"{folder}/prepared/data")
        lines = spark.read.option("header", True).csv(f"{folder}/csv").count()
        meta = spark.read.parquet(f"{folder}/prepared/metadata").first()
        same = sinks.read_scaler(spark, f"{folder}/prepared") == done.scaler
        row = back.agg(
            F.lit(name).alias("writer"), F.count("*").alias("n"), F.sum(F.col(CHURN_TARGET)).cast("long").alias("label"),
            F.count_distinct("customer_id").alias("keys"), F.count_distinct("split").cast("int").alias("splits"),
            F.lit(same).alias("scaler_kept"), F.lit(lines).cast("long").alias("csv_rows"), F.lit(len(meta.feature_names)).alias("features"),
        )
        out = row if out is None else out.unionByName(row)
    return rounded(out)


@plans.query(
    "capture_round_trip",
    """SELECT writer, concat('dep-', user_id % 3) AS deployment, count(*) AS n, count(DISTINCT event_id) AS requests, 1 AS refused
       FROM events, (VALUES ('spark'), ('staged')) AS w(writer) GROUP BY ALL""",
)
def capture_round_trip(spark, sf):
    """Events as captures in two writes; a third with ids already there is refused whole."""
    records = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp_utc"), F.col("event_id").cast("string").alias("request_id"),
        F.lit("endpoint").alias("endpoint_name"), F.concat(F.lit("dep-"), F.col("user_id") % 3).alias("deployment_name"),
        F.lit(1).alias("row_count"),
    )
    half = F.col("request_id").cast("long") % 2
    out = None
    for name, writer in (("spark", spark_files), ("staged", staged_files)):
        root = f"{_folder(spark)}/captures"
        for side in (0, 1):
            sinks.write_captures(records.where(half == side), root, writer=writer)
        sinks.merge_filters(spark, root, writer=writer)
        refused = 0
        try:
            sinks.write_captures(records.where(F.col("request_id").cast("long") % 7 == 3), root, writer=writer)
        except FileExistsError:
            refused = 1
        lines = spark.read.schema("request_id string, deployment string").json(root)
        rows = lines.groupBy("deployment").agg(F.count("*").alias("n"), F.count_distinct("request_id").alias("requests"))
        rows = rows.withColumns({"writer": F.lit(name), "refused": F.lit(refused)})
        out = rows if out is None else out.unionByName(rows)
    return out.select("writer", "deployment", "n", "requests", "refused")


@plans.query(
    "manifest_report",
    """SELECT concat('s', c_nationkey) AS sweep_id, 'rf' AS model_name,
              CASE WHEN count(*) FILTER (WHERE c_custkey % 2 = 0) > 0 THEN 'finished' ELSE 'missing' END AS train_status, 'missing' AS hpo_status
       FROM customer GROUP BY c_nationkey""",
)
def manifest_report(spark, sf):
    """Step manifests, one JSON file for each nation with customers of even number, read back."""
    root = _folder(spark)
    customers = table(spark, sf, "customer")
    nations = customers.groupBy("c_nationkey").agg(F.count(F.when(F.col("c_custkey") % 2 == 0, 1)).alias("even"))
    found = nations.where("even > 0").select(
        F.concat(F.lit("s"), F.col("c_nationkey")).alias("sweep"), F.lit("rf").alias("family"), F.lit("train").alias("step"),
        F.lit("finished").alias("status"), F.array().cast("array<string>").alias("warnings"),
    )
    # A folder for each sweep, family and step; Spark names it after the column too.
    found.write.partitionBy("sweep", "family", "step").json(root)
    manifests = artifacts.read_manifests(spark, root)
    manifests = manifests.withColumns({c: F.regexp_replace(c, "^[a-z]+=", "") for c in ("sweep_id", "model_name", "kind")})
    seen = nations.select(
        F.concat(F.lit("s"), F.col("c_nationkey")).alias("sweep_id"), F.lit("rf").alias("model_name"), F.lit("r").alias("run_id"),
        F.create_map().cast("map<string,double>").alias("metrics"),
    )
    return family_report(seen, manifests).select("sweep_id", "model_name", "train_status", "hpo_status")
