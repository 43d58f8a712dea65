"""Parquet tables of a scale directory and the labelled views built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHURN_NUMERIC = [
    "credit_score",
    "age",
    "tenure",
    "balance",
    "num_products",
    "has_cr_card",
    "is_active",
    "salary",
]
CHURN_CATEGORICAL = ["geography", "segment"]
CHURN_ID_COLUMNS = ["customer_id", "surname"]
CHURN_TARGET = "exited"


# Declared, so that opening a table starts no schema-inference job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{directory}/{name}.parquet")


def spread(rows: DataFrame, key: str, most: int = 20_000) -> DataFrame:
    """Rows dealt by ``key`` into tasks of about ``most`` rows, however few files hold them.

    For tables whose rows are short in a file and large in the work that follows; rows of a
    key stay together, so grouping by it moves nothing again.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // most))
    return rows.repartition(tasks, key)


def churn_view(
    spark: SparkSession, directory: str, null_every: int = 13, horizon_days: int = 365
) -> DataFrame:
    """One row per customer; features before the cutoff, label after it.

    The cutoff is ``horizon_days`` before the last order. Money is summed in whole
    cents, so the result does not depend on the order rows arrive in.
    """
    orders = table(spark, directory, "orders").select(
        "o_custkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )
    cutoff = F.date_sub(orders.agg(F.max("day")).scalar(), horizon_days)
    past = F.col("day") <= F.col("cutoff")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    per_customer = (
        orders.withColumn("cutoff", cutoff)
        .groupBy("o_custkey")
        .agg(
            F.max("cutoff").alias("cutoff"),
            F.count(F.when(past, 1)).alias("num_products"),
            F.sum(F.when(past, cents)).alias("cents"),
            F.min(F.when(past, F.col("day"))).alias("first_day"),
            F.max(F.when(past, F.col("day"))).alias("last_day"),
            F.max(
                (past & (F.col("o_orderpriority") == "1-URGENT")).cast("int")
            ).alias("has_cr_card"),
            F.max(
                (past & (F.col("day") > F.date_sub("cutoff", horizon_days))).cast("int")
            ).alias("is_active"),
            F.max((~past).cast("int")).alias("stayed"),
        )
    )
    places = (
        table(spark, directory, "nation")
        .join(
            table(spark, directory, "region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        .select("n_nationkey", "r_name")
    )
    score = F.col("cents") / F.lit(100.0) / F.col("num_products")
    return (
        table(spark, directory, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("surname"),
            F.when((F.col("c_custkey") % null_every != 0) & (F.col("num_products") > 0), score).alias("credit_score"),
            F.col("r_name").alias("geography"),
            F.col("c_mktsegment").alias("segment"),
            F.datediff("cutoff", "last_day").alias("age"),
            F.datediff("cutoff", "first_day").alias("tenure"),
            F.col("c_acctbal").alias("balance"),
            F.coalesce("num_products", F.lit(0)).cast("long").alias("num_products"),
            F.coalesce("has_cr_card", F.lit(0)).alias("has_cr_card"),
            F.coalesce("is_active", F.lit(0)).alias("is_active"),
            (F.coalesce("cents", F.lit(0)) / F.lit(100.0)).alias("salary"),
            (1 - F.coalesce("stayed", F.lit(0))).alias("exited"),
        )
    )


def labelled_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Second labelled table: document attributes with the ``toxic`` label; text is not read."""
    documents = table(spark, directory, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, directory, "labels").join(documents, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )
