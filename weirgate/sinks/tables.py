"""Prepared data, fitted parameters, captures, summaries and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.redact import secret_key, without_nested_secrets
from weirgate.operators.prep import Prepared, Scaler
from weirgate.session import cut_lineage
from weirgate.sinks.writers import Writer, spark_files
from weirgate.sources.artifacts import path_exists

def write_prepared(prepared: Prepared, path: str, csv: str | None = None, writer: Writer = spark_files) -> None:
    """Features, label and key together, partitioned by split; CSV per split on request."""
    writer(prepared.data, f"{path}/data", mode="overwrite", partition_by=["split"])
    if csv:
        writer(prepared.data, csv, format="csv", mode="overwrite", partition_by=["split"])
    write_artifacts(prepared, path, writer)


def write_artifacts(prepared: Prepared, path: str, writer: Writer = spark_files) -> None:
    """Fitted state as parameter tables, plus the metadata row."""
    spark = prepared.data.sparkSession
    if prepared.encoders is not None:
        writer(prepared.encoders, f"{path}/encoders", mode="overwrite")
    writer(prepared.scaler.table(spark), f"{path}/scaler", mode="overwrite")
    writer(prepared.metadata(), f"{path}/metadata", mode="overwrite")


def read_scaler(spark, path: str) -> Scaler:
    """Fitted scaling back from its table: one row per column."""
    rows = spark.read.parquet(f"{path}/scaler").collect()
    return Scaler({r["column"]: (r["mean"], r["scale"]) for r in rows})


def capture_layout(records: DataFrame) -> DataFrame:
    """Add the partition columns year, month, day, endpoint, deployment."""
    return records.withColumns(
        {
            "year": F.date_format("timestamp_utc", "yyyy"),
            "month": F.date_format("timestamp_utc", "MM"),
            "day": F.date_format("timestamp_utc", "dd"),
            "endpoint": F.col("endpoint_name"),
            "deployment": F.col("deployment_name"),
        }
    )


CAPTURE_PARTITIONS = ["year", "month", "day", "endpoint", "deployment"]


# Where the filters of request ids lie below a capture root; readers of captures skip it.
FILTERS = "_request_filters"
DAY = ["year", "month", "day"]
# Blocks of a day's filter, of 256 bits: two megabytes when full, and about one false hit in
# a hundred ids at a million ids a day. More ids mean more false hits, never a wrong answer.
FILTER_BLOCKS = 1 << 16
FILTER_WORDS, FILTER_BITS = 4, 8


def request_filter(laid_out: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Bloom filter rows (day, block, four words) of the records' partition and request id.

    Eight bits of an id lie in one block, so an id meets one row. Rows of one block merge by
    ``bit_or``, before the shuffle, between batches and between clusters.
    """
    masks = request_masks(laid_out, blocks)
    return masks.groupBy(*DAY, "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(FILTER_WORDS)])


def request_masks(laid_out: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """The block and bits of every record, beside its partition and request id."""
    named = [F.coalesce(F.col(c), F.lit("")) for c in (*CAPTURE_PARTITIONS, "request_id")]
    bits = [F.pmod(F.xxhash64(*named, F.lit(i)), F.lit(64 * FILTER_WORDS)) for i in range(1, FILTER_BITS + 1)]

    def word(i: int) -> Column:
        out = F.lit(0).cast("long")
        for bit in bits:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
            out = out.bitwiseOR(F.when(F.floor(bit / 64) == i, one).otherwise(F.lit(0).cast("long")))
        return out

    return laid_out.select(
        *CAPTURE_PARTITIONS, "request_id", F.pmod(F.xxhash64(*named), F.lit(blocks)).alias("block"),
        *[word(i).alias(f"w{i}") for i in range(FILTER_WORDS)],
    )


def maybe_captured(laid_out: DataFrame, filters: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Records whose request id may be in the filters; no other one is."""
    old = filters.groupBy(*DAY, "block").agg(*[F.bit_or(f"w{i}").alias(f"o{i}") for i in range(FILTER_WORDS)])
    met = request_masks(laid_out, blocks).join(old, [*DAY, "block"])
    for i in range(FILTER_WORDS):
        met = met.where(F.col(f"o{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"w{i}"))
    return met.select(*CAPTURE_PARTITIONS, "request_id")


def _records_at(spark, path: str, days: list[str]) -> DataFrame:
    """Partition and request id of the captures of some days."""
    old = spark.read.schema(
        "request_id string, year string, month string, day string, endpoint string, deployment string"
    ).json(path)
    # A filter on partition columns prunes the folders.
    return old.where(F.concat_ws("-", *DAY).isin(days))


FILTER_SCHEMA = "year string, month string, day string, block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint"


def write_captures(records: DataFrame, path: str, refuse_existing: bool = True, writer: Writer = spark_files) -> None:
    """Append capture records as JSON lines under date, endpoint and deployment.

    With ``refuse_existing`` a request id that is already there fails the write, before
    anything is written. Stored filters of the new records' days tell which ids may be
    there; only if one may, the records of its days are read. Captures without filters
    (written by others) are read once, and their filters are kept from then on.
    """
    spark = records.sparkSession
    laid_out = capture_layout(records)
    if refuse_existing:
        day = F.concat_ws("-", *DAY)
        # As many texts as the batch has days.
        days = [r["d"] for r in laid_out.select(day.alias("d")).distinct().collect()]
        filters = f"{path}/{FILTERS}"
        if path_exists(spark, path):
            if not path_exists(spark, filters):
                found = _records_at(spark, path, days)
                writer(request_filter(found), filters)
            stored = spark.read.schema(FILTER_SCHEMA).parquet(filters).where(day.isin(days))
            doubtful = cut_lineage(maybe_captured(laid_out, stored))
            again = [r["d"] for r in doubtful.select(day.alias("d")).distinct().collect()]
            if again:
                clash = doubtful.join(_records_at(spark, path, again), [*CAPTURE_PARTITIONS, "request_id"], "left_semi").limit(1).collect()
                if clash:
                    raise FileExistsError(f"request {clash[0].request_id} was captured before")
        # Before the records: a filter may know too many ids, never too few.
        writer(request_filter(laid_out), filters)
    # Records of one partition meet in few files; adaptive execution splits a busy deployment by size.
    writer(laid_out.hint("rebalance", *CAPTURE_PARTITIONS), path, format="json", partition_by=CAPTURE_PARTITIONS)


def merge_filters(spark, path: str, writer: Writer = spark_files) -> None:
    """The filters of all batches as one row a block; batches that read meanwhile see both."""
    stored = spark.read.schema(FILTER_SCHEMA).parquet(f"{path}/{FILTERS}")
    merged = stored.groupBy(*DAY, "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(FILTER_WORDS)])
    writer(cut_lineage(merged), f"{path}/{FILTERS}", mode="overwrite")


def append_summary(summary: DataFrame, path: str, run_id: str, kind: str, writer: Writer = spark_files) -> None:
    """Append summary rows of any kind (validation, selection, promotion, monitor) by run."""
    writer(summary.withColumn("run_id", F.lit(run_id)), f"{path}/kind={kind}", format="json")


def without_secrets(values: Column) -> Column:
    """Map entries whose key does not look like a secret, whatever the case."""
    return F.map_filter(values, lambda k, v: ~secret_key(k))


def run_log(rows: DataFrame, sections: list[str], nested: list[str] = (), trees: list[str] = ()) -> DataFrame:
    """Manifest rows with secrets removed from their sections.

    ``sections``: map<string,string> columns. ``nested``: map<string,map<string,string>>
    columns, cleaned at both levels. ``trees``: JSON text or VARIANT columns, cleaned at
    every depth and inside lists.
    """
    cleaned = {c: without_secrets(F.col(c)) for c in sections}
    cleaned |= {
        c: F.transform_values(without_secrets(F.col(c)), lambda k, v: without_secrets(v)) for c in nested
    }
    out = rows.withColumns(cleaned)
    return without_nested_secrets(out, list(trees)) if trees else out


def write_run_log(rows: DataFrame, path: str, writer: Writer = spark_files) -> None:
    """Append manifest rows, partitioned by step."""
    writer(rows, path, partition_by=["step_name"])


def manifest_rows(rows: DataFrame, step: str, stage: str) -> DataFrame:
    """Give run rows the stable sections of a manifest; absent ones are empty.

    A section may be a column of ``rows`` (map<string,string>, or array<string> for
    warnings); ``status`` defaults to partial.
    """
    empty = F.create_map().cast("map<string,string>")
    sections = ["run_context", "config", "inputs", "outputs", "tags", "params", "metrics", "artifacts", "step_specific"]
    have = set(rows.columns)
    return run_log(
        rows.select(
            "run_id",
            F.lit(1).alias("schema_version"),
            F.lit(step).alias("step_name"),
            F.lit(stage).alias("stage_name"),
            (F.col("status") if "status" in have else F.lit("partial")).alias("status"),
            *[(F.coalesce(s, empty) if s in have else empty).alias(s) for s in sections],
            (F.col("warnings") if "warnings" in have else F.array().cast("array<string>")).alias("warnings"),
        ),
        sections,
    )
